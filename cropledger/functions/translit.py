"""Letters of Latin, Greek and Cyrillic as plain ``a-z``, as one column expression.

Two letters that sound as one are written first (Greek ``ου``, ``αυ``, ``γγ``), then
letters that become several (``ж`` → ``zh``), then all that become one. The tables
below give the plain letters; every accented form follows by rule from its Unicode
decomposition. Letters of other scripts stay as they are. Combining marks written
apart from their letter are dropped first.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES (ours): letter and spelling
LATIN = "ß ss æ ae œ oe þ th ŋ ng ĳ ij ð d đ d ø o ł l ħ h ı i ŧ t ŀ l ĸ k ſ s ə e"
GREEK = "α a β v γ g δ d ε e ζ z η i θ th ι i κ k λ l μ m ν n ξ x ο o π p ρ r σ s ς s τ t υ y φ f χ ch ψ ps ω o"
CYRILLIC = (
    "а a б b в v г g ґ g ѓ gj д d ђ dj е e ё e є ye ж zh з z ѕ dz и i і i ї yi й y ј j к k ќ kj л l љ lj м m "
    "н n њ nj о o п p р r с s т t ћ c у u ў u ф f х kh ц ts ч ch џ dzh ш sh щ shch ъ a ы y э e ю yu я ya"
)
#: Letters without a sound of their own.
SILENT = "ь"

_LATIN_RANGES = ((0xC0, 0x250), (0x1E00, 0x1F00))
_SCRIPT_RANGES = ((0x370, 0x400), (0x1F00, 0x2000), (0x400, 0x530))
#: Any letter of the second group of ranges.
_SCRIPTS = "[Ͱ-Ͽἀ-῿Ѐ-ԯ]"


def _spellings(table: str) -> dict[str, str]:
    words = table.split()
    return dict(zip(words[::2], words[1::2]))


@lru_cache(maxsize=1)
def spellings() -> tuple[dict[str, str], dict[str, str]]:
    """Spelling of every lower-case letter: of Latin, of Greek and Cyrillic."""
    latin = {c: c for c in map(chr, range(ord("a"), ord("z") + 1))} | _spellings(LATIN)
    scripts = _spellings(GREEK) | _spellings(CYRILLIC) | {c: "" for c in SILENT}
    for table, ranges in ((latin, _LATIN_RANGES), (scripts, _SCRIPT_RANGES)):
        for first, last in ranges:
            for letter in map(chr, range(first, last)):
                base, *marks = unicodedata.normalize("NFD", letter)
                if letter not in table and base in table and marks and all(map(unicodedata.combining, marks)):
                    table[letter] = table[base]
    return {c: to for c, to in latin.items() if not c.isascii()}, scripts


def _upsilons() -> str:
    """υ with or without accent; with a diaeresis it is a letter of its own."""
    found = [c for c in map(chr, [*range(0x370, 0x400), *range(0x1F00, 0x2000)]) if unicodedata.normalize("NFD", c)[0] == "υ"]
    return "".join(c for c in found if "̈" not in unicodedata.normalize("NFD", c))


def _written(c: Column, table: dict[str, str]) -> Column:
    several = {letter: to for letter, to in table.items() if len(to) > 1}
    for letter, to in several.items():
        c = F.replace(c, F.lit(letter), F.lit(to))
    # translate takes letters without a counterpart away: the silent ones go last
    one = sorted((letter for letter in table if letter not in several), key=lambda x: (not table[x], x))
    return F.translate(c, "".join(one), "".join(table[x] for x in one))


def to_latin(c: Column) -> Column:
    """Lower-case text in ``a-z`` where a spelling is known. Pure ASCII text (as many
    bytes as characters) is only lower-cased; the Greek and Cyrillic steps run for
    texts that hold such a letter."""
    latin, scripts = spellings()
    lowered = F.lower(c)
    bare = F.regexp_replace(lowered, r"\p{Mn}+", "")
    u = _upsilons()
    pairs = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, f"ο[{u}]", "ou"), f"([αεη])[{u}]", "$1v"), "γ(?=[γξχ])", "n")
    return (
        F.when(F.octet_length(c) == F.length(c), lowered)
        .when(bare.rlike(_SCRIPTS), _written(pairs, latin | scripts))
        .otherwise(_written(bare, latin))
    )
