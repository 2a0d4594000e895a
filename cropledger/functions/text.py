"""Scalar text cleaning as Catalyst column expressions.

Every function takes and returns a ``Column``; nothing here runs Python per
row, so the expressions stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropledger.dims import EMPTY_MARKERS, LEGAL_FORMS, NULL_TOKENS
from cropledger.functions.translit import SILENT, to_latin

ID_SEPARATOR = "\u001f"

# characters stripped from both ends of a cell (T1), then whitespace
CELL_STRIP = "\"' ,"
WHITESPACE = " \t\n\r\f\u000b"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_cell(c) -> Column:
    """Strip quotes, spaces and commas from both ends, then whitespace
    (character-set trims, no regular expression)."""
    return F.trim(F.trim(_c(c), F.lit(CELL_STRIP)), F.lit(WHITESPACE))


_NULL_TOKENS_SQL = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in NULL_TOKENS)


def null_token(c) -> Column:
    """S3: map the usual missing-value tokens (and blanks) to null. For a
    column name the test is one SQL ``IN`` list (one call to build)."""
    if isinstance(c, str):
        return F.expr(f"CASE WHEN `{c}` IN ({_NULL_TOKENS_SQL}) THEN NULL ELSE `{c}` END")
    return F.when(c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def blank_to_null(c) -> Column:
    c = _c(c)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def collapse_spaces(c) -> Column:
    """T4: collapse whitespace runs to one space and trim. Most texts hold single spaces
    only, which a plain search tells faster than the pattern."""
    c = _c(c)
    odd = reduce(or_, [F.contains(c, F.lit(x)) for x in ("  ", *WHITESPACE[1:])])
    return F.trim(F.when(odd, F.regexp_replace(c, r"\s+", " ")).otherwise(c))


def fold_ascii(c) -> Column:
    """Lower case, and Latin, Greek and Cyrillic letters as ``a-z`` (``translit``)."""
    return to_latin(_c(c))


def fingerprint(c) -> Column:
    """T5: order-free name key: folded, punctuation removed, words unique and
    sorted, legal forms shortened; null when nothing is left. Every run without
    letters and digits (of any script) becomes two spaces, so each word has a space
    of its own on both sides and legal forms are plain replacements. Each step reads
    the one before once: the expression stays small and in whole-stage codegen."""
    words = F.concat(F.lit(" "), F.regexp_replace(fold_ascii(c), r"[^\p{L}\p{N}]+", "  "), F.lit(" "))
    for long_form, short_form in LEGAL_FORMS:
        long_form, short_form = (f" {x.replace(' ', '  ')} " for x in (long_form, short_form))
        words = F.replace(words, F.lit(long_form), F.lit(short_form))
    # one blank splits without a pattern compiled for every row; the empty word between two of them goes
    tokens = F.array_remove(F.array_distinct(F.split(words, " ")), "")
    return F.nullif(F.array_join(F.sort_array(tokens), " "), F.lit(""))


#: A letter or digit of any script, but for letters without a sound.
_SPOKEN = rf"[\p{{L}}\p{{N}}&&[^{SILENT}{SILENT.upper()}]]"


def has_fingerprint(c) -> Column:
    """True when ``fingerprint(c)`` would not be null."""
    return F.coalesce(_c(c).rlike(_SPOKEN), F.lit(False))


def usable(c) -> Column:
    """Not null or empty, no placeholder marker, and a fingerprint."""
    c = _c(c)
    marked = reduce(or_, [F.contains(F.lower(c), F.lit(m)) for m in EMPTY_MARKERS])
    return F.coalesce(c.rlike(_SPOKEN) & ~marked, F.lit(False))


def first_usable(*cols) -> Column:
    """First usable value among alternative columns, else null."""
    return F.coalesce(*[F.when(usable(c), _c(c)) for c in cols])


def entity_id(*parts) -> Column:
    """40 hex digit id over text parts; nulls skipped, parts separated by
    U+001F so ('a','bc') and ('ab','c') differ; all-null gives null."""
    texts = [_c(p).cast("string") for p in parts]
    joined = F.concat_ws(ID_SEPARATOR, *texts)
    return F.when(F.coalesce(*texts).isNull(), F.lit(None).cast("string")).otherwise(
        F.sha1(joined)
    )


def packed(c) -> Column:
    """An id on its way through a shuffle: lower-case hex text as its bytes, half as long
    (hex doesn't compress there), any other text as it is, each behind a mark. Equal where
    the texts are equal, but in another order."""
    c = _c(c)
    raw = F.unhex(c)
    return F.when(F.lower(F.hex(raw)) == c, F.concat(F.lit(b"\x01"), raw)).otherwise(F.concat(F.lit(b"\x00"), c.cast("binary")))


def unpacked(c) -> Column:
    """The text of a ``packed`` id."""
    c = _c(c)
    rest = F.substring(c, F.lit(2), F.length(c))
    return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


#: Columns of a payments table that hold ids.
ID_COLUMNS = ("pk", "recipient_id", "scheme_id")


def pack_ids(df: DataFrame, but: list[str] | tuple = ()) -> DataFrame:
    """``df`` with its ids ``packed``, other than those of ``but`` (rows are ordered by them)."""
    return df.withColumns({c: packed(c) for c in ID_COLUMNS if c in df.columns and c not in but})


def unpack_ids(df: DataFrame, but: list[str] | tuple = ()) -> DataFrame:
    return df.withColumns({c: unpacked(c) for c in ID_COLUMNS if c in df.columns and c not in but})


def normalize_scheme(c) -> Column:
    """Lower case, every run of non letters/digits as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(_c(c)), r"[^\p{L}\p{N}]+", " "))


def scheme_id(c) -> Column:
    """Id of a scheme text; null scheme gives null."""
    return entity_id(normalize_scheme(c))
