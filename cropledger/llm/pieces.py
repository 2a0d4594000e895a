"""Token ids of whole texts with a cache of pieces, one per Python worker.

A text is cut at single spaces. For byte-level vocabularies the space belongs to
the piece that follows, and a cut is made only between two characters that are
not white space: there every pre-token ends in any case, so the pieces' ids in a
row are the text's ids. For vocabularies that drop white space any space will do.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cropledger.llm.words import blocks

#: Pieces kept in a worker's cache, and the longest piece that is kept.
CACHE_PIECES = 1_000_000
CACHE_CHARS = 200

#: Letters (of scripts that all versions of Unicode agree on) with signs behind them: two
#: pre-tokens in every vocabulary here, so the letters' ids are shared.
_LETTERS = "".join(re.escape(chr(i)) for i in range(0x250) if chr(i).isalpha())
_WORD = re.compile(f"([{_LETTERS}]+)([.,!?;:]*)")
_ONE_WORD = re.compile(f" ?[{_LETTERS}]+")
#: Runs of letters, of signs (no apostrophe: it may begin a contraction) and single line
#: breaks between them: each a pre-token of its own where an encoder's ``pre_tokens`` says so.
_SIGNS = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
_RUN = re.compile(f"[{_LETTERS}]+|[{_SIGNS}]+|\n")
_RUNS = re.compile(f"[{_LETTERS}{_SIGNS}]+(?:\n[{_LETTERS}{_SIGNS}]+)*")
_PROBE = "ab.\nCd$$e,\n&&é\nf"


def _packed(ids: list[int]) -> bytes:
    """Little-endian 32-bit ids."""
    return struct.pack(f"<{len(ids)}i", *ids)


def _numbered(pieces: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Each piece's number among the different ones, and these."""
    found = pieces.dictionary_encode()
    number, texts = found.indices.to_numpy(), found.dictionary
    if not len(texts):
        return number, []
    # no piece holds a space: one string, cut again, is made far faster than a string at a time
    return number, pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), pa.scalar(" ", texts.type))[0].as_py().split(" ")


class PieceCache:
    """``encode_pieces`` gives the ids of each piece; ``spaced``: the space before a
    piece belongs to it."""

    def __init__(self, encode_pieces: Callable[[list[str]], list[list[int]]], spaced: bool, most: int = CACHE_PIECES):
        self.encode_pieces, self.spaced, self.most = encode_pieces, spaced, most
        self.known: dict[str, bytes] = {}
        self.plain: dict[str, bytes] = {} if spaced else self.known  # pieces with no space before them
        cut = getattr(encode_pieces, "pre_tokens", None)
        #: whether every run is a pre-token of its own, else only signs behind a word are
        self.runs = cut is not None and [x for x in cut(_PROBE) if x != "\n"] == [x for x in _RUN.findall(_PROBE) if x != "\n"]

    def _cuts(self, piece: str) -> Sequence[str] | None:
        """The runs of a piece that is more than one, each encoded by itself."""
        m = _WORD.fullmatch(piece)
        if m is not None:
            return m.groups() if m[2] else None
        if not self.runs or _RUNS.fullmatch(piece) is None:
            return None
        runs = _RUN.findall(piece)
        return runs if len(runs) > 1 else None

    def _learn(self, parts: Iterable[str], firsts: Iterable[str] = ()) -> None:
        """``firsts``: pieces at the beginning of a text, with no space before them."""
        known, plain, spaced, cuts = self.known, self.plain, self.spaced, self._cuts
        split, new, bare = [], {}, {}
        for p in parts:
            if p.isascii() and p.isalpha() and len(p) <= CACHE_CHARS:
                new[p] = None
                continue
            if not p or len(p) > CACHE_CHARS or (spaced and (p[0].isspace() or p[-1].isspace())):
                continue
            if (runs := cuts(p)) is None:
                new[p] = None
                continue
            split.append((p, runs))
            if runs[0] not in known:
                new[runs[0]] = None
            for r in runs[1:]:
                if r not in plain:
                    bare[r] = None
        for p in firsts:
            bare[p] = None
        if not spaced:
            new |= bare
        else:
            plain.update(zip(bare, self._direct(list(bare)), strict=True))
        known.update(zip(new, self._direct([" " + p for p in new] if spaced else list(new)), strict=True))
        for p, runs in split:
            known[p] = known[runs[0]] + (plain[runs[1]] if len(runs) == 2 else b"".join([plain[r] for r in runs[1:]]))
        if not spaced:
            known[""] = b""

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if not texts:
            return []
        if len(self.known) > self.most or len(self.plain) > self.most:
            self.known.clear()
            self.plain.clear()
        known, plain = self.known, self.plain
        pieces = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        head, pieces = pieces.offsets.to_numpy()[:-1].astype(np.int64), pieces.values
        # each different piece of the block is looked up once; a text's first one has no space before it
        opens = np.zeros(len(pieces), dtype=bool)
        opens[head] = self.spaced
        unit = np.zeros(len(pieces), dtype=np.int64)
        unit[~opens], parts = _numbered(pieces.filter(pa.array(~opens)))
        unit[opens], firsts = _numbered(pieces.filter(pa.array(opens)))
        unit[opens] += len(parts)
        ids = list(map(known.get, parts))
        new = [i for i, x in enumerate(ids) if x is None]
        bare = [p for p in firsts if p and len(p) <= CACHE_CHARS and p not in plain]
        if new or bare:
            self._learn([parts[i] for i in new], bare)
            for i in new:
                ids[i] = known.get(parts[i])
        # white space beside a space, or a very long piece
        whole = np.array([x is None for x in ids] + [False] * len(firsts), dtype=bool)
        alone = np.diff(np.append(head, len(pieces))) == 1
        space = np.zeros(len(unit), dtype=bool)
        space[opens] = np.array([p[-1:].isspace() for p in firsts], dtype=bool)[unit[opens] - len(parts)] & ~alone if len(firsts) else False
        odd = np.logical_or.reduceat(whole[unit] | space, head)
        for i in np.flatnonzero(whole).tolist():
            ids[i] = b""
        ids += [b"" if not p else self._direct([p])[0] if (x := plain.get(p)) is None else x for p in firsts]
        flat, size = np.frombuffer(b"".join(ids), dtype=np.int32), np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        n = size[unit]
        end = np.cumsum(n)
        # fewer than 2**31 ids: a block is a few MB, or one text
        at = np.repeat(((np.cumsum(size) - size)[unit] - (end - n)).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        made = flat[at].tobytes()
        edge = [0, *(4 * end[np.append(head[1:], len(pieces)) - 1]).tolist()]
        out = [made[x:y] for x, y in zip(edge[:-1], edge[1:], strict=True)]
        for i in np.flatnonzero(odd).tolist():
            out[i] = b"".join(self._direct(self._cut(texts[i])))
        return out

    def _direct(self, pieces: list[str]) -> list[bytes]:
        return list(map(_packed, self.encode_pieces(pieces))) if pieces else []

    def _cut(self, text: str) -> list[str]:
        parts = text.split(" ")
        if not self.spaced:
            return [p for p in parts if p]
        pieces, now = [], parts[0]
        for p in parts[1:]:
            if now and not now[-1].isspace() and p and not p[0].isspace():
                pieces.append(now)
                now = " " + p
            else:
                now += " " + p
        return [*pieces, now]


def _byte_alphabet() -> dict[int, int]:
    """Byte -> the letter that stands for it in byte-level vocabularies: printable Latin-1
    for themselves, the others in order from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 0x100 + i for i, b in enumerate(others)}


class LibraryEncoder:
    """Pieces through the ``tokenizers`` library; special tokens in a text are plain
    text. A piece that is one word goes to the library's model straight away (its
    normaliser first, where there is one), others through the whole library."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.alphabet = _byte_alphabet()
        self.alphabet_break = chr(self.alphabet[0x0A])

    def __call__(self, pieces: list[str]) -> list[list[int]]:
        if len(pieces) < 2:
            return self._whole(pieces)
        tokenize, normaliser = self.tokenizer.model.tokenize, self.tokenizer.normalizer
        out: list = [None] * len(pieces)
        words, at, rest = [], [], []
        for i, piece in enumerate(pieces):
            # a letter and letters only, perhaps with the space that belongs to them
            if _ONE_WORD.fullmatch(piece) is None:
                rest.append(i)
                continue
            at.append(i)
            words.append(piece if normaliser is None else piece.lower() if piece.isascii() else normaliser.normalize_str(piece))
        # all words at once in the letters of the vocabulary; a line break separates them
        spelt = "\n".join(words).encode().decode("latin-1").translate(self.alphabet).split(self.alphabet_break) if words else []
        for i, word in zip(at, spelt, strict=True):
            out[i] = [t.id for t in tokenize(word)]
        for i, ids in zip(rest, self._whole([pieces[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def pre_tokens(self, text: str) -> list[str]:
        """How the library cuts a text, white space left out."""
        cutter = self.tokenizer.pre_tokenizer
        spans = cutter.pre_tokenize_str(text) if cutter is not None else [(text, (0, len(text)))]
        return [t for t in (text[a:b].strip() for _, (a, b) in spans) if t]

    def _whole(self, pieces: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


_caches: dict[tuple, PieceCache] = {}


def cache_for(kind: str, path: str, make: Callable[[str], Callable], spaced: bool, most: int = CACHE_PIECES) -> PieceCache:
    """The worker's cache for a vocabulary."""
    if (kind, path) not in _caches:
        _caches[kind, path] = PieceCache(make(path), spaced, most)
    return _caches[kind, path]


def encoded_blocks(texts: pa.Array, cache: PieceCache) -> Iterator[tuple[int, list[bytes]]]:
    """Ids of the texts of an Arrow column, block by block: (first row, ids of each row)."""
    for b in blocks(texts):
        raw = b.buf.tobytes()
        yield b.lo, cache.encode([raw[x:y].decode("utf-8", "replace") for x, y in zip(b.off[:-1], b.off[1:], strict=True)])
