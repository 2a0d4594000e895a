"""Byte-level BPE encoding and decoding (operator 3).

Tokens are strings of bytes, mapped to Latin-1 for an Aho-Corasick automaton that
finds, for each position of a pre-token, the longest token that starts there. The
encoder goes through a pre-token by longest matches and checks that each token may
stand beside the one before it: two tokens are compatible when the merges, done in
rank order, of their joined bytes never cross the border. That is decided by
undoing the later merge of the two until a merge of the border's tokens would have
come first, and is memoised. Where no shorter prefix is compatible, the last
token is taken back, and a position that failed is never tried again, so the work
is linear in the length.

The ids equal those of merging by rank, pre-token by pre-token; a pre-token that is
itself a token is that token. Null and empty texts have no ids. No special tokens:
their strings are plain text. Decoding joins the tokens' bytes; an unknown id
raises. Repeated rows give equal rows; other columns pass through unread (one named
as a new column is replaced); an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm.pieces import cache_for, encoded_blocks
from cropledger.llm.words import map_texts

#: Pairs, pre-tokens and pieces of text remembered by a worker.
PAIRS, WORDS, PIECES = 300_000, 200_000, 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class BytePairs:
    """Encoder and decoder of one vocabulary. ``pattern`` cuts texts into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {i: t for t, i in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.automaton.add_word(t.decode("latin-1"), (i, len(t) - 1))
        self.automaton.make_automaton()
        self.size = [0] * (max(ranks.values()) + 1)  # bytes of each token
        for t, i in ranks.items():
            self.size[i] = len(t)
        self.shorter: dict[int, int] = {}  # the longest token that is a proper prefix
        for t, i in ranks.items():
            for n in range(len(t) - 1, 0, -1):
                if (p := ranks.get(t[:n])) is not None:
                    self.shorter[i] = p
                    break
        self.merged: dict[tuple[int, int], int] = {}  # the two tokens of a merge -> its token
        self.halves: dict[int, tuple[int, int]] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        for i in sorted(self.token):
            self._find_halves(i)
        self.compatible.clear()

    def _find_halves(self, i: int) -> None:
        """The last merge that makes token ``i``: two compatible older tokens."""
        t, a = self.token[i], self.shorter.get(i)
        while a is not None:
            b = self.ranks.get(t[len(self.token[a]) :])
            if b is not None and a < i and b < i and self._decide(a, b):
                self.merged[a, b], self.halves[i] = i, (a, b)
                return
            a = self.shorter.get(a)

    def _decide(self, a: int, b: int) -> bool:
        """Whether a and b stay two tokens when their bytes are merged by rank."""
        limit = None  # the merge undone last: a border merge before it would have come first
        while True:
            m = self.merged.get((a, b))
            if m is not None and (limit is None or m < limit):
                return False
            # undo the later of the two merges beside the border; on the right a tie counts as later
            if a > b:
                if (h := self.halves.get(a)) is not None:
                    limit, a = a, h[1]
                elif (h := self.halves.get(b)) is not None:
                    limit, b = b + 1, h[0]
                else:
                    return True
            elif (h := self.halves.get(b)) is not None:
                limit, b = b + 1, h[0]
            elif (h := self.halves.get(a)) is not None:
                limit, a = a, h[1]
            else:
                return True

    def _fits(self, a: int, b: int) -> bool:
        known = self.compatible.get((a, b))
        if known is None:
            if len(self.compatible) > PAIRS:
                self.compatible.clear()
            known = self.compatible[a, b] = self._decide(a, b)
        return known

    def encode_word(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        longest: list[int | None] = [None] * len(data)
        for end, (i, n) in self.automaton.iter(data.decode("latin-1")):
            longest[end - n] = i  # ends grow, so the last is the longest
        out: list[int] = []
        at, size, closed = 0, len(data), None
        sizes, shorter, known, fits = self.size, self.shorter, self.compatible, self._fits
        last, t = None, longest[0]  # the token before, and the one tried
        while at < size:
            while t is not None:
                end = at + sizes[t]
                if (closed is None or end not in closed) and (last is None or ((ok := known.get((last, t))) is None and fits(last, t)) or ok):
                    out.append(t)
                    at, last = end, t
                    t = longest[at] if at < size else None
                    break
                t = shorter.get(t)
            else:  # nothing fits here: take back the last token and go on with a shorter one
                if last is None:
                    raise ValueError("the vocabulary lacks a byte of the text")
                closed = {at} if closed is None else closed | {at}
                t = out.pop()
                last = out[-1] if out else None
                at -= sizes[t]
        return out

    def pre_tokens(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        out, words = [], self.words
        for piece in pieces:
            found = self.pattern.findall(piece)
            if len(found) == 1:  # the piece itself is remembered by its cache
                out.append(self.encode_word(found[0].encode()))
                continue
            ids: list[int] = []
            for w in found:
                got = words.get(w)
                if got is None:
                    got = self.encode_word(w.encode())
                    if len(w) <= 64:
                        if len(words) > WORDS:
                            words.clear()
                        words[w] = tuple(got)  # not followed by the garbage collector, as lists are
                ids += got
            out.append(ids)
        return out

    __call__ = encode_pieces

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_coders: dict[tuple[str, str], BytePairs] = {}


def coder(path: str, pattern: str) -> BytePairs:
    if (path, pattern) not in _coders:
        _coders[path, pattern] = BytePairs(read_ranks(path), pattern)
    return _coders[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` without the text, with ``ids array<int>``; with ``decoded`` also the bytes
    that the ids decode to, made in the same pass."""

    def run(texts: pa.Array) -> Iterator[list[pa.Array]]:
        pairs = coder(path, pattern)
        cache = cache_for("bpe" + pattern, path, lambda p: pairs, spaced=True, most=PIECES)
        for _, rows in encoded_blocks(texts, cache):
            off = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
            flat = np.frombuffer(b"".join(rows), dtype=np.int32)
            out = [pa.ListArray.from_arrays(off, pa.array(flat))]
            if decoded:
                out.append(pa.array([pairs.decode(flat[x:y].tolist()) for x, y in zip(off[:-1], off[1:], strict=True)], pa.binary()))
            yield out

    return map_texts(docs, text_col, run, "ids array<int>" + ", decoded binary" * decoded, drop_text=True)


def decode(docs: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``decoded binary``: the bytes of the ids (null: empty)."""
    names = [c for c in docs.columns if c.lower() != "decoded"]
    at = names.index(ids_col)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = coder(path, pattern)
        for batch in batches:
            ids = pc.fill_null(batch.column(at), [])
            off, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            data = [pairs.decode(flat[x:y].tolist()) for x, y in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, "n0"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields), "n0 binary"])
    return rows.mapInArrow(run, schema).toDF(*names, "decoded")


NAME, ORACLE = "op3_byte_bpe", None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, path, pattern, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
