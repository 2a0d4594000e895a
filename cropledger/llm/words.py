"""Vectorised views of a batch of texts: bytes, documents, words.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. Hashes are 64-bit
polynomials over a random byte table with a final mix, computed for all words of
a block at once. A null text counts as empty. Blocks bound the memory: a block
holds whole documents of about ``limit`` bytes in all; a longer document is a
block of its own.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropledger.session import ensure_checkpoint_dir
from cropledger.sources.csv_source import remove_path

BLOCK_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_pow: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``P**i`` and ``P**-i`` modulo 2**64 for i below n."""
    if not _pow or len(_pow["p"]) < n:
        m = max(n, BLOCK_BYTES + 1)
        inv = np.uint64(pow(int(_P), -1, 1 << 64))
        one = np.ones(1, dtype=np.uint64)
        _pow["p"] = np.cumprod(np.concatenate([one, np.full(m - 1, _P)]), dtype=np.uint64)
        _pow["i"] = np.cumprod(np.concatenate([one, np.full(m - 1, inv)]), dtype=np.uint64)
    return _pow["p"][:n], _pow["i"][:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """``S`` with ``(S[j] - S[i]) * P**-i`` the hash of ``buf[i:j]`` (before ``mix``)."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * powers(len(buf))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inv = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64))


def fresh_name(df, base: str) -> str:
    """A column name that ``df`` doesn't have, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name += "_"
    return name


class Block:
    """Documents ``lo`` to ``hi`` of a batch as one byte array.

    ``buf`` bytes; ``off`` document offsets (n + 1); words: ``start``, ``end``,
    ``doc`` (index within the block), ``first`` (each document's first word, n + 1).
    """

    def __init__(self, lo: int, hi: int, buf: np.ndarray, off: np.ndarray):
        self.lo, self.hi, self.n, self.buf, self.off = lo, hi, hi - lo, buf, off

    def split_words(self) -> Block:
        inside = ~_SEP[self.buf]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        heads = self.off[:-1][np.diff(self.off) > 0]
        before[heads] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[heads[heads > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.off)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))
        return self

    def word_hashes(self, lower: bool) -> np.ndarray:
        buf = LOWER[self.buf] if lower else self.buf
        return span_hash(prefix_hash(buf), self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i] : self.end[i]].tobytes()


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of an Arrow column in blocks of whole documents."""
    texts = text_array(column)
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield Block(lo, hi, buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


def shingle_hashes(block: Block, word_hash: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and the document of each; runs never
    cross documents. A document of one to ``k - 1`` words gives one run of all."""
    count = np.diff(block.first)
    per = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    doc = np.repeat(np.arange(block.n), per)
    first_run = np.concatenate([[0], np.cumsum(per)[:-1]]) if block.n else np.zeros(0, dtype=np.int64)
    start = np.arange(int(per.sum())) - np.repeat(first_run, per) + np.repeat(block.first[:-1], per)
    prefix = np.zeros(len(word_hash) + 1, dtype=np.uint64)
    pw, inv = powers(len(word_hash) + 1)
    np.cumsum(word_hash * pw[: len(word_hash)], out=prefix[1:])
    end = np.minimum(start + k, block.first[1:][doc]) if len(doc) else start
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64)), doc


def give_back() -> None:
    """Hands memory that a finished task no longer needs back to the system: workers are
    used again by later stages, which have an executor's memory to share."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(
    docs: DataFrame,
    text_col: str,
    fn: Callable[[pa.Array], Iterator[list[pa.Array]]],
    schema: str,
    drop_text: bool = False,
) -> DataFrame:
    """``docs`` with the columns of ``schema``, which ``fn`` gives for the texts:
    lists of column parts, the parts in row order. No shuffle. A column of
    ``docs`` whose name is one of the new ones is replaced; ``drop_text`` leaves
    the text out. A text that stays goes to Python once, for both uses."""
    new = T.StructType.fromDDL(schema)
    taken = {f.name.lower() for f in new.fields}
    kept = [c for c in docs.columns if c.lower() not in taken and not (drop_text and c == text_col)]
    plain = dict(docs.dtypes)[text_col] == "string"
    sent = [c for c in kept if not (plain and c == text_col)]
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("t"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(sent)])
    place = [0 if plain and c == text_col else 1 + sent.index(c) for c in kept]
    out = T.StructType([*(rows.schema.fields[i] for i in place), *(T.StructField(f"n{i}", f.dataType) for i, f in enumerate(new.fields))])
    names = [f.name for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = 0
            for part in fn(batch.column(0)):  # small batches: what a worker holds doesn't follow the batch
                n = len(part[0])
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, n) for i in place), *part], names=names)
                at += n
        give_back()

    made = rows.mapInArrow(run, out)
    return made.toDF(*kept, *(f.name for f in new.fields))


#: Bits of the filter that keeps rows without a wanted key out of a shuffle: a
#: broadcast of FILTER_BITS / 8 bytes, whatever the number of keys.
FILTER_BITS = 1 << 23
_BUCKET_BITS = 32768


def maybe_keys(rows: DataFrame, keys: DataFrame, row_slot: Column, key_slot: Column, bits: int = FILTER_BITS, mark: str | None = None) -> DataFrame:
    """The ``rows`` whose slot (below ``bits``) is that of some key: a bitmap of
    the keys' slots, built by aggregation and broadcast, holds back nearly all
    others before they are shuffled. Collisions only let more rows pass.
    With ``mark`` all rows stay, and the new boolean column of that name tells."""
    if bits % _BUCKET_BITS:
        raise ValueError(f"filter bits must be a multiple of {_BUCKET_BITS}")
    bucket, bitmap_col = fresh_name(rows, "bucket"), fresh_name(rows, "bitmap")
    bitmap = keys.groupBy(F.floor(key_slot / _BUCKET_BITS).alias(bucket)).agg(
        F.bitmap_construct_agg(F.pmod(key_slot, F.lit(_BUCKET_BITS))).alias(bitmap_col)
    )
    bit = F.pmod(row_slot, F.lit(_BUCKET_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bitmap_col), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = rows.withColumn(bucket, F.floor(row_slot / _BUCKET_BITS)).join(F.broadcast(bitmap), bucket, "left" if mark else "inner")
    found = F.getbit(byte, F.pmod(bit, F.lit(8))) == 1
    if mark:
        return joined.withColumn(mark, F.coalesce(found, F.lit(False))).drop(bucket, bitmap_col)
    return joined.where(found).drop(bucket, bitmap_col)


def only_keys(rows: DataFrame, keys: DataFrame, row_key: str, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """Semi-join of ``rows`` with ``keys``, the bitmap first. ``keys`` should be a
    checkpointed or cheap frame: it is read twice."""
    slot = [F.pmod(F.xxhash64(F.col(f"`{c}`").cast("string")), F.lit(bits)) for c in (row_key, key)]
    return maybe_keys(rows, keys, *slot, bits).join(keys, F.col(f"`{row_key}`") == F.col(f"`{key}`"), "left_semi")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a compressed table to the shared checkpoint folder and read back:
    cuts the lineage like a checkpoint, with smaller files."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes what ``stored`` wrote for ``df``, which can't be read any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_path(df.sparkSession, path)
