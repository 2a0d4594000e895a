"""Token ids in binary files, compressed by Re-Pair grammars (operator 9).

Documents are sorted by id over the partitions (a range partitioning), encoded,
and cut into shards of about ``SHARD_IDS`` ids, whole documents each. In a shard
frequent pairs of neighbouring symbols are replaced by new symbols, round after
round, until a round no longer pays. Pairs never cross documents.

The format is Parquet, a row per shard (all integers little-endian):
``part, shard`` order of the shards; ``n_docs, n_ids``; ``doc_ids`` (list);
``doc_at`` (u32: each document's first symbol, n_docs + 1); ``rules`` (u32 pairs:
symbol ``base + i`` stands for pair i); ``lengths`` (u32: ids each rule expands
to); ``base``; ``width`` (bytes of a symbol) and ``symbols``. Expansion lengths
allow random access: ``read_ids`` finds a range of ids by the running total of the
symbols' lengths and expands only the symbols it touches.

A null or empty text has its end id only. Rows with a null id sort first and are
stored like others; rows that share an id are stored one after the other, in the order of
their texts' hashes. An empty table writes an empty file and reads as no rows. Other columns are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from cropledger.llm.pieces import LibraryEncoder, cache_for, encoded_blocks
from cropledger.session import ensure_checkpoint_dir

SHARD_IDS = 1 << 20
END_ID = 2
#: A pair must occur so often in a shard to be replaced; a round replaces so many
#: pairs at most; rounds go on while they save this share of the symbols.
LEAST, PAIRS, GAIN = 16, 2048, 0.01
SLOTS = 1 << 18


def re_pair(ids: np.ndarray, first: np.ndarray, base: int, least: int = LEAST, pairs: int = PAIRS, gain: float = GAIN):
    """(symbols, each document's first symbol, rules, lengths). ``first``: offsets of
    the documents in ``ids`` (n + 1)."""
    seq = ids.astype(np.uint32)
    heads = np.zeros(len(seq) + 1, dtype=bool)
    heads[first] = True
    heads = heads[:-1]
    starts_empty = np.diff(first) == 0
    assert not starts_empty.any(), "a document has an id at least"
    rules: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    size = np.ones(base, dtype=np.int64)
    while len(seq) > 1:
        a, b = seq[:-1], seq[1:]
        # pairs are counted by slots of a hash: a slot counts one pair exactly, the last that
        # fell into it; pairs that lost their slot come up again when the others are replaced
        slot = a * np.uint32(0x9E3779B1)
        slot += b * np.uint32(0x85EBCA77)
        slot >>= 7
        slot &= SLOTS - 1
        slot = slot.astype(np.int64)
        slot[np.flatnonzero(heads[1:])] = SLOTS  # not a pair: a document ends between the two
        pair = a.astype(np.int64)
        pair <<= 32
        pair |= b
        holder = np.zeros(SLOTS + 1, dtype=np.int64)
        holder[slot] = pair
        np.putmask(slot, holder.take(slot) != pair, SLOTS)
        count = np.bincount(slot, minlength=SLOTS)[:SLOTS]
        top = np.flatnonzero(count >= least)
        if not len(top):
            break
        top = top[np.argsort(-count[top], kind="stable")[:pairs]]
        number = np.full(SLOTS + 1, -1, dtype=np.int32)
        number[top] = np.arange(len(top))
        which = number.take(slot)
        at = np.flatnonzero(which >= 0)
        which = which[at]
        # occurrences that overlap form runs; every second one of a run is taken
        run = np.concatenate([[True], np.diff(at) > 1])
        place = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        taken = place % 2 == 0
        at, which = at[taken], which[taken]
        if len(at) < gain * len(seq):
            break
        used = np.bincount(which, minlength=len(top)) > 0
        top, which = top[used], (np.cumsum(used) - 1)[which]
        new = np.column_stack([holder[top] >> 32, holder[top] & 0xFFFFFFFF])
        rules.append(new)
        lengths.append(size[new].sum(axis=1))
        symbol = len(size)
        size = np.concatenate([size, lengths[-1]])
        seq[at] = symbol + which
        stay = np.ones(len(seq), dtype=bool)
        stay[at + 1] = False
        left = np.flatnonzero(stay)
        seq, heads = seq.take(left), heads.take(left)
    doc_at = np.append(np.flatnonzero(heads), len(seq))
    none = np.zeros((0, 2), dtype=np.int64)
    return seq.astype(np.int64), doc_at, np.concatenate([none, *rules]), np.concatenate([none[:, 0], *lengths])


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for: all rules of a level are applied at once."""
    seq = symbols.astype(np.int64)
    while len(at := np.flatnonzero(seq >= base)):
        twice = np.ones(len(seq), dtype=np.int64)
        twice[at] = 2
        head = np.cumsum(twice) - twice
        out = np.repeat(seq, twice)
        out[head[at]] = rules[seq[at] - base, 0]
        out[head[at] + 1] = rules[seq[at] - base, 1]
        seq = out
    return seq


class Shard:
    """A stored shard, opened."""

    def __init__(self, row: dict):
        self.base = row["base"]
        self.symbols = np.frombuffer(row["symbols"], dtype=f"<u{row['width']}")
        self.doc_at = np.frombuffer(row["doc_at"], dtype="<u4").astype(np.int64)
        self.rules = np.frombuffer(row["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2)
        self.lengths = np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64)
        self.n_ids = row["n_ids"]
        self._total: np.ndarray | None = None

    def symbol_lengths(self) -> np.ndarray:
        s = self.symbols.astype(np.int64)
        return np.where(s >= self.base, self.lengths[np.maximum(s - self.base, 0)] if len(self.lengths) else 1, 1)

    def document_starts(self) -> np.ndarray:
        """Each document's first id (n_docs + 1), from the expansion lengths."""
        return np.concatenate([[0], np.cumsum(self.symbol_lengths())])[self.doc_at]

    def all_ids(self) -> np.ndarray:
        """Each rule is expanded once; the symbols take their ids from there."""
        table = np.concatenate([np.arange(self.base), expand(self.base + np.arange(len(self.rules)), self.rules, self.base)])
        start = np.concatenate([np.arange(self.base), self.base + np.cumsum(self.lengths) - self.lengths])
        n = self.symbol_lengths()
        at = np.repeat(start[self.symbols] - (np.cumsum(n) - n), n)
        at += np.arange(len(at))
        return table[at]

    def document(self, i: int) -> np.ndarray:
        return expand(self.symbols[self.doc_at[i] : self.doc_at[i + 1]], self.rules, self.base)

    def read_ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` of the shard."""
        if self._total is None:
            self._total = np.concatenate([[0], np.cumsum(self.symbol_lengths())])
        end = min(start + n, int(self._total[-1]))
        if start >= end:
            return np.zeros(0, dtype=np.int64)
        x = int(np.searchsorted(self._total, start, "right")) - 1
        y = int(np.searchsorted(self._total, end, "left"))
        return expand(self.symbols[x:y], self.rules, self.base)[start - self._total[x] : end - self._total[x]]


def write(docs: DataFrame, out: str, path: str, id_col: str = "doc_id", text_col: str = "text", spaced: bool = True, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` by the vocabulary at ``path`` and write shards to ``out``."""
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = cache_for("library", path, LibraryEncoder, spaced)
        base = max(cache.encode_pieces.tokenizer.get_vocab_size(), end_id + 1)
        end = np.array([end_id], dtype=np.int32).tobytes()
        part, number, ids, bodies, n = TaskContext.get().partitionId(), 0, [], [], 0

        def shard() -> pa.RecordBatch:
            first = np.concatenate([[0], np.cumsum([len(x) // 4 for x in bodies])])
            flat = np.frombuffer(b"".join(bodies), dtype=np.int32)
            symbols, doc_at, rules, lengths = re_pair(flat, first, base)
            width = 2 if base + len(rules) <= 1 << 16 else 4
            values = [part, number, len(ids), len(flat), ids, doc_at.astype("<u4").tobytes(), rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), base, width, symbols.astype(f"<u{width}").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for lo, encoded in encoded_blocks(batch.column(1), cache):
                for i, body in enumerate(encoded):
                    ids.append(keys[lo + i])
                    bodies.append(body + end)
                    n += len(body) // 4 + 1
                    if n >= shard_ids:
                        yield shard()
                        number, ids, bodies, n = number + 1, [], [], 0
        if ids:
            yield shard()

    id_type = kind.simpleString()
    schema = f"part int, shard int, n_docs int, n_ids long, doc_ids array<{id_type}>, doc_at binary, rules binary, lengths binary, base int, width int, symbols binary"
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(to_arrow_type(kind)), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
    rows.mapInArrow(run, schema).write.mode("overwrite").option("compression", "zstd").parquet(out)


def read(spark: SparkSession, out: str, id_col: str = "doc_id") -> DataFrame:
    """Per stored document ``id_col, start`` (ids of all documents before it) and
    ``ids`` (little-endian unsigned 32-bit)."""
    shards = spark.read.parquet(out)
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    # one narrow row per shard: the only thing that is ordered as a whole
    starts = shards.select("part", "shard", "n_ids").select(
        F.col("part").alias("p"), F.col("shard").alias("s"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before")
    )
    kind = shards.schema["doc_ids"].dataType.elementType
    cols = ["n_ids", "doc_ids", "doc_at", "rules", "lengths", "base", "width", "symbols"]
    joined = shards.join(starts, (F.col("part") == F.col("p")) & (F.col("shard") == F.col("s"))).select("before", *cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                shard = Shard(row)
                at, flat = shard.document_starts(), shard.all_ids().astype("<u4")
                bodies = [flat[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]
                starts = at[:-1] + row["before"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], to_arrow_type(kind)), pa.array(starts, pa.int64()), pa.array(bodies, pa.binary())], names=["id", "start", "ids"]
                )

    return joined.mapInArrow(run, f"id {kind.simpleString()}, start long, ids binary").withColumnRenamed("id", id_col)


NAME, ORACLE = "op9_token_files", None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write(docs, out, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, out).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
