"""Conversation prefix trie (operator 13): union-find over sorted neighbours.

A conversation is its sequence of turns (role, text); a node of the trie is a
distinct prefix of one. Every turn becomes a 16-byte digest before the first
shuffle, so texts are read once and never moved. The sequences are range-sorted;
equal prefixes then lie side by side. A partition is taken in blocks. Within a
block the edges between neighbours, each as deep as their longest common prefix,
are united in descending depth: a component is a subtree, its chain grows upwards
one turn at a time, and uniting two components makes (or widens) the branching
node at that depth.

Nodes that touch neither end of their block are done. The others lie on the paths
of the block's first and last sequence: that forest is contracted to the nodes
that have something of their own (an end, a branch) and is written as sequences
with sums. These are sorted and united again by the same code, level after level,
until one block holds them all; each level is smaller by the size of a block. A
sequence that ends at a node which crosses blocks hands its id to a table of ids
by node, which is hashed in ascending order by a stream of bounded memory.

Defined cases: a null role or text is empty; turns are ordered by number, nulls
first, and equal numbers by the turn's digest; repeated rows are turns of their
own; rows without a conversation id are left out; an empty table has no nodes;
columns not named are never read. Digests are 128-bit MD5 of the length-prefixed
role and the text, prefix keys 128-bit BLAKE2: equal digests count as equal turns.
A conversation's digests (20 bytes a turn) are one row, as its text would be.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cropledger.llm.words import stored

#: Turns that a block unites at once; more rows of a partition start a new block.
BLOCK_TURNS = 1 << 17
#: Parts a node that is the parent of many others is dealt to in the last join.
SALTS = 32

_TURNS = "array<struct<d:binary,n:int>>"
_SCHEMA = (
    "kind string, key binary, pkey binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    f"n_children long, n_leaves long, saved_tokens long, ends string, turns {_TURNS}"
)
_NONE = np.iinfo(np.int64).max


def turn_sequences(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turns``: the ordered turns (digest, code points of the text) of each conversation."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turn = F.struct(F.col(f"`{turn_col}`").alias("t"), digest.alias("d"), F.char_length(text).alias("n"))
    narrow = rows.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), turn.alias("turn")).where("conv_id IS NOT NULL")
    ordered = F.sort_array(F.collect_list("turn"))
    return narrow.groupBy("conv_id").agg(F.transform(ordered, lambda x: F.struct(x["d"].alias("d"), x["n"].alias("n"))).alias("turns"))


class Block:
    """Sorted sequences with sums at their ends, and the forest over them.

    ``size`` turns of each row, ``word`` the digests as pairs of 64-bit numbers,
    ``chars`` code points. A row's sums belong to the node of its whole sequence.
    """

    def __init__(self, table: pa.Table):
        turns = table.column("turns").combine_chunks()
        off = turns.offsets.to_numpy()
        inner = turns.values.slice(off[0], off[-1] - off[0])
        self.off = (off - off[0]).astype(np.int64)
        self.size = np.diff(self.off)
        self.raw = b"".join(x.as_py() for x in inner.field("d")) if len(inner) else b""
        self.word = np.frombuffer(self.raw, dtype=np.uint64).reshape(-1, 2)
        self.chars = inner.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
        self.n = table.num_rows
        self.sums = [table.column(c).to_pylist() for c in ("n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens")]
        self._keys: dict[int, list[bytes]] = {}

    def common(self) -> np.ndarray:
        """Turns that each row but the first shares with the one before."""
        short = np.minimum(self.size[1:], self.size[:-1])
        first = np.concatenate([[0], np.cumsum(short)])
        at = np.arange(int(first[-1])) - np.repeat(first[:-1], short)
        a = at + np.repeat(self.off[:-2], short)
        b = at + np.repeat(self.off[1:-1], short)
        differs = np.flatnonzero((self.word[a] != self.word[b]).any(axis=1))
        found = np.searchsorted(differs, first[:-1])
        stop = np.append(differs, first[-1])[found]
        return np.minimum(stop, first[1:]) - first[:-1]

    def key(self, row: int, depth: int) -> bytes:
        """Key of the node of the row's first ``depth`` turns."""
        if row not in self._keys:
            h = hashlib.blake2b(digest_size=16)
            keys = [h.digest()]
            for j in range(self.off[row], self.off[row + 1]):
                h.update(self.raw[16 * j : 16 * j + 16])
                keys.append(h.digest())
            self._keys[row] = keys
        return self._keys[row][depth]

    def unite(self, final: bool) -> None:
        """Builds all nodes. ``open`` tells those that may go on in another block;
        they hand nothing to their parents, whose sums stay their own."""
        n = self.n
        self.depth = depth = self.size.tolist()
        self.convs, self.low, self.children, self.leaves, self.saved = ([*x] for x in self.sums)
        convs, low, children, leaves, saved = self.convs, self.low, self.children, self.leaves, self.saved
        self.lo, self.hi = lo, hi = list(range(n)), list(range(n))
        self.end = end = [(i, i + 1) for i in range(n)]  # rows that end at the node
        self.parent = parent = [-1] * n
        self.alias = alias = list(range(n))
        self.open = is_open = [False] * n
        top = list(range(n))  # of a component's first row: its unfinished node
        root = list(range(n))
        off, chars, last = self.off.tolist(), self.chars.tolist(), n - 1

        def close(v: int) -> None:
            if not final and (lo[v] == 0 or hi[v] == last):
                is_open[v] = True
                return
            if not children[v]:
                leaves[v] = 1
            if depth[v]:
                saved[v] += (convs[v] - 1) * chars[off[lo[v]] + depth[v] - 1]

        def climb(v: int, d: int) -> int:
            while depth[v] > d:
                close(v)
                p = len(depth)
                o = is_open[v]
                depth.append(depth[v] - 1)
                convs.append(0 if o else convs[v])
                low.append(_NONE if o else low[v])
                children.append(0 if o else 1)
                leaves.append(0 if o else leaves[v])
                saved.append(0 if o else saved[v])
                lo.append(lo[v])
                hi.append(hi[v])
                end.append(None)
                parent.append(-1)
                alias.append(p)
                is_open.append(False)
                parent[v] = v = p
            return v

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        shared = self.common()
        for e in np.argsort(-shared, kind="stable").tolist():
            d, i, j = int(shared[e]), find(e), find(e + 1)
            a, b = climb(top[i], d), climb(top[j], d)
            convs[a] += convs[b]
            low[a] = min(low[a], low[b])
            children[a] += children[b]
            leaves[a] += leaves[b]
            saved[a] += saved[b]
            lo[a], hi[a] = min(lo[a], lo[b]), max(hi[a], hi[b])
            if end[b]:
                end[a] = (min(end[a][0], end[b][0]), max(end[a][1], end[b][1])) if end[a] else end[b]
            alias[b] = a
            root[j] = i
            top[i] = a
        close(climb(top[find(0)], 0))

    def node(self, v: int) -> int:
        """The node that ``v`` was united into."""
        alias = self.alias
        while alias[v] != v:
            alias[v] = alias[alias[v]]
            v = alias[v]
        return v

    def rows(self, first_level: bool) -> pa.RecordBatch:
        out: dict[str, list] = {c: [] for c in (f.split()[0] for f in _SCHEMA.split(", "))}

        def add(**row) -> None:
            for c, values in out.items():
                values.append(row.get(c))

        for v in range(len(self.depth)):
            if self.alias[v] != v:
                continue
            at, d = self.lo[v], self.depth[v]
            ids = None
            if first_level and self.end[v]:
                ids = ",".join(map(str, self.sums[1][self.end[v][0] : self.end[v][1]]))
            sums = dict(conv_id=self.low[v], n_convs=self.convs[v], n_children=self.children[v], n_leaves=self.leaves[v], saved_tokens=self.saved[v])
            if not self.open[v]:
                p = self.node(self.parent[v]) if self.parent[v] >= 0 else None
                known = p is None or not self.open[p]
                add(
                    kind="node",
                    key=None if first_level else self.key(at, d),
                    pkey=None if known else self.key(at, d - 1),
                    depth=d,
                    parent_conv_id=self.low[p] if p is not None and known else None,
                    ends=hashlib.sha256((ids or "").encode()).hexdigest() if first_level else None,
                    **sums,
                )
                continue
            if ids:
                add(kind="ends", key=self.key(at, d), conv_id=self.sums[1][self.end[v][0]], ends=ids)
            if self.convs[v]:
                j = int(self.off[at])
                turns = [{"d": self.raw[16 * k : 16 * k + 16], "n": int(self.chars[k])} for k in range(j, j + d)]
                add(kind="path", turns=turns, **sums)
        turn_type = pa.list_(pa.struct([("d", pa.binary()), ("n", pa.int32())]))
        types = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
        kinds = [types.get(f.split()[1], turn_type) for f in _SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(values, t) for values, t in zip(out.values(), kinds)], names=list(out))


def _forests(first_level: bool, final: bool, block_turns: int):
    """Blocks of a sorted partition; a final level is a single block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0

        def flush() -> pa.RecordBatch:
            block = Block(pa.Table.from_batches(held))
            block.unite(final)
            held.clear()
            return block.rows(first_level)

        for batch in batches:
            if not batch.num_rows:
                continue
            if held and turns >= block_turns and not final:
                yield flush()
                turns = 0
            held.append(batch)
            turns += batch.num_rows + len(batch.column("turns").flatten())
        if held:
            yield flush()

    return run


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per key over chunks that come in order of key and first id."""
    key, h = None, None
    names = ["ekey", "sha"]
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k == key:
                h.update(b"," + text.encode())
                continue
            if h:
                done.append((key, h.hexdigest()))
            key, h = k, hashlib.sha256(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
    if h:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([h.hexdigest()])], names=names)


def prefix_trie(seqs: DataFrame, block_turns: int = BLOCK_TURNS, salts: int = SALTS) -> DataFrame:
    """The nodes of the trie of ``seqs`` (``conv_id, turns``; ids distinct):
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    one = F.lit(1).cast("long")
    zero = F.lit(0).cast("long")
    start = seqs.select("conv_id", "turns", one.alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
    ordered = start.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    levels = [stored(ordered.mapInArrow(_forests(True, False, block_turns), _SCHEMA))]
    before = None
    while True:
        paths = levels[-1].where("kind = 'path'").select(*start.columns)
        total = paths.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
        # a level that no longer shrinks holds sequences longer than a block: one task ends it
        final = total <= block_turns or (before is not None and 2 * total > before)
        parts = 1 if final else -(-total // block_turns)
        spread = paths.repartition(1) if final else paths.repartitionByRange(parts, "turns", "conv_id")
        ordered = spread.sortWithinPartitions("turns", "conv_id")
        levels.append(stored(ordered.mapInArrow(_forests(False, final, block_turns), _SCHEMA)))
        before = total
        if final:
            break

    chunks = levels[0].where("kind = 'ends'").select("key", "conv_id", "ends")
    ends = chunks.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_hash_ends, "ekey binary, sha string")
    nodes = [t.where("kind = 'node'").drop("kind", "turns") for t in levels]
    late = nodes[1]
    for t in nodes[2:]:
        late = late.unionByName(t)
    late = late.join(ends, F.col("key") == F.col("ekey"), "left").withColumn("ends", F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)))
    late = stored(late.drop("ekey", "sha"))
    both = nodes[0].unionByName(late)
    # parents that cross blocks are few, but one of them may have most of the nodes as children
    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(salts)).cast("int")
    parents = late.select(F.col("key").alias("up"), F.col("conv_id").alias("up_id"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    waiting = both.where("pkey IS NOT NULL").withColumn("s", salt)
    found = waiting.join(parents, (F.col("pkey") == F.col("up")) & (F.col("s") == F.col("salt"))).withColumn("parent_conv_id", F.col("up_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    return both.where("pkey IS NULL").select(*columns).union(found.select(*columns))


def rebuilt(seqs: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """The contract's input: the first h turns of conversation c - c % ``every``, then
    c's own after its first h, with h = crc32(c) % ``most``."""
    base = F.col("conv_id") - F.col("conv_id") % every
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    heads = F.max(F.when(F.col("conv_id") == F.col("_base"), F.slice("turns", 1, most - 1))).over(Window.partitionBy("_base"))
    own = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    head: Column = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), F.array().cast(_TURNS))
    return seqs.withColumn("_base", base).withColumn("_h", h).withColumn("_head", heads).select("conv_id", F.concat(head, own).alias("turns"))


NAME = "op13_prefix_trie"

#: The nodes straight from the definition: every prefix as a list, grouped.
ORACLE = """
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 AS b, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM (SELECT DISTINCT c FROM turns)),
sized AS (SELECT c, b, xor(crc, 4294967295) % 6 AS h FROM convs),
moved AS (
  SELECT s.c, t.i, t.role, t.text FROM sized s JOIN turns t ON t.c = s.b AND t.i <= s.h
  UNION ALL
  SELECT s.c, t.i, t.role, t.text FROM sized s JOIN turns t ON t.c = s.c AND t.i > s.h),
seqs AS (
  SELECT s.c, coalesce(q.seq, []) AS seq FROM sized s LEFT JOIN (
    SELECT c, list({'r': role, 'x': text} ORDER BY i) AS seq FROM moved GROUP BY c) q USING (c)),
prefixes AS (
  SELECT c, d, seq[1:d] AS p, d = len(seq) AS whole FROM (SELECT c, seq, unnest(range(0, len(seq) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE whole) AS ends
  FROM prefixes GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (
  SELECT n.d, n.p, n.conv_id, n.n, coalesce(k.k, 0) AS k, n.ends,
         CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * length(n.p[n.d].x) END AS saved
  FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.p = n.p),
up AS (
  SELECT a.d, a.p[1:a.d] AS p, sum(saved) AS saved, sum(leaf) AS leaves
  FROM (SELECT unnest(range(0, d + 1)) AS d, p, saved, CASE WHEN k = 0 THEN 1 ELSE 0 END AS leaf FROM full_nodes) a
  GROUP BY 1, 2)
SELECT n.conv_id, n.d::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, n.k::BIGINT AS n_children,
       u.leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM full_nodes n JOIN up u ON u.d = n.d AND u.p = n.p
LEFT JOIN nodes q ON q.d = n.d - 1 AND q.p = n.p[1:n.d - 1]
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(turn_sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
