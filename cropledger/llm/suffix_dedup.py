"""Suffix-array dedup: maximal repeats from common-prefix intervals (operator 8).

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts
anywhere else in the corpus, in the same or another document. Matches never
cross documents; overlaps count; strings are judged on the input.

1. Anchors. In every window of ``LENGTH`` bytes the ``GRAM``-byte grams of
   smallest hash are anchors. The choice depends on the window's bytes alone, so
   equal strings have equal anchors at equal places. Around an anchor lies its
   context: the windows that have it as their anchor. Anchors (hash, count) are
   aggregated; those found once can't lie in a repeat.
2. Contexts of repeated anchors are grouped by (anchor, context digest). A digest
   found twice repeats as a whole. Bytes are kept of one occurrence per digest,
   and only for anchors that have several digests.
3. Parts of anchors go to tasks by anchor hash. Each part concatenates its
   contexts, builds their suffix array (prefix doubling), the common prefixes of
   neighbours, and scans them with a stack: every interval of the common-prefix
   tree of ``LENGTH`` bytes or more whose suffixes differ in the byte to their
   left (or start a context) is a maximal repeat. The tree is kept as it is: a row
   per interval and a row per suffix, so nested repeats cost no more rows than
   there are suffixes; an interval's occurrences are its range of suffixes.
4. A suffix is removed to the depth of its deepest interval. Spans are united per
   document.

An anchor with more than ``BLOCK`` different contexts (a passage in very many
documents has them at its edges) is cut finer first: into strips of 16 window
starts, grouped by the bytes that all windows of a strip cover, equal strips
taken together, and what is still larger into single windows, whose equality is
a plain aggregation. So no group of the scan grows without bound.
A repeat longer than a context appears as overlapping groups, one per anchor.

Null and empty texts have no bytes and lose none. Texts shorter than ``LENGTH``
lose none. Rows with a null id take part in no match and are left out. Rows that
share an id are different documents (told apart by a digest of their text); rows
equal in id and text are copies of each other, and each loses what it shares. Other columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm.words import FILTER_BITS, blocks, give_back, maybe_keys, mix, prefix_hash, powers
from cropledger.session import cut_lineage

LENGTH = 400
GRAM = 64
BLOCK = 512
#: Bytes of texts whose contexts are found at once.
CONTEXT_BYTES = 1 << 18

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of ``x[s:s + w]`` for each s that has a whole window."""
    n = len(x)
    m = -(-n // w) * w
    a = np.full(m, _NONE)
    a[:n] = x
    a = a.reshape(-1, w)
    left = np.minimum.accumulate(a, axis=1).ravel()
    right = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def contexts(buf: np.ndarray, off: np.ndarray, length: int, gram: int):
    """The anchor contexts of documents ``off`` of ``buf``: document, start, end
    (of the context's bytes), anchor's offset in it, anchor hash, digest. Each
    window of ``length`` bytes lies in exactly one context, that of the leftmost of its
    grams of smallest hash."""
    w = length - gram + 1
    n = len(buf)
    has = np.flatnonzero(np.diff(off) >= length)
    if not len(has):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z, z.view(np.uint64), z.view(np.uint64)
    s = prefix_hash(buf)
    inv = powers(n + 1)[1]
    h = mix((s[gram:] - s[:-gram]) * inv[: n + 1 - gram] + np.uint64(gram))
    low32 = np.uint64(0xFFFFFFFF)
    m = _sliding_min((h & ~low32) | np.arange(len(h), dtype=np.uint64), w) & low32
    count = off[has + 1] - off[has] - length + 1
    doc = np.repeat(has, count)
    start = np.arange(int(count.sum())) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count) + off[doc]
    anchor = m[start].astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.append(new[1:], len(start)) - 1
    lo, end, p, doc = start[new], start[last] + length, anchor[new], doc[new]
    digest = mix((s[end] - s[lo]) * inv[lo] + ((end - lo) * 65536 + (p - lo)).astype(np.uint64))
    return doc, lo, end, p - lo, h[p], digest


def _emit(length: int, gram: int, anchors_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for b in blocks(batch.column(2), CONTEXT_BYTES):
                doc, lo, end, aoff, anchor, digest = contexts(b.buf, b.off, length, gram)
                if not len(doc):
                    continue
                if anchors_only:
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64))], names=["anchor"])
                    continue
                at = pa.array(doc + b.lo)
                base = b.off[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(digest.view(np.int64)),
                        ids.take(at),
                        keys.take(at),
                        pa.array(lo - base),
                        pa.array((end - lo).astype(np.int32)),
                        pa.array(aoff.astype(np.int32)),
                    ],
                    names=["anchor", "digest", "id", "th", "lo", "n", "aoff"],
                )
        give_back()

    return run


#: The left bytes of an interval differ, or one of its suffixes starts a text.
DIVERSE = -1

# -- enhanced suffix array of a batch of contexts ------------------------------------


class SuffixArray:
    """Suffixes of ``length`` bytes or more of texts, in order, with the common
    prefix of neighbours. Texts of different ``group`` share no prefix, and no
    prefix passes a text's end."""

    def __init__(self, texts: list[bytes], group: np.ndarray, length: int):
        self.size = np.array([len(t) for t in texts], dtype=np.int64)
        self.head = np.concatenate([[0], np.cumsum(self.size)])
        self.buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
        n = len(self.buf)
        self.text = np.repeat(np.arange(len(texts)), self.size)
        self.left = np.repeat(self.head[1:], self.size) - np.arange(n)  # bytes to the text's end
        most = int(self.size.max())
        # ranks of the first k bytes, k doubling; a suffix shorter than k has no rank of k
        packed = np.zeros(n + 8, dtype=np.uint64)
        for j in range(8):
            packed[:n] |= np.append(self.buf[j:], np.zeros(j, np.uint8)).astype(np.uint64) << np.uint64(8 * (7 - j))
        rank = self._ranks(group[self.text].astype(np.uint64), packed[:n], self.left >= 8)
        self.rank = {8: rank}
        k = 8
        while 2 * k <= most:
            nxt = np.append(rank[k:], np.full(k, -1, dtype=np.int64))
            rank = self._ranks(rank, nxt, self.left >= 2 * k)
            k *= 2
            self.rank[k] = rank
        # order: by the longest power of two below length, then by what follows it
        k = max(x for x in self.rank if x <= length)
        start = np.flatnonzero(self.left >= length)
        first, nxt = self.rank[k], self.rank[k][start + (length - k)]
        # equal first `length` bytes come together; only they are ordered further
        order = np.lexsort((nxt, first[start]))
        start = start[order]
        same = (first[start[1:]] == first[start[:-1]]) & (nxt[order][1:] == nxt[order][:-1])
        run = np.concatenate([[0], np.cumsum(~same)])
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        start, run = start[keep], run[keep]
        at = np.full(len(start), length, dtype=np.int64)
        keys = []
        while len(start) and (at < most).any():  # 8 bytes at a time behind the shared prefix
            pos = start + at
            inside = self.left[start] > at
            key = np.where(inside, packed[np.minimum(pos, n)], 0)
            cut = np.clip(self.left[start] - at, 0, 8)
            key &= np.where(cut > 0, ~np.uint64(0) << (np.uint64(64) - np.uint64(8) * np.maximum(cut, 1).astype(np.uint64)), 0)
            keys.append(key)
            at += 8
        order = np.lexsort((self.left[start], *reversed(keys), run)) if keys else np.arange(len(start))
        self.start, self.run = start[order], run[order]
        self.lcp = self._common(self.start[:-1], self.start[1:])
        self.lcp[self.run[1:] != self.run[:-1]] = 0

    @staticmethod
    def _ranks(a: np.ndarray, b: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Dense ranks of the pairs (a, b) where valid, else -1."""
        out = np.full(len(a), -1, dtype=np.int64)
        at = np.flatnonzero(valid)
        if len(at):
            x, y = a[at], b[at]
            if x.dtype == np.int64:  # ranks: one key holds both
                x = x * (int(y.max()) + 1) + y
                order = np.argsort(x)
                x = x[order]
                new = x[1:] != x[:-1]
            else:
                order = np.lexsort((y, x))
                x, y = x[order], y[order]
                new = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            out[at[order]] = np.concatenate([[0], np.cumsum(new)])
        return out

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at a and b share, to the end of either text."""
        got = np.zeros(len(a), dtype=np.int64)
        most = np.minimum(self.left[a], self.left[b])
        for k in sorted(self.rank, reverse=True):
            while True:
                fits = got + k <= most
                x, y = np.where(fits, a + got, 0), np.where(fits, b + got, 0)
                same = fits & (self.rank[k][x] == self.rank[k][y])
                if not same.any():
                    break
                got[same] += k
        for _ in range(7):
            fits = got < most
            x, y = np.where(fits, a + got, 0), np.where(fits, b + got, 0)
            got += fits & (self.buf[x] == self.buf[y])
            # a byte that differs ends the prefix: later bytes must not count
            most = np.where(fits & (self.buf[x] != self.buf[y]), got, most)
        return got

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """Maximal repeats as intervals (bytes, first, last place in ``start``), and for
        each place the bytes of the deepest interval it lies in (0: none). A scan of the common
        prefixes with a stack closes each interval of the tree once, inner ones first;
        its left diversity is the union of its children's left bytes."""
        found, deepest = [], np.zeros(len(self.start), dtype=np.int64)
        if not len(self.start):
            return np.zeros((0, 3), dtype=np.int64), deepest
        at_head = self.left[self.start] == self.size[self.text[self.start]]
        before = np.where(at_head, -1, self.buf[np.maximum(self.start - 1, 0)].astype(np.int64))
        heads = np.flatnonzero(np.concatenate([[True], self.run[1:] != self.run[:-1]]))
        tails = np.append(heads[1:], len(self.start))
        low, high = np.minimum.reduceat(before, heads), np.maximum.reduceat(before, heads)
        # a run whose suffixes all have one left byte holds no left-diverse interval
        mixed = (low != high) | (low < 0)
        for lo, hi in zip(heads[mixed].tolist(), tails[mixed].tolist(), strict=True):
            lcp, side = self.lcp[lo : hi - 1].tolist(), before[lo:hi].tolist()
            stack: list[list[int]] = []  # [common prefix, left end, left byte or DIVERSE]
            free = [lo]  # places that no closed interval holds, in order
            at, have = lo, side[0]  # the interval or suffix closed last
            for i in range(lo + 1, hi + 1):
                depth = lcp[i - 1 - lo] if i < hi else 0
                while stack and stack[-1][0] > depth:
                    d, at, s = stack.pop()
                    have = s if s == have else DIVERSE
                    if have == DIVERSE:
                        found.append((d, at, i - 1))
                        while free and free[-1] >= at:
                            deepest[free.pop()] = d
                if depth:
                    if stack and stack[-1][0] == depth:
                        stack[-1][2] = have if have == stack[-1][2] else DIVERSE
                    else:
                        stack.append([depth, at, have])
                if i < hi:
                    at, have = i, side[i - lo]
                    free.append(i)
        return np.array(found, dtype=np.int64).reshape(-1, 3), deepest


def repeat_tree(texts: list[bytes], group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Intervals (bytes, first, last place), and the places in them: (place, bytes of
    the deepest interval, text, offset)."""
    array = SuffixArray(texts, group, length)
    found, deepest = array.repeats()
    at = np.flatnonzero(deepest)
    start = array.start[at]
    text = array.text[start]
    return found, np.stack([at, deepest[at], text, start - array.head[text]], axis=1)


BATCH_BYTES = 1 << 20
#: Bytes of contexts that a task of the scan gets on average.
TASK_BYTES = 2 << 20


def _scan(length: int):
    """Rows sorted by group: batches of whole groups through the suffix array."""

    def flush(groups: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(groups, ignore_index=True)
        number = np.unique(rows["anchor"].to_numpy(), return_inverse=True)[1]
        found, places = repeat_tree(rows["bytes"].tolist(), number, length)
        own = rows.iloc[places[:, 2]]
        part = int(rows["anchor"].iloc[0])  # whole anchors: no other part begins with it
        tree = pd.DataFrame({"part": part, "repeat": np.arange(len(found)), "n": found[:, 0], "first": found[:, 1], "last": found[:, 2]})
        leaf = pd.DataFrame(
            {
                "part": part,
                "repeat": -1,
                "n": places[:, 1],
                "first": places[:, 0],
                "last": places[:, 0],
                "id": own["id"].to_numpy(),
                "th": own["th"].to_numpy(),
                "start": own["lo"].to_numpy() + places[:, 3],
            }
        )
        return pd.concat([tree.assign(id=None, th=None, start=None).astype({"th": "Int64", "start": "Int64"}), leaf.astype({"th": "Int64", "start": "Int64"})]).astype({"id": object})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_group, ready, size = None, [], 0
        for frame in frames:
            for anchor, rows in frame.groupby("anchor", sort=False):
                if open_group is not None and anchor != open_group:
                    if size >= BATCH_BYTES:
                        yield flush(ready)
                        ready, size = [], 0
                open_group = anchor
                ready.append(rows)
                size += int(rows["bytes"].str.len().sum())
        if ready:
            yield flush(ready)
        give_back()

    return run


def _cut(strip: int, length: int):
    """Contexts cut into strips of ``strip`` window starts by distance to the anchor;
    rows of a strip that can share a window have equal cores, which name their group."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                size, aoff = len(r.bytes), int(r.aoff)
                first, last = aoff - (size - length), aoff  # distances of the windows to the anchor
                for k in range(max(first, 0) // strip, last // strip + 1):
                    far, near = min(last, k * strip + strip - 1), max(first, k * strip)
                    piece = r.bytes[aoff - far : aoff - near + length]
                    # the bytes that every window of the strip covers
                    a, b = aoff - (k * strip + strip - 1), aoff - k * strip + length
                    core = r.bytes[max(a + strip - 1, 0) : max(b - strip + 1, 0)]
                    head = hashlib.blake2b(core, digest_size=8, key=int(r.anchor).to_bytes(8, "little", signed=True) + k.to_bytes(4, "little")).digest()
                    body = hashlib.blake2b(piece, digest_size=8, key=far.to_bytes(4, "little")).digest()
                    out.append((int.from_bytes(head, "little", signed=True), int.from_bytes(body, "little", signed=True), r.id, r.th, int(r.lo) + aoff - far, far, piece))
            yield pd.DataFrame(out, columns=["anchor", "digest", "id", "th", "lo", "aoff", "bytes"])

    return run


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the contexts listed for each text."""
    for frame in batches:
        out = []
        for r in frame.itertuples(index=False):
            data = (r.t or "").encode()
            out.extend((c["anchor"], c["digest"], r.id, r.th, c["lo"], c["aoff"], data[c["lo"] : c["lo"] + c["n"]]) for c in r.wanted)
        yield pd.DataFrame(out, columns=["anchor", "digest", "id", "th", "lo", "aoff", "bytes"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(t).alias("th"), t.alias("t"))


def maximal_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int | None = None, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """(tree, copies). ``tree``: within a ``part`` a row for each maximal repeat (``repeat``
    0, 1, ..., ``n`` bytes, ``first`` to ``last`` the places of its occurrences) and for each
    place (``repeat`` -1, ``first`` its number, ``id, th, start`` where it is, ``n`` the bytes of
    the longest repeat that starts there); ``occurrences`` puts them together.
    ``copies``: the contexts that recur as a whole: ``anchor, digest, id, th, start, n``.
    ``th`` is the hash of the text, which tells rows of one id apart."""
    gram = gram or min(GRAM, length // 2)
    rows = _keyed(docs, id_col, text_col).where("id IS NOT NULL")
    id_type = rows.schema["id"].dataType.simpleString()
    fields = f"anchor long, digest long, id {id_type}, th long, lo long, n int, aoff int"
    anchors = rows.mapInArrow(_emit(length, gram, True), "anchor long").groupBy("anchor").count().where("count > 1")
    anchors = cut_lineage(anchors.select("anchor"))
    slot = F.pmod(F.xxhash64("anchor"), F.lit(FILTER_BITS))
    found = maybe_keys(rows.mapInArrow(_emit(length, gram, False), fields), anchors, slot, slot)
    found = cut_lineage(found.join(anchors, "anchor", "left_semi"))
    digests = cut_lineage(
        found.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("id", "th", "lo", "n", "aoff")).alias("r"))
    )
    copies = found.join(digests.where("c > 1").select("anchor", "digest"), ["anchor", "digest"], "left_semi").select(
        "anchor", "digest", "id", "th", F.col("lo").alias("start"), "n"
    )
    many = digests.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("least")).where("m > 1 AND least = 1")
    reps = cut_lineage(digests.join(many.select("anchor", "m"), "anchor").select("anchor", "digest", "m", "r.*"))
    lists = cut_lineage(
        reps.groupBy(F.col("id").alias("_i"), F.col("th").alias("_h")).agg(
            F.collect_list(F.struct("anchor", "digest", "lo", "n", "aoff")).alias("wanted")
        )
    )
    row_slot, key_slot = (F.pmod(F.xxhash64(*c), F.lit(FILTER_BITS)) for c in (("id", "th"), ("_i", "_h")))
    texts = maybe_keys(rows, lists, row_slot, key_slot)
    texts = texts.join(lists, (F.col("id") == F.col("_i")) & (F.col("th") == F.col("_h"))).select("id", "th", "t", "wanted")
    fields = f"anchor long, digest long, id {id_type}, th long, lo long, aoff int, bytes binary"
    held = texts.mapInPandas(_extract, fields).dropDuplicates(["anchor", "digest"])
    held = cut_lineage(held.join(many.select("anchor", "m"), "anchor"))

    parts = []
    for strip in (16, 1):
        parts.append(held.where(F.col("m") <= block).drop("m", "digest", "aoff"))
        cut = held.where(F.col("m") > block).drop("m").mapInPandas(_cut(strip, length), fields)
        # equal strips: one row stands for all of a digest, their spans are passed back as copies
        cut = cut_lineage(cut)
        again = cut.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor", "digest")
        copies = copies.union(
            cut.join(again, ["anchor", "digest"], "left_semi").select(
                "anchor", "digest", "id", "th", F.col("lo").alias("start"), F.length("bytes").alias("n")
            )
        )
        one = cut.dropDuplicates(["anchor", "digest"])
        held = cut_lineage(one.join(one.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "anchor"))
    # strips of one window: a group's rows are equal, so nothing is left in `held`
    work = parts[0].unionByName(parts[1])
    # a byte costs far more here than elsewhere: tasks by bytes, not left to the shuffle's size
    size = work.agg(F.sum(F.length("bytes"))).first()[0] or 0
    groups = (
        work.repartition(max(8, -(-size // TASK_BYTES)), "anchor")
        .sortWithinPartitions("anchor")
        .mapInPandas(_scan(length), f"part long, repeat long, n long, first long, last long, id {id_type}, th long, start long")
    )
    return cut_lineage(groups), copies


def occurrences(tree: DataFrame) -> DataFrame:
    """``part, repeat, n, id, th, start``: every occurrence of every repeat of ``tree`` (as
    many rows as all repeats have occurrences, nested ones counted each)."""
    repeats = tree.where("repeat >= 0").select("part", "repeat", "n", "first", "last")
    places = tree.where("repeat < 0").select("part", F.col("first").alias("place"), "id", "th", "start")
    inside = (F.col("place") >= F.col("first")) & (F.col("place") <= F.col("last"))
    return repeats.join(places, "part").where(inside).select("part", "repeat", "n", "id", "th", "start")


def _strip(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            n_bytes, n_removed, n_spans, sha, kept = [], [], [], [], []
            for t, spans in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                text = t.as_py()
                data = (text or "").encode()
                merged: list[list[int]] = []
                for s in sorted((x["start"], x["end"]) for x in spans or []):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append([*s])
                edges = [0, *(x for m in merged for x in m), len(data)]
                left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if merged else data
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(left))
                n_spans.append(len(merged))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append((left.decode("utf-8", "ignore") if merged else text) if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[2:], pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                names=[*part.schema.names[2:], "n0", "n1", "n2", "n3", "n4"],
            )
    give_back()


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_text: bool = True, columns: list[str] | None = None, **params
) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, kept_sha256, kept_text`` (the
    remaining bytes as text, characters that a cut has broken left out; a text that loses
    nothing as it is, null included). Rows with a null id keep their text whole.
    ``columns``: those to pass on (all). A column of one of the new names is replaced."""
    tree, copies = maximal_repeats(docs, id_col, text_col, length, **params)
    spans = tree.where("repeat < 0").select("id", "th", "start", (F.col("start") + F.col("n")).alias("end")).union(
        copies.select("id", "th", "start", (F.col("start") + F.col("n")).alias("end"))
    )
    # of the spans that start at one byte only the longest matters
    longest = spans.groupBy("id", "th", "start").agg(F.max("end").alias("end"))
    by_doc = cut_lineage(
        longest.groupBy(F.col("id").alias("_i"), F.col("th").alias("_h")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    new = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    names = [c for c in (columns or docs.columns) if c.lower() not in new]
    t = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(
        t.alias("t"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.coalesce(t, F.lit(""))).alias("th"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    )
    row_slot, key_slot = (F.pmod(F.xxhash64(*c), F.lit(FILTER_BITS)) for c in (("id", "th"), ("_i", "_h")))
    marked = maybe_keys(rows, by_doc, row_slot, key_slot, mark="maybe")
    passed = [F.col(f"c{i}") for i in range(len(names))]
    # texts without a span are never shuffled
    none = F.lit(None).cast("array<struct<start:bigint,end:bigint>>")
    whole = marked.where(~F.col("maybe")).select("t", none.alias("spans"), *passed)
    some = marked.where("maybe").join(by_doc, (F.col("id") == F.col("_i")) & (F.col("th") == F.col("_h")), "left").select("t", "spans", *passed)
    both = whole.union(some)
    types = ", ".join([*(f"c{i} {both.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(names))), "n0 long, n1 long, n2 long, n3 string, n4 string"])
    return both.mapInArrow(lambda x: _strip(x, keep_text), types).toDF(*names, *new)


NAME, ORACLE = "op8_suffix_array_dedup", None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, keep_text=False, columns=["doc_id"]).drop("kept_text")
