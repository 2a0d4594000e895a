"""N-gram Jaccard join by MinHash banding (operator 1).

Two documents are linked when the Jaccard similarity of their sets of
``SHINGLE`` word runs is at least ``THRESHOLD`` (words are lower-cased in A-Z; a
document of fewer words has one run of all). Documents of equal sets form a copy
class and are joined through one representative, so copies are never paired.

1. One scan per document: the set's 128-bit key and the band hashes. Band and row
   counts come from ``bands_for(target recall)``. No text is shuffled.
2. Shuffle on band hashes. Each bucket links its members to its smallest member
   (a star, linear in the bucket). The components of the stars hold every pair
   that shares a bucket.
3. Verification on the full sets: members of a component are cut into tiles of
   ``TILE`` members, and each pair of tiles is one group that computes exact
   Jaccard similarities of its pairs by a matrix product. A group gives back one
   count per member and a spanning forest of its links, never the pairs. Groups
   have at most ``2 * TILE`` members however large the component is.
4. Components of the verified links are the near-duplicate groups.

Result per document: ``class_id`` (smallest id of its near-duplicate group),
``copy_id`` (smallest id with an equal set), ``n_links`` (other documents linked
to it, copies included). Documents without words (null, empty, only white space)
link to nothing. A null id is left out; rows that share an id are one document,
of which the row with the smallest set key counts. An empty table gives no rows.
Sets hold 64-bit hashes of word runs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cropledger.llm.words import blocks, fresh_name, map_texts, mix, only_keys, shingle_hashes
from cropledger.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
ROWS = 6
TILE = 128


def bands_for(recall: float, threshold: float, rows: int) -> int:
    """Fewest bands of ``rows`` hashes by which a pair of exactly the threshold's
    similarity shares a band with probability ``recall`` at least."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def _signer(bands: int, rows: int, shingle: int):
    rng = np.random.default_rng(77)
    n = bands * rows
    mul = (rng.integers(1, 2**32, n, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    add = rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
    salt = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def sign(texts: pa.Array) -> Iterator[list[pa.Array]]:
        for b in blocks(texts):
            b.split_words()
            h, doc = shingle_hashes(b, b.word_hashes(lower=True), shingle)
            per = np.bincount(doc, minlength=b.n)
            some = np.flatnonzero(per)
            heads = np.concatenate([[0], np.cumsum(per)])[some]
            if not len(some):
                yield [pa.array([None] * b.n, pa.int64())] * 2 + [pa.array([None] * b.n, pa.list_(pa.int64()))]
                continue
            order = np.lexsort((h, doc))
            hs, ds = h[order], doc[order]
            new = np.ones(len(hs), dtype=bool)
            new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
            u, ud = hs[new], ds[new]
            at = np.searchsorted(ud, some)
            k1 = mix(np.add.reduceat(u, at) + np.diff(np.append(at, len(u))).astype(np.uint64))
            k2 = np.bitwise_xor.reduceat(mix(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at)
            # 32-bit multiply-shift style permutations of two mixed halves
            x = (mix(u) >> np.uint64(32)).astype(np.uint32)
            mins = np.empty((len(some), n), dtype=np.uint32)
            work = np.empty_like(x)
            for j in range(n):
                np.multiply(x, mul[j], out=work)
                work += add[j]
                work ^= work >> np.uint32(15)
                work *= np.uint32(0x85EBCA6B)
                mins[:, j] = np.minimum.reduceat(work, at)
            band = np.zeros((len(some), bands), dtype=np.uint64)
            for r in range(rows):
                band = mix(band * np.uint64(31) + mins[:, r::rows].astype(np.uint64) + salt)
            full = np.zeros((b.n, 2), dtype=np.int64)
            full[some, 0], full[some, 1] = k1.view(np.int64), k2.view(np.int64)
            none = per == 0
            lens = np.where(none, 0, bands)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32), pa.array(band.ravel().view(np.int64)))
            yield [pa.array(full[:, 0].copy(), mask=none), pa.array(full[:, 1].copy(), mask=none), lists]

    return sign


def _sets(shingle: int):
    """The sorted distinct shingle hashes of each text, as bytes."""

    def run(texts: pa.Array) -> Iterator[list[pa.Array]]:
        for b in blocks(texts):
            b.split_words()
            h, doc = shingle_hashes(b, b.word_hashes(lower=True), shingle)
            heads = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b.n))])
            yield [pa.array([np.unique(h[x:y]).tobytes() for x, y in zip(heads[:-1], heads[1:], strict=True)], type=pa.binary())]

    return run


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``node, root`` (smallest node) for
    every node of an edge. Alternating large and small stars, whose rounds grow
    with the logarithm of the nodes; a hub's edges are aggregated before each
    shuffle. Each round is a reliable checkpoint."""
    e = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    state = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        # large star: larger neighbours go to the smallest neighbour
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours, and the node itself, go to the smallest one
        down = large.where("u > v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .where("u > v")
            .distinct()
        )
        e = cut_lineage(small)
        state, before = _digest(e), state
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _verify(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Exact links between the members of the two tiles of a group (or within
        one tile): copies linked to each member, and a spanning forest."""
        pdf = pdf.sort_values("rep", kind="stable")
        rep, copies, tile = pdf["rep"].to_numpy(), pdf["copies"].to_numpy(), pdf["tile"].to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in pdf["items"]]
        size = np.array([len(s) for s in sets], dtype=np.int64)
        n = len(sets)
        inter = np.zeros((n, n), dtype=np.int64)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        head = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        count = np.diff(np.append(head, len(flat)))
        shared = np.repeat(count, count) > 1
        col = np.repeat(np.arange(len(head)), count)[shared]
        owner = owner[shared]
        if len(col):
            # runs that several members share, as columns of a 0/1 matrix, a strip of columns at a time
            col = np.cumsum(np.concatenate([[0], (np.diff(col) > 0).astype(np.int64)]))
            strip = 4096
            for lo in range(0, int(col[-1]) + 1, strip):
                x, y = np.searchsorted(col, [lo, lo + strip])
                m = np.zeros((n, strip), dtype=np.float32)
                m[owner[x:y], col[x:y] - lo] = 1
                inter += np.rint(m @ m.T).astype(np.int64)
        union = size[:, None] + size[None, :] - inter
        link = inter >= threshold * union - 1e-9
        link &= (tile[:, None] != tile[None, :]) if len(set(tile)) > 1 else ~np.eye(n, dtype=bool)
        np.fill_diagonal(link, False)
        links = (link * copies[None, :]).sum(axis=1)
        # spanning forest: each member points to the smallest one it reaches within the group
        root = np.arange(n)
        while True:
            low = np.where(link, root[None, :], n).min(axis=1, initial=n)
            new = np.minimum(root, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = links > 0
        return pd.DataFrame({"a": rep[some], "b": rep[root[some]], "links": links[some]})

    return run


def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    recall: float = RECALL,
    rows: int = ROWS,
    tile: int = TILE,
) -> DataFrame:
    """``id_col, class_id, copy_id, n_links`` for every distinct id."""
    bands = bands_for(recall, threshold, rows)
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t")).where("id IS NOT NULL")
    signed = cut_lineage(
        map_texts(base, "t", _signer(bands, rows, shingle), "k1 long, k2 long, bands array<long>", drop_text=True)
    )
    one = signed.groupBy("id").agg(F.min(F.struct("k1", "k2")).alias("k")).select("id", "k.*")
    classes = cut_lineage(
        one.where("k1 IS NOT NULL").groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    )
    # the representatives' bands: joined on the id and key, so a repeated id brings its chosen row
    rep_bands = signed.join(classes, (signed.id == classes.rep) & (signed.k1 == classes.k1) & (signed.k2 == classes.k2)).select(
        "rep", "bands"
    )
    hashed = rep_bands.distinct().select("rep", F.posexplode("bands").alias("band", "h"))
    buckets = hashed.groupBy("band", "h").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    stars = hashed.join(buckets, ["band", "h"]).where("rep > low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    candidate = components(stars.distinct())

    # tiles: members of a component are numbered within parts dealt by hash, so a giant
    # component is never sorted in one task; a tile is at most `tile` members of one part
    sizes = candidate.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    # a quarter over the mean, and a second cut by rank, keep every tile within `tile`
    dealt = candidate.join(sizes, "root").withColumn("parts", F.ceil(F.col("m") / (tile * 8)).cast("long"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    rank = F.row_number().over(Window.partitionBy("root", "part").orderBy("node")) - 1
    member = cut_lineage(
        dealt.withColumn("r", rank)
        .withColumn("tile", F.struct(F.col("part"), F.floor(F.col("r") / tile).alias("cut")))
        .select("root", F.col("node").alias("rep"), "tile")
    )
    tiles = member.select("root", "tile").distinct()
    pairs = tiles.select("root", F.col("tile").alias("x")).join(tiles.select("root", F.col("tile").alias("y")), "root").where("x <= y")
    jobs = pairs.select("root", "x", "y", F.col("x").alias("tile")).union(
        pairs.where("x < y").select("root", "x", "y", F.col("y").alias("tile"))
    )
    wanted = member.join(classes, "rep").select("rep", "root", "tile", "copies", F.col("k1").alias("w1"), F.col("k2").alias("w2"))
    texts = only_keys(base, wanted.select("rep").distinct(), "id", "rep")
    sets = map_texts(texts, "t", _keyed_sets(shingle), "s1 long, s2 long, items binary", drop_text=True)
    sets = cut_lineage(
        sets.join(wanted, (F.col("id") == F.col("rep")) & (F.col("s1") == F.col("w1")) & (F.col("s2") == F.col("w2")))
        .select("rep", "root", "tile", "copies", "items")
        .dropDuplicates(["rep"])
    )
    verified = cut_lineage(
        jobs.join(sets, ["root", "tile"])
        .select("root", "x", "y", "rep", "copies", "items", F.xxhash64("tile").alias("tile"))
        .groupBy("root", "x", "y")
        .applyInPandas(_verify(threshold), "a long, b long, links long")
    )
    links = verified.groupBy("a").agg(F.sum("links").alias("links"))
    groups = components(verified.select("a", "b"))
    classed = (
        classes.join(groups, classes.rep == groups.node, "left")
        .join(links, F.col("rep") == F.col("a"), "left")
        .select(
            F.col("k1"),
            F.col("k2"),
            "rep",
            F.coalesce("root", "rep").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return one.join(classed, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("rep", "id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _keyed_sets(shingle: int):
    """The set keys as ``_signer`` gives them, and the set itself."""

    def run(texts: pa.Array) -> Iterator[list[pa.Array]]:
        for part in _sets(shingle)(texts):
            k1, k2 = [], []
            for raw in part[0]:
                u = np.frombuffer(raw.as_py(), dtype=np.uint64)
                k1.append(None if not len(u) else int(mix(np.add.reduce(u, keepdims=True) + np.uint64(len(u))).view(np.int64)[0]))
                k2.append(None if not len(u) else int(np.bitwise_xor.reduce(mix(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)), keepdims=True).view(np.int64)[0]))
            yield [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), part[0]]

    return run


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One document of each near-duplicate group: the one of the smallest id."""
    key = fresh_name(docs, "gone")
    gone = ngram_join(docs, id_col, text_col, **params).where(F.col("class_id") != F.col(id_col)).select(F.col(id_col).alias(key))
    return docs.join(gone, F.col(f"`{id_col}`") == F.col(key), "left_anti")


NAME, ORACLE = "op1_ngram_jaccard_join", None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
