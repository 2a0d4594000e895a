"""Prefix trie against brute force: every block size, hot groups, nulls, ties, empties."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cropledger.llm import prefix_trie as M

SCHEMA = "conv_id long, turn long, role string, text string, kind string, key binary, turns string, depth int"


def brute(seqs):
    nodes = defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    kids = defaultdict(int)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, members in nodes.items():
        gain = (len(members) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += gain
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if seqs[c] == p)
        up = min(nodes[p[:-1]]) if p else None
        out.append((min(members), len(p), up, len(members), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def sequences(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: tuple(x[2:] for x in sorted(v, key=lambda x: x[:2])) for c, v in convs.items()}


def moved(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = seqs.get(c - c % 100, ())[:h] + own[h:]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for c in range(260):
        for i in range(rng.randint(1, 6)):
            out.append((c, i, rng.choice(["user", "assistant"]), rng.choice(["", "a", "é𝄞", "long text " * 3])))
    for c in range(300, 420):  # a group of copies, and one very common first turn
        out += [(c, 0, "system", "s"), (c, 1, "user", "same"), (c, 2, "assistant", "copy")]
    for c in range(420, 500):
        out += [(c, 0, "system", "s"), (c, 1, "user", str(c % 7))]
    out += [(900, i, "user", str(i % 3)) for i in range(400)]  # a long one, and its prefix
    out += [(901, i, "user", str(i % 3)) for i in range(399)]
    out += [(950, None, None, None), (950, 1, "user", None), (951, None, "", ""), (None, 0, "user", "lost"), (960, 0, "a", "bc"), (961, 0, "ab", "c")]
    out += [(970, 0, "user", "twice"), (970, 0, "user", "twice"), (971, 0, "user", "twice")]
    return out


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("block", [2, 40, 1000, M.BLOCK_TURNS])
def test_trie_equals_brute_force(spark, rows, block):
    df = spark.createDataFrame([(*r, "k", b"k", "t", 1) for r in rows], SCHEMA).repartition(5)
    seqs = M.turn_sequences(df)
    # one-row Arrow batches let small blocks end anywhere
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000" if block == M.BLOCK_TURNS else "1")
    try:
        assert result(M.prefix_trie(seqs, block_turns=block, salts=3)) == brute(sequences(rows))
        if block == 1000:
            assert result(M.prefix_trie(M.rebuilt(seqs), block_turns=block)) == brute(moved(sequences(rows)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_and_turnless(spark, rows):
    none = spark.createDataFrame([], SCHEMA)
    assert result(M.prefix_trie(M.turn_sequences(none))) == []
    one = spark.createDataFrame([(7, 0, "user", "x", "k", b"k", "t", 1)], SCHEMA)
    gone = M.turn_sequences(one).select("conv_id", F.slice("turns", 2, 1).alias("turns"))
    assert result(M.prefix_trie(gone)) == brute({7: ()})


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(M.query(spark, SF_SMALL)) == brute(moved(sequences(rows)))
