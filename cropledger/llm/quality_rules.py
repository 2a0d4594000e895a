"""Quality rules with risk-controlled thresholds (operator 7).

Each rule rejects a document whose score reaches a cutoff. Cutoffs are chosen per
stratum on labelled documents so that, with probability ``1 - DELTA`` over the
labels, the rules together reject at most the share ``ALPHA`` of the good documents of any
stratum:

- a stratum's vectors of cutoffs, one per rule, form one nested sequence: each lowers one
  rule's cutoff, that which rejects the most bad documents for the documents of the
  reference it rejects. The reference are all other documents: those of the stratum
  without a label and the labelled ones of other strata. The good documents that test
  the sequence have no part in it;
- the vectors are tested from the strictest down (fixed sequence, so no further
  correction; ``DELTA`` is split over the strata): a vector passes if seeing so few good
  documents that any of its rules rejects has an exact binomial probability of at most
  the stratum's share of ``DELTA`` when the true share is ``ALPHA``; the first that fails
  ends the sequence;
- of the vectors that pass, the one with the best balance of bad and good
  documents rejected is taken (a good one weighs ``GOOD_WEIGHT`` bad ones); none, if
  none rejects more than it costs.

A stratum without enough good labels for a bound (217 with four strata) gets no cutoff and
keeps all that the base rules pass. All labelled documents take part; the counts by
(stratum, rule, bin, label) and by (stratum, step, label) are
aggregated by Spark, and only those counts (at most ``MAX_STRATA`` strata) reach
the driver.

Null and empty texts have no words: measures 0, and base rules fail. A null stratum is a
stratum of its own. Rows without a label or with a null one don't train; an id with
several labels counts once, as bad if any is. Repeated rows are judged alike.
Other columns pass through; one named as a new column is replaced. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm.words import Block, blocks, fresh_name, map_texts, prefix_hash, shingle_hashes, span_hash
from cropledger.session import cut_lineage

WINDOW = 5
ALPHA = 0.02
DELTA = 0.05
GOOD_WEIGHT = 20
BINS = 200
MAX_STRATA = 1000
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
#: Rule -> (count, out of); scores run from 0 to 1.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "marks": ("n_marks", "word_chars"),
}


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    out[list(chars)] = 1
    return out


_SYMBOL, _MARK = _table(b"#*$%&|<>"), _table(b"!?")
_UPPER = _table(bytes(range(65, 91)))


def _per_doc(counts: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(counts)])
    return total[off[1:]] - total[off[:-1]]


def _repeat_words(b: Block, word_hash: np.ndarray) -> np.ndarray:
    """Words per document that lie in a window of WINDOW words found twice or more."""
    h, doc = shingle_hashes(b, word_hash, WINDOW)
    order = np.lexsort((h, doc))
    same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(h), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    windows = np.flatnonzero(twice)
    # a window's first word: as many windows as words come before, less those lost at each document's end
    head = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b.n))])
    start = b.first[doc[windows]] + windows - head[doc[windows]]
    edge = np.zeros(len(b.start) + 1, dtype=np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + WINDOW, len(b.start)), -1)
    return _per_doc(np.cumsum(edge[:-1]) > 0, b.first)


def _lines(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and of those the ones equal to an earlier line, per document."""
    cut = np.flatnonzero(b.buf == 10)
    start = np.sort(np.concatenate([b.off[:-1], cut + 1]))
    doc = np.searchsorted(b.off[1:], start, "right")
    # an empty document shares its offset with the next; a break at a document's end opens a last, empty line
    doc = np.minimum(doc, max(b.n - 1, 0))
    end = np.append(start[1:], len(b.buf))
    end = np.minimum(end, b.off[1:][doc])
    ends_break = np.zeros(len(start), dtype=bool)
    full = end > start
    ends_break[full] = b.buf[end[full] - 1] == 10
    end = end - ends_break
    with_word = np.searchsorted(b.start, end) > np.searchsorted(b.start, start)
    start, end, doc = start[with_word], end[with_word], doc[with_word]
    h = span_hash(prefix_hash(b.buf), start, end)
    order = np.lexsort((h, doc))
    same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    n = np.bincount(doc, minlength=b.n)
    return n, np.bincount(doc[order][1:][same], minlength=b.n)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``MEASURES`` of the whole text (long)."""

    def run(texts: pa.Array) -> Iterator[list[pa.Array]]:
        for b in blocks(texts):
            b.split_words()
            inside = np.zeros(len(b.buf) + 1, dtype=np.int64)
            inside[b.start] += 1
            np.add.at(inside, b.end, -1)
            letters = (np.cumsum(inside[:-1]) > 0) & ((b.buf & 0xC0) != 0x80)
            n_lines, n_dup = _lines(b)
            got = [
                np.diff(b.first),
                _per_doc(letters, b.off),
                _per_doc(_SYMBOL[b.buf], b.off),
                n_dup,
                _repeat_words(b, b.word_hashes(lower=False)),
                n_lines,
                _per_doc(_UPPER[b.buf], b.off),
                _per_doc(_MARK[b.buf], b.off),
            ]
            yield [pa.array(x, type=pa.int64()) for x in got]

    return map_texts(docs, text_col, run, ", ".join(f"{m} long" for m in MEASURES), drop_text=True)


def _bin(rule: str) -> Column:
    count, total = RULES[rule]
    return F.when(F.col(total) > 0, F.floor(F.least(F.col(count) / F.col(total), F.lit(1.0)) * BINS)).otherwise(0).cast("int")


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), exact up to rounding."""
    if k >= n:
        return 1.0
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(log)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in log))


def choose_cutoff(good: list[int], bad: list[int], alpha: float, delta: float, good_weight: float = GOOD_WEIGHT) -> int | None:
    """The cutoff (a bin, or a step counted from the last) of one nested sequence from its
    counts, or None."""
    n, over_good, over_bad = sum(good), 0, 0
    best, value = None, 0.0
    for c in range(len(good) - 1, 0, -1):
        over_good += good[c]
        over_bad += bad[c]
        # more than this many good ones can't pass, so the sum of the exact tail stays short
        if over_good > n * alpha or binomial_cdf(over_good, n, alpha) > delta:
            break
        if over_bad - good_weight * over_good > value:
            best, value = c, over_bad - good_weight * over_good
    return best


def choose_path(bad: np.ndarray, reference: np.ndarray) -> list[tuple[int, int]]:
    """The nested sequence of one stratum: (rule, its new cutoff) step by step, from counts
    [rule, bin]. A step takes the bins below a rule's cutoff that hold the most bad
    documents per document of the reference, smoothed by one spread over the bins."""
    rules, bins = bad.shape
    cut, path = [bins] * rules, []

    def best(r: int) -> tuple[float, int]:
        new = np.cumsum(bad[r, 1 : cut[r]][::-1])
        cost = np.cumsum(reference[r, 1 : cut[r]][::-1] + 1 / bins)
        if not len(new) or not new[-1]:
            return 0.0, 0
        i = int(np.argmax(new / cost))
        return float(new[i] / cost[i]), cut[r] - 1 - i

    steps = [best(r) for r in range(rules)]
    while (r := max(range(rules), key=lambda r: steps[r][0])) is not None and steps[r][0] > 0:
        # bins of a step one by one, so that the sequence is as fine as it can be
        for c in range(cut[r] - 1, steps[r][1] - 1, -1):
            if bad[r, c]:
                path.append((r, c))
        cut[r] = steps[r][1]
        steps[r] = best(r)
    return path


def fit(measured: DataFrame, labels: DataFrame, id_col: str, stratum_col: str, label_id: str = "doc_id", label_col: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> dict:
    """{stratum: {rule: bin}}: the cutoffs. ``label_col``: 1 good, 0 bad."""
    key = fresh_name(measured, "label_id")
    one = labels.where(F.col(label_col).isNotNull() & F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias(key)).agg(F.min(label_col).alias(key + "q"))
    rows = measured.dropDuplicates([id_col]).join(one, F.col(f"`{id_col}`") == F.col(key), "left")
    rows = cut_lineage(
        rows.select(F.col(f"`{stratum_col}`").cast("string").alias("stratum"), (F.col(key + "q") > 0).alias("good"), F.array(*[_bin(r) for r in RULES]).alias("bins"))
    )
    strata = [r["stratum"] for r in rows.where("good IS NOT NULL").select("stratum").distinct().limit(MAX_STRATA + 1).collect()]
    if len(strata) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    if not strata:
        return {}
    spark = measured.sparkSession
    known = F.broadcast(spark.createDataFrame([(x,) for x in strata], "s string"))
    counts = rows.join(known, F.col("stratum").eqNullSafe(F.col("s")), "left_semi").select("stratum", "good", F.posexplode("bins").alias("rule", "bin"))
    shape = len(RULES), BINS + 1
    table = {s: {g: np.zeros(shape, dtype=np.int64) for g in (True, False, None)} for s in strata}
    for r in counts.groupBy("stratum", "good", "rule", "bin").count().collect():
        table[r["stratum"]][r["good"]][r["rule"], r["bin"]] += r["count"]
    labelled = sum(t[True] + t[False] for t in table.values())
    paths = {s: choose_path(t[False], t[None] + labelled - t[True] - t[False]) for s, t in table.items()}
    # the step of the sequence that rejects a bin of a rule first, counted from the last step; 0 for none
    first = []
    for s, path in paths.items():
        at = np.zeros(shape, dtype=np.int64)
        for i, (r, c) in enumerate(path):
            at[r, c:][at[r, c:] == 0] = len(path) - i
        first.append((s, at.ravel().tolist()))
    steps = F.broadcast(spark.createDataFrame(first, "s string, at array<int>"))
    hit = [F.element_at("at", F.lit(r * (BINS + 1) + 1) + F.col("bins")[r]) for r in range(len(RULES))]
    found = rows.where("good IS NOT NULL").join(steps, F.col("stratum").eqNullSafe(F.col("s"))).select("stratum", "good", F.greatest(*hit).alias("step"))
    by_step = {s: ([0] * (len(p) + 1), [0] * (len(p) + 1)) for s, p in paths.items()}
    for r in found.groupBy("stratum", "good", "step").count().collect():
        by_step[r["stratum"]][0 if r["good"] else 1][r["step"]] += r["count"]
    names, cutoffs = list(RULES), {}
    for s, (good, bad) in by_step.items():
        last = choose_cutoff(good, bad, alpha, delta / len(strata))
        # the cutoffs only fall along the sequence
        cutoffs[s] = {names[r]: c for r, c in paths[s][: len(paths[s]) + 1 - last]} if last is not None else {}
    return cutoffs


def judge(measured: DataFrame, cutoffs: dict, stratum_col: str) -> DataFrame:
    """``measured`` with ``base_failed``, ``broken_rules array<string>`` and ``kept``."""
    stratum = F.col(f"`{stratum_col}`").cast("string")
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    broken = []
    for rule in RULES:
        pairs = [(s, c[rule]) for s, c in sorted(cutoffs.items(), key=lambda x: (x[0] is None, x[0])) if rule in c]
        hit = F.lit(False)
        known = [x for x in pairs if x[0] is not None]
        if known:
            limit = F.create_map(*[F.lit(v) for p in known for v in p])[stratum]
            hit = F.coalesce(_bin(rule) >= limit, F.lit(False))
        for s, c in pairs:
            if s is None:
                hit = hit | (stratum.isNull() & (_bin(rule) >= c))
        broken.append(F.when(hit, F.lit(rule)))
    out = measured.withColumn("base_failed", base).withColumn("broken_rules", F.array_compact(F.array(*broken)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", **params) -> DataFrame:
    """``docs`` without the text, with measures and verdicts."""
    measured = cut_lineage(measure(docs, text_col))
    return judge(measured, fit(measured, labels, id_col, stratum_col, **params), stratum_col)


NAME, ORACLE = "op7_quality_rules", None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(docs, labels).drop("lang")
