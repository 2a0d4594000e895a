"""Language ID with Kneser-Ney character models (operator 10).

One interpolated Kneser-Ney model of ``ORDER`` characters per language, over
lower-cased runs of letters (and marks) with a boundary after each run; contexts
stay inside the run. A character takes 12 bits (code point modulo 4095), so an
n-gram is one 60-bit key; a model is, for each order, a sorted array of n-gram
keys with their discounted probabilities and a sorted array of context keys with
their interpolation weights. The prediction is the language of the lowest
cross-entropy per character (ties: the alphabetically first).

Rejection is calibrated on labelled documents that the models haven't seen: the
excess over the mean cross-entropy of the language may reach the conformal
``1 - REJECT`` quantile, taken apart for texts under and over ``LONG`` letters
(for the short ones of the excess times the root of the length). With too few
calibration documents for that quantile nothing is rejected.

The models are fitted on a bounded sample: at most ``MAX_DOCS`` labelled
documents of each language, chosen by the hash of their id, whole texts. All
else covers every row. Null or letterless text: ``und``, score 0, not accepted.
Rows with a null label don't train. With no training rows every prediction is
``und``. Repeated rows are predicted alike; other columns pass through unread.
"""

from __future__ import annotations

import math
import pickle
import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cropledger.llm.words import Block, blocks, map_texts, mix

ORDER = 5
BITS = 12
MAX_DOCS = 1500
MAX_LANGS = 512
REJECT = 0.002
LONG = 500
CALIBRATION_SHARE = 5
_CACHE_BITS = 19
_V = 1 << BITS


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: 0 none, 1 mark, 2 letter; and the id of its lower case."""
    kind = np.zeros(0x110000, dtype=np.uint8)
    low = np.arange(0x110000, dtype=np.int64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            kind[i] = 2
            low[i] = ord(c.lower()[0])
        elif i > 0x2FF and unicodedata.category(c)[0] == "M":
            kind[i] = 1
    return kind, (1 + low % (_V - 1)).astype(np.uint64)


def _code_points(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a block with a blank after each document, and each one's document."""
    raw = block.buf.tobytes()
    try:
        cps = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        heads = np.concatenate([[0], np.cumsum((block.buf & 0xC0) != 0x80)])
        off = heads[block.off]
    except UnicodeDecodeError:  # not valid UTF-8: document by document, with replacement marks
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(block.off[:-1], block.off[1:], strict=True)]
        cps = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    doc = np.repeat(np.arange(block.n), np.diff(off) + 1)
    return np.insert(cps, off[1:], 32), doc


def keys_of(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram key and the document of each character to predict; letters per document."""
    kinds, ids = _letters()
    cps, doc = _code_points(block)
    kind = kinds[cps]
    inside = kind > 0
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    ch = np.where(inside, ids[cps], 0)[keep]
    letters = np.bincount(doc[kind == 2], minlength=block.n)
    key, context = ch.astype(np.uint64), ch
    alive = np.ones(len(ch), dtype=bool)
    for k in range(1, ORDER):
        before = np.zeros_like(ch)
        before[k:] = ch[:-k]
        alive &= before > 0
        key |= np.where(alive, before, 0).astype(np.uint64) << np.uint64(BITS * k)
    return key, doc[keep], letters


def fit_counts(key: np.ndarray) -> dict:
    """One language's model from the keys of its training characters."""
    model = {}
    grams, counts = np.unique(key, return_counts=True)
    for k in range(ORDER, 0, -1):
        once, twice = int((counts == 1).sum()), int((counts == 2).sum())
        d = once / (once + 2 * twice) if once else 0.5
        d = min(max(d, 0.1), 0.9)
        ctx, inverse = np.unique(grams >> np.uint64(BITS), return_inverse=True)
        total = np.bincount(inverse, weights=counts)
        model[k] = {
            "grams": grams,
            "alpha": ((counts - d) / total[inverse]).astype(np.float64),
            "contexts": ctx,
            "gamma": d * np.bincount(inverse) / total,
        }
        grams, counts = np.unique(grams & np.uint64((1 << (BITS * (k - 1))) - 1), return_counts=True)
    return model


def log_probs(model: dict, key: np.ndarray) -> np.ndarray:
    """log2 probability of each key's last character given those before it."""
    p = np.full(len(key), 1.0 / _V)
    for k in range(1, ORDER + 1):
        part, m = key & np.uint64((1 << (BITS * k)) - 1), model[k]
        ctx = part >> np.uint64(BITS)
        at = np.minimum(np.searchsorted(m["contexts"], ctx), len(m["contexts"]) - 1)
        seen = m["contexts"][at] == ctx
        p = np.where(seen, p * m["gamma"][at], p)
        at = np.minimum(np.searchsorted(m["grams"], part), len(m["grams"]) - 1)
        p += np.where(m["grams"][at] == part, m["alpha"][at], 0.0)
    return np.log2(p)


class _Scorer:
    """Cross-entropies of texts under all models; a direct-mapped cache of fixed
    size holds the log probabilities of frequent keys."""

    def __init__(self, models: list[dict]):
        self.models = models
        self.key = np.full(1 << _CACHE_BITS, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.value = np.zeros((1 << _CACHE_BITS, len(models)), dtype=np.float32)

    def values(self, key: np.ndarray) -> np.ndarray:
        slot = mix(key) >> np.uint64(64 - _CACHE_BITS)
        miss = self.key[slot] != key
        if miss.any():
            new = np.unique(key[miss])
            got = np.stack([log_probs(m, new) for m in self.models], axis=1).astype(np.float32)
            at = mix(new) >> np.uint64(64 - _CACHE_BITS)
            self.key[at], self.value[at] = new, got
            out = self.value[slot]
            if (rest := self.key[slot] != key).any():
                # rows that lost their place to another new key are among the new ones or were there before
                again = np.unique(key[rest])
                out[rest] = np.stack([log_probs(m, again) for m in self.models], axis=1)[np.searchsorted(again, key[rest])]
            return out
        return self.value[slot]

    def __call__(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy by document and language, characters, letters."""
        key, doc, letters = keys_of(block)
        value = self.values(key)
        n = np.bincount(doc, minlength=block.n)
        total = np.stack([np.bincount(doc, weights=value[:, j], minlength=block.n) for j in range(len(self.models))], axis=1)
        return -total / np.maximum(n, 1)[:, None], n, letters


_scorers: dict[str, _Scorer] = {}


def _scorer(name: str, bc) -> _Scorer:
    """The scorer of a broadcast model, one per Python worker."""
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = _Scorer(bc.value)
    return _scorers[name]


def _sample(docs: DataFrame, id_col: Column, text: Column, lang: Column, max_docs: int) -> DataFrame:
    """(lang, text, calibrate): at most ``max_docs`` rows of each language."""
    rows = docs.select(id_col.cast("string").alias("id"), text.alias("text"), lang.alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL"
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    order = F.xxhash64("id")
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, 1.2 * max_docs / n + 20 / n))])
    if counts:
        rows = rows.where(F.pmod(order, F.lit(1_000_003)) < share[F.col("lang")] * 1_000_003)
    w = Window.partitionBy("lang").orderBy(order, "id", "text")
    rank = F.row_number().over(w)
    return rows.withColumn("rank", rank).where(F.col("rank") <= max_docs).withColumn("calibrate", F.col("rank") % CALIBRATION_SHARE == 0)


def _fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
    parts = [keys_of(b)[0] for b in blocks(pa.array(pdf["text"], type=pa.large_string()))]
    key = np.concatenate(parts)
    if not len(key):
        return pd.DataFrame({"lang": [], "model": []})
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "model": [pickle.dumps(fit_counts(key))]})


def fit(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", train: Column | None = None, max_docs: int = MAX_DOCS) -> dict:
    """Models and rejection bounds from labelled rows. ``train`` picks the rows
    to learn from. The sample of a language (``max_docs`` texts) is one group;
    the driver gets the sorted arrays and one figure per calibration text."""
    spark = docs.sparkSession
    rows = docs.where(train) if train is not None else docs
    sample = _sample(rows, F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.col(f"`{lang_col}`"), max_docs).select("lang", "text", "calibrate")
    fitted = sample.where(~F.col("calibrate")).select("lang", "text").groupBy("lang").applyInPandas(_fit_group, "lang string, model binary").collect()
    found = sorted((r["lang"], pickle.loads(bytes(r["model"]))) for r in fitted)
    model = {"langs": [lang for lang, _ in found], "models": [m for _, m in found], "mean": {}, "short": math.inf, "long": math.inf}
    if not found:
        return model
    held = _entropies(spark, sample.where("calibrate").select("lang", "text"), model).where("n > 0")
    rows = [(r["lang"], r["entropy"][model["langs"].index(r["lang"])], r["n"]) for r in held.collect() if r["lang"] in model["langs"]]
    for lang in model["langs"]:
        own = [(h, n) for x, h, n in rows if x == lang]
        if own:
            model["mean"][lang] = float(np.average([h for h, _ in own], weights=[n for _, n in own]))
    excess = [(h - model["mean"][x], n) for x, h, n in rows]
    model["short"] = _quantile([e * math.sqrt(n) for e, n in excess if n < LONG])
    model["long"] = _quantile([e for e, n in excess if n >= LONG])
    return model


def _quantile(values: list[float]) -> float:
    k = math.ceil((len(values) + 1) * (1 - REJECT))
    return sorted(values)[k - 1] if k <= len(values) else math.inf


def _entropies(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    name, bc = uuid.uuid4().hex, spark.sparkContext.broadcast(model["models"])

    def score(texts: pa.Array) -> Iterator[list[pa.Array]]:
        for block in blocks(texts):
            h, n, _ = _scorer(name, bc)(block)
            yield [pa.array(list(h), type=pa.list_(pa.float64())), pa.array(n, type=pa.int64())]

    return map_texts(docs, "text", score, "entropy array<double>, n long")


def identify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score, cross_entropy, n_letters, accepted``
    (see ``words.map_texts`` for names that clash)."""
    langs, name, bc = model["langs"], uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(model["models"])
    mean = np.array([model["mean"].get(x, math.inf) for x in langs])
    short, long = model["short"], model["long"]

    def predict(texts: pa.Array) -> Iterator[list[pa.Array]]:
        for block in blocks(texts):
            if not langs:
                yield [pa.array(["und"] * block.n), pa.array([0.0] * block.n), pa.nulls(block.n, pa.float64()), pa.array([0] * block.n, pa.int64()), pa.array([False] * block.n)]
                continue
            h, n, letters = _scorer(name, bc)(block)
            best = h.argmin(axis=1)
            low = h[np.arange(block.n), best]
            # posterior of the best language, the evidence counted as of 50 characters at most
            score = 1 / np.exp2(-(h - low[:, None]) * np.minimum(n, 50)[:, None]).sum(axis=1)
            bound = np.where(n < LONG, short / np.sqrt(np.maximum(n, 1)), long)
            known = letters > 0
            yield [
                pa.array([langs[b] if k else "und" for b, k in zip(best, known, strict=True)], type=pa.string()),
                pa.array(np.where(known, score, 0.0)),
                pa.array(low, mask=~known),
                pa.array(letters, type=pa.int64()),
                pa.array(known & ~(low - mean[best] > bound)),
            ]

    return map_texts(docs, text_col, predict, "lang_pred string, score double, cross_entropy double, n_letters long, accepted boolean")


NAME, ORACLE = "op10_language_id", None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit(docs, train=~held)
    return identify(docs.select("doc_id", "text", held.alias("held_out")), model).drop("text")
