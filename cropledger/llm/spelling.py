"""Spelling variant grouping (operator 11): reduced-alphabet generation.

Letters are hashed to a few symbols, so a word becomes a reduced word over a small
alphabet, and two words one edit apart have reduced words at most one edit apart.
For every distinct reduced word the full neighbourhood of one edit (the word
itself, every deletion, replacement and insertion) is generated over the small
alphabet, as 64-bit polynomial hashes of all neighbours at once, and joined with
the reduced vocabulary. The words behind a joined pair are compared as they are:
exactly one inserted, deleted or replaced code point makes them near. Hash
collisions only add pairs to compare (the reduced words of one key are taken together).

The neighbours that hit no reduced word are held back before the shuffle by a
bitmap of ``FILTER_BITS`` bits (a fixed broadcast, whatever the vocabulary); one
that is full lets more pass and changes no result. A word has a bounded number of
near words (one edit over the alphabet), so no group grows with the corpus; a hot
word is counted by task before the shuffle. Nothing else is broadcast: all joins are merge
joins. Roots are found by pointer doubling:
a form has at least twice its word's count, so a chain is at most 63 long.

Defined cases: a null text has no words; a null id is written as the empty string
in the hash of the contract's deletions; repeated rows count again; rows that share
an id are texts of their own; an empty table gives no words; other columns are
never read. Very long runs are words like any other, their neighbours come in
parts of ``PART`` hashes.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm.words import mix, powers, stored

#: Symbols that letters are hashed to.
SYMBOLS = 8
#: Words have at least so many code points and occurrences.
MIN_LENGTH, MIN_COUNT = 5, 3
#: A form has at least so many times the occurrences of its word.
FORM_RATIO = 2
#: Bits of the filter that holds back neighbours without a reduced word.
FILTER_BITS = 1 << 25
_BUCKET = 32768
#: Words whose counts a task holds before it hands them on.
HELD_WORDS = 1 << 18
#: Hashes of neighbours in one batch.
PART = 1 << 18

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _count_runs(planted: int):
    """(word, n) of tasks. With ``planted`` the contract's deletions: a run whose
    crc32 of ``<id>:<run>`` is divisible loses the code point at crc32 % length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                # bytes.lower changes A-Z only
                runs = Counter(_RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                if planted:
                    seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for w in [w for w in runs if not zlib.crc32(w.encode(), seed) % planted]:
                        n = runs.pop(w)
                        at = zlib.crc32(w.encode(), seed) % len(w)
                        held[w[:at] + w[at + 1 :]] += n
                held.update(runs)
                if len(held) >= HELD_WORDS:
                    yield flush()
        if held:
            yield flush()

    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: int = 0) -> DataFrame:
    """``word, n`` over all runs of letters of whole texts, A-Z lower-cased."""
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    return rows.mapInArrow(_count_runs(planted), "word string, n long").where("word != ''").groupBy("word").agg(F.sum("n").alias("n"))


def reduced_alphabet(symbols: int = SYMBOLS) -> tuple[str, str]:
    """Lower-case letters of the runs and the symbol (a digit or letter) of each, by a hash."""
    letters = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
    hashed = mix(np.arange(len(letters), dtype=np.uint64) + np.uint64(ord("a"))) % np.uint64(symbols)
    return letters, "".join(np.base_repr(int(h), 36) for h in hashed)


def _code(symbol: np.ndarray) -> np.ndarray:
    """Odd random number of each symbol for the polynomial hash."""
    return mix(symbol.astype(np.uint64) + np.uint64(0x51)) | np.uint64(1)


_ALL = _code(np.arange(256))
_INVERSE = powers(2)[1][1]
_STEP = powers(2)[0][1]


def _final(value: np.ndarray, length: int) -> np.ndarray:
    return mix(value + np.uint64(length * 0xD6E8FEB86659FD93 % (1 << 64))).view(np.int64)


def reduced_key(word: str) -> np.ndarray:
    """The key of a reduced word, one element."""
    s = _ALL[np.frombuffer(word.encode(), dtype=np.uint8)]
    return _final((s * powers(len(s) + 1)[0][: len(s)]).sum(keepdims=True, dtype=np.uint64), len(s))


def neighbours(word: str, symbols: int = SYMBOLS, part: int = PART) -> Iterator[np.ndarray]:
    """Keys of the whole neighbourhood of one edit, each distinct neighbour once:
    of equal deletions (or insertions) in a run of equal symbols one is made."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    n = len(raw)
    s, pw = _ALL[raw], powers(n + 2)[0]
    before = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(s * pw[:n], out=before[1:])
    total = before[n]
    alphabet = np.array([ord(np.base_repr(i, 36)) for i in range(symbols)], dtype=np.uint8)
    yield _final(total[None], n)
    rows = max(1, part // symbols)
    for lo in range(0, n + 1, rows):
        i = np.arange(lo, min(n, lo + rows))
        if len(i):
            cut = i[(i == 0) | (raw[i] != raw[np.maximum(i - 1, 0)])]
            yield _final(before[cut] + (total - before[cut + 1]) * _INVERSE, n - 1)
            other = alphabet[None, :] != raw[i][:, None]
            yield _final((total + (_ALL[alphabet][None, :] - s[i][:, None]) * pw[i][:, None])[other], n)
        i = np.arange(lo, min(n + 1, lo + rows))
        fresh = (i == 0)[:, None] | (alphabet[None, :] != raw[np.maximum(i - 1, 0)][:, None])
        tail = before[i] + (total - before[i]) * _STEP
        yield _final((tail[:, None] + _ALL[alphabet][None, :] * pw[i][:, None])[fresh], n + 1)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word, n, its reduced word and the key of that."""
    for batch in batches:
        keys = [reduced_key(r)[0] for r in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=["word", "n", "r", "key"])


def _neighbourhoods(filtered, bits: int, symbols: int):
    """(key, near_key) of the reduced words of a key, the near keys that the bitmap may hold, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = filtered.value
        key: list[np.ndarray] = []
        near: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(key)), pa.array(np.concatenate(near))], names=["key", "near_key"])
            key.clear()
            near.clear()
            held = 0
            return out

        for batch in batches:
            for own, reduced in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hits = []
                for made in (m for word in reduced for m in neighbours(word, symbols)):
                    slot = made.view(np.uint64) % np.uint64(bits)
                    hits.append(made[(bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1])
                near.append(np.unique(np.concatenate(hits)))
                key.append(np.full(len(near[-1]), own, dtype=np.int64))
                held += len(near[-1])
                if held >= PART:
                    yield flush()
        if held:
            yield flush()

    return run


def _bitmap(vocabulary: DataFrame, bits: int) -> np.ndarray:
    """The slots (key modulo ``bits``, a power of two) of the reduced vocabulary, ``bits / 8`` bytes."""
    slot = F.col("key").bitwiseAND(bits - 1)
    parts = vocabulary.groupBy(F.floor(slot / _BUCKET).alias("b")).agg(F.bitmap_construct_agg(F.pmod(slot, F.lit(_BUCKET))).alias("m"))
    out = np.zeros((bits // _BUCKET, _BUCKET // 8), dtype=np.uint8)
    for b, m in parts.collect():
        out[b] = np.frombuffer(m, dtype=np.uint8)
    return out.reshape(-1)


def near_pairs(words: DataFrame, symbols: int = SYMBOLS, bits: int = FILTER_BITS) -> DataFrame:
    """``word, n, near, near_n``: every near word of each of ``words`` (``word, n``, distinct).
    ``words`` should be a stored table: it is read several times."""
    spark = words.sparkSession
    letters, to = reduced_alphabet(symbols)
    keyed = stored(words.withColumn("r", F.translate("word", letters, to)).mapInArrow(_keys, "word string, n long, r string, key long"))
    vocabulary = stored(keyed.groupBy("key").agg(F.collect_set("r").alias("reduced")))
    filtered = spark.sparkContext.broadcast(_bitmap(vocabulary, bits))
    # a word's neighbourhood is worth far more work than its bytes: spread the rows
    hood = vocabulary.repartition(spark.sparkContext.defaultParallelism * 2).mapInArrow(_neighbourhoods(filtered, bits, symbols), "key long, near_key long")
    other = keyed.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("key").alias("near_key"))
    # merge joins: the planner sizes the neighbours by the words they are made from, and a stored table by its compressed files
    return keyed.drop("r").hint("merge").join(hood.hint("merge").join(other, "near_key"), "key").where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def spelling_groups(counts: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO, **params) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of ``counts`` (``word, n``)."""
    words = stored(counts.where((F.char_length("word") >= min_length) & (F.col("n") >= min_count)))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    nearest = near_pairs(words, **params).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    far = -F.col("best.m") >= ratio * F.col("n")
    formed = stored(
        words.join(nearest.hint("merge"), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(far, F.col("best.w")).alias("form"),
            F.when(far, -F.col("best.m")).alias("form_n"),
        )
    )
    # pointer doubling: `to` is so many forms ahead of the word
    ahead = formed.where("form IS NOT NULL").select("word", F.col("form").alias("to"))
    while True:
        steps = ahead.select(F.col("word").alias("to"), F.col("to").alias("next"))
        moved = stored(ahead.join(steps.hint("merge"), "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
        ahead = moved.select("word", "to")
        if moved.where("moved").isEmpty():
            break
    roots = ahead.withColumnRenamed("to", "root")
    return formed.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


NAME = "op11_spelling_groups"

#: The contract in SQL: one edit as equality of the words without one code point.
ORACLE = """
WITH RECURSIVE
docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(doc_id::VARCHAR, '') AS k,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents WHERE text IS NOT NULL),
runs AS (
  SELECT row_id, k, w, count(*) AS c
  FROM (SELECT row_id, k, unnest(regexp_extract_all(t, '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS w FROM docs) GROUP BY ALL),
hashed AS (
  SELECT w, c, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(k || ':' || w)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS h
  FROM runs),
counted AS (
  SELECT CASE WHEN h % 97 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, sum(c)::BIGINT AS n
  FROM hashed GROUP BY 1),
words AS (SELECT word, n, length(word) AS len FROM counted WHERE length(word) >= 5 AND n >= 3),
cuts AS (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, len + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY ALL),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
chain AS (
  SELECT word, form AS at FROM formed WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.at AS root FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(r.root, f.word) AS root, f.n, f.n_near, f.form_n FROM formed f LEFT JOIN roots r USING (word)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), planted=97))
