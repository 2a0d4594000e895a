"""Exact dedup by progressive refinement (operator 6), DataFrame operations only.

Rows are grouped by byte length, then by (length, hash of a prefix), then by
(length, prefix hash, SHA-256 of the whole text). Each level goes on with the
groups of two rows or more, so whole texts are read and hashed only for rows
that share length and prefix with another row. Texts are compared after
lower-casing A-Z; a null text equals the empty one. Of equal texts the row with
the largest id stays. There is one decision per distinct id: rows that share an
id are one document, which stays if any of its texts does. Rows with a null id
get no decision, join no group and stay. An empty table gives no rows. Other
columns are never read, whatever their names.

Scale: the levels shuffle ids, lengths and hashes. A hot group is counted by
partial aggregation before the shuffle. To read whole texts of survivors only,
the surviving keys are first marked in a bitmap of ``filter_bits`` bits (a fixed
broadcast of ``filter_bits / 8`` bytes, whatever the corpus); rows that pass it
are then joined on the keys themselves, so the bitmap's collisions cost time,
never results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm.words import FILTER_BITS, fresh_name, maybe_keys
from cropledger.session import cut_lineage

PREFIX_BYTES = 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else; null as empty. Pure ASCII texts take the
    built-in ``lower``, which does the same there and is faster."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_bytes: int = PREFIX_BYTES,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Decision per document: ``id_col, keep_id, group_size, kept``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # the prefix hash takes the first prefix_bytes characters, normalised like the whole
    head = normalised(F.substring(text, 1, prefix_bytes))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.octet_length(text).alias("_len"),
        F.xxhash64(head).alias("_prefix"),
        F.col(f"`{text_col}`").alias("_text"),
    )
    narrow = rows.where(F.col("_id").isNotNull()).select("_id", "_len", "_prefix")

    # level 1 and 2: one aggregation by (length, prefix) with counts; level 1 sums them by length
    by_prefix = narrow.groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    by_length = by_prefix.groupBy("_len").agg(F.sum("_n").alias("_m")).where("_m > 1").select("_len")
    survivors = cut_lineage(
        by_prefix.join(by_length, "_len", "left_semi").where("_n > 1").select("_len", "_prefix")
    )

    slot = F.pmod(F.xxhash64("_len", "_prefix"), F.lit(filter_bits))
    maybe = maybe_keys(rows.where(F.col("_id").isNotNull()), survivors, slot, slot, filter_bits)
    # level 3: the whole text is hashed here, before anything is shuffled
    hashed = maybe.select("_id", "_len", "_prefix", F.sha2(normalised(F.col("_text")), 256).alias("_full"))
    hashed = cut_lineage(hashed.join(survivors, ["_len", "_prefix"], "left_semi"))
    groups = (
        hashed.groupBy("_len", "_prefix", "_full")
        .agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )
    member = (
        hashed.join(groups, ["_len", "_prefix", "_full"])
        .groupBy("_id")
        .agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.max(F.col("keep_id") == F.col("_id")).alias("_kept"))
    )
    return (
        narrow.groupBy("_id").agg(F.lit(True).alias("_any"))
        .join(member, "_id", "left")
        .select(
            F.col("_id").alias(id_col),
            F.coalesce("keep_id", "_id").alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce("_kept", F.lit(True)).alias("kept"),
        )
    )


def exact_dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The documents that stay, with all their columns."""
    key = fresh_name(docs, "gone")
    gone = exact_dedup(docs, id_col, text_col, **params).where(~F.col("kept")).select(F.col(id_col).alias(key))
    return docs.join(gone, F.col(id_col) == F.col(key), "left_anti")


NAME = "op6_exact_dedup"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    digest = docs.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))
    return exact_dedup(docs).join(digest, "doc_id")


ORACLE = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
