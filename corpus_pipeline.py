"""The training-data pipeline: STAGES over the ``documents`` table.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns they were given. Columns are
renamed on the way into an operator and back, so names of extra columns can't clash
with an operator's own. Rows with a null or letterless text end at language ID.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm.exact_dedup import exact_dedup_rows
from cropledger.llm.language_id import fit, identify
from cropledger.llm.ngram_join import drop_near_duplicates
from cropledger.llm.packing import pack_documents
from cropledger.llm.suffix_dedup import remove_repeats
from cropledger.session import ensure_checkpoint_dir


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns x0, x1, ... and the new name of each."""
    names = {c: f"x{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(x).alias(c) for c, x in names.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go."""
    rows, x = _plain(docs)
    model = fit(rows, x["doc_id"], x["text"], x["lang"])
    return _named(identify(rows, model, x["text"]).where("accepted"), x)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    rows, x = _plain(docs)
    return _named(exact_dedup_rows(rows, x["doc_id"], x["text"]), x)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    rows, x = _plain(docs)
    return _named(drop_near_duplicates(rows, x["doc_id"], x["text"]), x)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 400 bytes that occur elsewhere; n_chars follows."""
    rows, x = _plain(docs)
    rest = [c for c in rows.columns if c != x["text"]]
    done = remove_repeats(rows, x["doc_id"], x["text"], columns=rest).withColumnRenamed("kept_text", x["text"])
    if "n_chars" in x:
        kind = rows.schema[x["n_chars"]].dataType
        done = done.withColumn(x["n_chars"], F.when(F.col("n_removed") > 0, F.char_length(x["text"]).cast(kind)).otherwise(F.col(x["n_chars"])))
    return _named(done, x)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: a row per piece of a document, with its ids."""
    rows, x = _plain(docs)
    packed = pack_documents(rows, public_tokenizers.path("word_bpe_49k.json"), x["doc_id"], x["text"])
    return packed.withColumnRenamed(x["doc_id"], "doc_id")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

#: SQL can't express these models and packings; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
