"""Incremental ingest of newly arrived source files.

A file stream with ``trigger(availableNow=True)`` finds the files that its checkpoint
doesn't know yet. Each micro-batch takes the names of its files, reads them with
the batch reader (every file by its own header, long rows skipped, whole files
rejected where year or country is missing) and cleans them once: the cleaned rows of
all kinds are staged beside the checkpoint, in a folder of the batch that a repeated
batch replaces. Error messages, quarantined rows, skipped rows and the upsert
all come from there, so running again after a failure changes nothing. The reports are
written beside the table, a folder per batch that a repeated batch replaces. The checkpoint lives under the shared
``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.errors import InvalidSource
from cropledger.operators.kept import KeptSummaries
from cropledger.operators.load import clean_files
from cropledger.session import ensure_checkpoint_dir
from cropledger.sources.csv_source import remove_path
from cropledger.sources.store import upsert


def ingest_new_files(
    spark: SparkSession,
    source_dir: str,
    table_path: str,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    summaries_path: str | None = None,
    **options,
) -> dict:
    """Clean and upsert every file under ``source_dir`` not seen before.
    ``options`` go to ``clean_files``; kept summaries at ``summaries_path`` are refreshed
    for the partitions of each batch. Returns counts of batches, payments taken in
    and files rejected."""
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid5(uuid.NAMESPACE_URL, source_dir)}"
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # one row per line goes no further than the distinct names
    names = reader.load(source_dir).select(F.col("_metadata.file_path").alias("file"))
    stats = {"batches": 0, "rows": 0, "rejected": 0}

    def handle(batch: DataFrame, batch_id: int) -> None:
        files = [r["file"] for r in batch.distinct().collect()]
        if not files:
            return
        stats["batches"] += 1
        beside = f"{table_path.rstrip('/')}-reports"
        try:
            result, src = clean_files(spark, sorted(files), **options)
            rejected = src.rejected
        except FileNotFoundError:
            result, rejected = None, [(f, "InvalidSource") for f in files]
        stats["rejected"] += len(rejected)
        part = f"batch={batch_id}"
        spark.createDataFrame(rejected, "file string, reason string").write.mode("overwrite").parquet(f"{beside}/rejected/{part}")
        if result is None:
            return
        stage = f"{checkpoint.rstrip('/')}-staged/{part}"
        staged = result.staged(stage)
        staged.errors.write.mode("overwrite").parquet(f"{beside}/errors/{part}")
        staged.quarantine.write.mode("overwrite").parquet(f"{beside}/quarantine/{part}")
        staged.skipped.write.mode("overwrite").parquet(f"{beside}/skipped/{part}")
        stats["rows"] += upsert(spark, staged.payments, table_path)
        if summaries_path is not None:
            KeptSummaries(spark, table_path, summaries_path).refresh()
        remove_path(spark, stage)

    query = (
        names.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stats


def reports(spark: SparkSession, table_path: str, kind: str) -> DataFrame:
    """The ``errors``, ``quarantine``, ``skipped`` or ``rejected`` rows of all batches."""
    if kind not in ("errors", "quarantine", "skipped", "rejected"):
        raise InvalidSource(f"no reports of {kind!r}")
    return spark.read.parquet(f"{table_path.rstrip('/')}-reports/{kind}")
