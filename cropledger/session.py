"""Session helpers: local session for tests and bench, checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def default_heap() -> str:
    """A quarter of the machine's memory (1 GB at least): the rest is for Python
    workers and the page cache."""
    total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    return f"{max(1024, total // 4 >> 20)}m"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cropledger") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # HotSpot compiles no method beyond 8000 bytes: a stage that gives a larger one runs
        # faster as one projection per operator
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY") or default_heap())
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def compiled_methods(spark: SparkSession) -> None:
    """For long projections: HotSpot interprets a generated method beyond 8000 bytes;
    below this limit Spark runs a compiled projection per operator."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within the block the shuffle files of a job go when it ends, not when the driver
    happens to collect its garbage: large jobs one after another need the disk of the
    largest. For jobs whose frames are not run again."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP_CONF) if before is None else spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster in
    ``spark.checkpoint.dir``; only when it is unset (tests, local runs) set a
    fresh scratch folder of our own. Only a local master may fall back to it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="cropledger-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, path)
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of executors, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
