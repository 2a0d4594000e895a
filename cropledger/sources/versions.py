"""Version stamps of stored tables.

Every write of the store puts a small file into ``_versions`` inside the table's
folder (Spark reads no folder that begins with ``_``): one before it changes
anything, one when it is done. The stamps that are there name the table's state,
whoever wrote them, so an export or a kept result of an older state is never
taken for the new one. Folders without stamps are named by their files.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from cropledger.sources.csv_source import file_system

FOLDER = "_versions"
#: Stamps that stay; older ones are removed by the next write.
KEPT = 8


def _names(spark: SparkSession, root: str) -> list[str]:
    folder, fs = file_system(spark, f"{root.rstrip('/')}/{FOLDER}")
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def stamp(spark: SparkSession, root: str) -> str:
    """A new stamp; its name begins with a number above all others."""
    names = _names(spark, root)
    number = int(names[-1].split("-")[0]) + 1 if names else 0
    name = f"{number:012d}-{time.time_ns():020d}-{uuid.uuid4().hex}"
    folder, fs = file_system(spark, f"{root.rstrip('/')}/{FOLDER}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.create(path(folder, name)).close()
    for old in names[:-KEPT]:
        fs.delete(path(folder, old), False)
    return name


def stamped(spark: SparkSession, root: str) -> str | None:
    """The state that the stamps of a folder name; None without stamps."""
    names = _names(spark, root)
    return hashlib.sha1("\n".join(names).encode()).hexdigest() if names else None


def _locations(df: DataFrame) -> Iterator:
    """The file listings that a frame reads."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves().iterator()
    while leaves.hasNext():
        leaf = leaves.next()
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            yield leaf.relation().location()


def version(df: DataFrame) -> str:
    """The state of all files that ``df`` reads: stamps where there are some, else the
    names and sizes of the files it listed."""
    spark, found = df.sparkSession, []
    for location in _locations(df):
        roots = location.rootPaths().iterator()
        while roots.hasNext():
            root = roots.next().toString()
            state = stamped(spark, root)
            if state is None:
                files = location.allFiles()  # stays in the JVM
                state = f"{location.sizeInBytes()}:{files.size()}:{files.hashCode()}"
            found.append(f"{root}={state}")
    return hashlib.sha1("\n".join(sorted(found)).encode()).hexdigest()


def relist(df: DataFrame) -> None:
    """Has the frame list its files anew (another application may have replaced them)."""
    for location in _locations(df):
        location.refresh()
