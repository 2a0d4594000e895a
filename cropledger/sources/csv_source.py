"""Raw CSV sources.

Every cell is read as text. Spark reads the header lines of all files in one job;
only the different headers, and the files of each, come to the driver. Each
group of files with one header is read by one parallel scan. Quoted cells may hold
line breaks, so a file is one task by default; ``line_breaks=False`` lets plain
files split. Rows with more fields than the header are skipped and counted
(their extra field lands in an overflow column); short rows are padded with nulls.
``_file``, ``_block`` and ``_row`` place a row in its source, and country / year can
be derived from the file name.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropledger.schema import TOO_LONG_COL

OVERFLOW_COL = "_overflow"
#: whether the row's file has no currency column (S7 fills those only)
NO_CURRENCY_COL = "_no_currency"

# FIXED VALUES: file-name patterns giving (country, year), tried in order (the longer
# one first: ``pl_Subsidies_2015`` is of PL, not of ES). They begin at the name's start:
# else a name without a match is searched again from each of its characters.
FILENAME_PATTERNS = (
    r"^.*([a-z\D]{2})_Subsidies_(\d{4})",
    r"^.*([a-z\D]{2})_(\d{4})",
)

CSV_OPTIONS = {
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


@dataclass
class SourceRead:
    """Raw rows (all text, ``_file`` set), those with too many cells marked."""

    every: DataFrame
    headers: dict[tuple[str, ...], list[str]] = field(default_factory=dict)
    rejected: list[tuple[str, str]] = field(default_factory=list)

    @property
    def rows(self) -> DataFrame:
        return self.every.where(~F.col(TOO_LONG_COL)).drop(TOO_LONG_COL)

    @property
    def skipped(self) -> DataFrame:
        """Rows with too many cells, counted by file."""
        return self.every.where(TOO_LONG_COL).groupBy("_file").agg(F.count(F.lit(1)).alias("rows"))


def file_system(spark: SparkSession, path: str):
    """A path and its file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(conf)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (cluster-safe)."""
    p, fs = file_system(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Files under ``path`` through the Hadoop file system (works for local,
    HDFS and object stores)."""
    p, fs = file_system(spark, path)
    if not fs.exists(p):
        return []
    if fs.getFileStatus(p).isFile():
        return [str(p.toString())]
    it = fs.listFiles(p, True)
    out = []
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not name.startswith(("_", ".")):
            out.append(str(st.getPath().toString()))
    return sorted(out)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of our own through the Hadoop file system."""
    p, fs = file_system(spark, path)
    fs.delete(p, True)


def header_groups(spark: SparkSession, files: list[str], delimiter: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Files by their column names. A job reads each file's first line: the first of
    its text splits, of which all but the first line are dropped in the tasks."""
    lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("line"))
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("line").collect():
        cells = next(csv.reader([(r["line"] or "").lstrip("\ufeff")], delimiter=delimiter, quotechar='"'), [])
        groups.setdefault(tuple(c.strip().strip('"').strip() for c in cells), []).extend(r["files"])
    return groups


def context_from_path(path: Column) -> tuple[Column, Column]:
    """(country, year) from a file name like ``cz_2015.csv.gz`` or
    ``xx_Subsidies_2015.csv``; null when no pattern matches."""
    # a plain cut: a pattern for the last part is tried from every character of the path, for every row
    name = F.substring_index(path, "/", -1)
    name = F.when(F.contains(name, F.lit("_")), name)  # no pattern matches without one
    # nullif takes its text once where it always runs; a case would match for its test and again for its value
    parts = [[F.nullif(F.regexp_extract(name, pat, group), F.lit("")) for pat in FILENAME_PATTERNS] for group in (1, 2)]
    return F.coalesce(*parts[0]), F.coalesce(*parts[1])


def context_from_name(path: str) -> tuple[str | None, str | None]:
    """S4 on the driver, for file metadata only: (country, year) from a file
    name, same patterns as ``context_from_path``."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    for pat in FILENAME_PATTERNS:
        m = re.match(pat, name)
        if m:
            return m.group(1), m.group(2)
    return None, None


def read_group(spark: SparkSession, files: list[str], columns: tuple[str, ...], header: bool, delimiter: str, line_breaks: bool) -> DataFrame:
    """All rows of files with these columns, as text, with their place and
    ``OVERFLOW_COL`` set where a row is too long."""
    fields = [*columns, OVERFLOW_COL]
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in fields])
    options = CSV_OPTIONS | {"multiLine": str(line_breaks).lower(), "sep": delimiter, "header": str(header).lower()}
    rows = spark.read.options(**options).schema(schema).csv(files)
    return placed(rows).withColumn(NO_CURRENCY_COL, F.lit("currency" not in columns))


def placed(rows: DataFrame) -> DataFrame:
    """``_file``, ``_block`` (where the row's split begins) and, unless the source has
    its own, ``_row``: the row's number in its split, whatever else is read with it."""
    rows = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    if "_row" in rows.columns:
        return rows.drop("_at")
    # a task may read several files: a split's first number is taken off
    heads = rows.groupBy(F.col("_file").alias("_f"), F.col("_block").alias("_b")).agg(F.min("_at").alias("_head"))
    joined = rows.join(heads, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return joined.withColumn("_row", F.col("_at") - F.col("_head")).drop("_f", "_b", "_head", "_at")


def read_sources(
    spark: SparkSession,
    paths: str | list[str],
    header: list[str] | None = None,
    delimiter: str = ",",
    accept=None,
    line_breaks: bool = True,
) -> SourceRead:
    """Read all files, grouped by header, as one all-text
    DataFrame with ``_file``, ``_block``, ``_row`` and file-name context columns
    ``_ctx_country`` / ``_ctx_year`` (S4). ``accept(file, columns)`` may
    reject whole files before reading (V1); rejected files are listed in
    ``SourceRead.rejected``."""
    files: list[str] = []
    for p in [paths] if isinstance(paths, str) else paths:
        files.extend(list_files(spark, p))
    if not files:
        raise FileNotFoundError(f"no input files under {paths}")
    found = {tuple(header): files} if header else header_groups(spark, files, delimiter)
    groups: dict[tuple[str, ...], list[str]] = {}
    rejected: list[tuple[str, str]] = []
    for cols, members in found.items():
        for f in members:
            reason = accept(f, list(cols)) if accept else None
            if reason:
                rejected.append((f, reason))
            else:
                groups.setdefault(cols, []).append(f)
    if not groups:
        raise FileNotFoundError(f"every input file was rejected: {rejected}")

    frames = [read_group(spark, members, cols, header is None, delimiter, line_breaks) for cols, members in groups.items()]
    marked = [f.withColumn(TOO_LONG_COL, F.col(OVERFLOW_COL).isNotNull()).drop(OVERFLOW_COL) for f in frames]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    ctx_country, ctx_year = context_from_path(F.col("_file"))
    return SourceRead(rows.withColumns({"_ctx_country": ctx_country, "_ctx_year": ctx_year}), groups, sorted(rejected))


def currency_override(overrides: dict[tuple[str, int], str], country: Column, year: Column) -> Column:
    """Per (country, year) currency forced for files lacking a currency
    column (a bounded table of manual fixes)."""
    expr = F.lit(None).cast("string")
    for (c, y), cur in overrides.items():
        expr = F.when((F.upper(country) == c.upper()) & (year.cast("int") == int(y)), F.lit(cur)).otherwise(expr)
    return expr


# FIXED VALUES: manual per-file currency fixes.
MANUAL_CURRENCY = {("LT", 2015): "LTL", ("LT", 2016): "LTL", ("PL", 2015): "EUR"}

