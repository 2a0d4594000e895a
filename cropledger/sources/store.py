"""The payments table on storage.

One Parquet directory partitioned by ``country`` and ``year`` (partition
pruning replaces the reference's primary index prefix), rows sorted by
``recipient_id`` inside each file so Parquet min/max statistics prune
recipient lookups. Writes go through AQE's rebalance so a hot partition value
is split over several tasks and files instead of one.

A write first puts its rows into the shared checkpoint folder, once; the same job
counts the rows that break a rule (V3). Only if there are none is the table touched.
A write of several jobs needs the disk of the largest: shuffle files go with their job,
and ids are shuffled as bytes. Every write leaves a version stamp (``versions``).
"""

from __future__ import annotations

import operator
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cropledger.dims import COUNTRIES, CURRENCIES
from cropledger.errors import ImproperlyConfigured, InvalidRows
from cropledger.functions import pack_ids, unpack_ids
from cropledger.operators.clean import dedup_stored
from cropledger.schema import NOT_NULL_COLUMNS, PARTITION_COLUMNS, PAYMENT_COLUMNS, PAYMENTS_SCHEMA, YEAR_MAX, YEAR_MIN
from cropledger.session import ensure_checkpoint_dir, shuffles_dropped
from cropledger.sources.csv_source import path_exists, remove_path
from cropledger.sources.versions import stamp

# reference table's sorting key: the identity of a stored row
UPSERT_KEY = ["country", "year", "recipient_id", "pk"]
#: Codec of what is written: ids of hex digits take half the space of the default one's.
COMPRESSION = "zstd"


def conform(df: DataFrame) -> DataFrame:
    """Columns by name in table order, cast to the table types (never by
    position)."""
    cols = []
    for f in PAYMENTS_SCHEMA.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _clustered(df: DataFrame) -> DataFrame:
    """A task's rows by partition and recipient: what stands together compresses well, in
    the file and in the shuffle that reads it."""
    return df.sortWithinPartitions(*PARTITION_COLUMNS, "recipient_id")


def layout(df: DataFrame) -> DataFrame:
    """B2: rebalance by partition columns (AQE splits skewed values), then
    sort each task's rows by partition and recipient."""
    moved = unpack_ids(pack_ids(df).hint("rebalance", *PARTITION_COLUMNS))
    return _clustered(moved)


def _write(rows: DataFrame, path: str, mode: str) -> None:
    """The rows into the table's folders; ``overwrite`` replaces those they touch."""
    (
        layout(rows)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )


def init_table(spark: SparkSession, path: str, recreate: bool = False) -> None:
    """Create the (empty) table; one that exists is an error, unless
    ``recreate`` replaces it."""
    if path_exists(spark, path) and not recreate:
        raise ImproperlyConfigured(f"there is a table at {path} already")
    empty = spark.createDataFrame([], PAYMENTS_SCHEMA)
    empty.write.mode("overwrite").partitionBy(*PARTITION_COLUMNS).parquet(path)
    stamp(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAYMENTS_SCHEMA).parquet(path).select(*PAYMENT_COLUMNS)


#: Region code columns, checked against a table of codes if the writer gives one.
REGION_COLUMNS = ["nuts1", "nuts2", "nuts3"]


def rules(countries: list[str] | None = None) -> dict[str, Column]:
    """V3: the rules of a stored row, by name: true where a row breaks one. ``countries``
    are the served payment countries, by default all known ones."""
    served = countries or [c for c, *_ in COUNTRIES]
    broken = {f"{c} is null": F.col(c).isNull() for c in NOT_NULL_COLUMNS}
    # an unknown value is told apart from a null, which has a rule of its own
    broken["country is unknown"] = ~F.col("country").isin(*served)
    broken["year is out of range"] = ~F.col("year").between(YEAR_MIN, YEAR_MAX)
    broken["currency_original is unknown"] = ~F.col("currency_original").isin(*CURRENCIES)
    broken["currency is not EUR"] = F.col("currency") != "EUR"
    return broken


def _staged(df: DataFrame, scratch: str, countries: list[str] | None, regions: DataFrame | None) -> tuple[DataFrame, int]:
    """The rows written to ``scratch``, and their number; ``InvalidRows`` if any breaks a
    rule. The counts come with the write; region codes are counted first, then looked
    up in the table ``regions`` (its first column) by an anti-join of the few codes."""
    spark = df.sparkSession
    broken = rules(countries)
    obs = Observation("write")
    counts = [F.count_if(F.coalesce(test, F.lit(False))).alias(f"r{i}") for i, test in enumerate(broken.values())]
    _clustered(df).observe(obs, F.count(F.lit(1)).alias("rows"), *counts).write.option("compression", COMPRESSION).parquet(f"{scratch}/new")
    found = {rule: int(obs.get[f"r{i}"]) for i, rule in enumerate(broken)}
    new = spark.read.schema(PAYMENTS_SCHEMA).parquet(f"{scratch}/new")
    if regions is not None:
        cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("code")) for c in REGION_COLUMNS])
        codes = new.select(F.inline(cells)).where("code IS NOT NULL").groupBy("name", "code").agg(F.count(F.lit(1)).alias("n"))
        known = regions.select(F.col(regions.columns[0]).cast("string").alias("code")).distinct()
        strange = codes.join(known, "code", "left_anti").groupBy("name").agg(F.sum("n").alias("n"))
        found |= {f"{r['name']} is unknown": int(r["n"]) for r in strange.collect()}
    if any(found.values()):
        raise InvalidRows({rule: n for rule, n in found.items() if n})
    return new, int(obs.get["rows"])


def insert(df: DataFrame, path: str, countries: list[str] | None = None, regions: DataFrame | None = None) -> int:
    """Append rows by name; returns the number of rows written. Rows that break a
    rule (V3) are an error and nothing is written; so are rows whose key is stored
    already: ``upsert`` is the way to bring them again."""
    spark = df.sparkSession
    scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/insert-{uuid.uuid4().hex}"
    try:
        with shuffles_dropped(spark):
            new, count = _staged(conform(df), scratch, countries, regions)
            stored = _partitions(spark, path) if path_exists(spark, path) else set()
            coming = {tuple(r) for r in new.select(*PARTITION_COLUMNS).distinct().collect()} if stored else set()
            if shared := stored & coming:
                old = read_table(spark, path).where(in_partitions(shared)).select(*UPSERT_KEY)
                twice = new.where(in_partitions(shared)).select(*UPSERT_KEY).join(old, UPSERT_KEY, "left_semi").limit(1)
                if not twice.isEmpty():
                    raise ImproperlyConfigured(f"rows that are to be inserted are in {path} already")
            stamp(spark, path)
            _write(new, path, "append")
            stamp(spark, path)
    finally:
        remove_path(spark, scratch)
    return count


def _partitions(spark: SparkSession, path: str) -> set[tuple]:
    """The table's (country, year) pairs, a few hundred; read from its folders."""
    return {tuple(r) for r in read_table(spark, path).select(*PARTITION_COLUMNS).distinct().collect()}


def in_partitions(pairs: set[tuple]) -> Column:
    """The rows of these (country, year) pairs; prunes the table's folders."""
    years: dict = {}
    for country, year in sorted(pairs, key=str):
        years.setdefault(country, []).append(year)
    tests = [F.col("country").eqNullSafe(c) & F.col("year").isin(y) for c, y in years.items()]
    return reduce(operator.or_, tests) if tests else F.lit(False)


def upsert(spark: SparkSession, df: DataFrame, path: str, countries: list[str] | None = None, regions: DataFrame | None = None) -> int:
    """New rows win over stored rows with the same key
    (country, year, recipient_id, pk); of new rows with one key the first wins. Only the
    partitions the new rows touch are read and rewritten (dynamic partition
    overwrite). Returns the number of rows taken in; rows that break a rule (V3) are an
    error and the table stays as it is.

    The new rows are made once: they are written to the shared checkpoint folder,
    which also lets them come from this very table, and all steps read that file. The
    stored rows that stay in those partitions go there too before both replace them; these
    files are removed at the end."""
    scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/upsert-{uuid.uuid4().hex}"
    try:
        with shuffles_dropped(spark):
            _clustered(conform(df)).write.option("compression", COMPRESSION).parquet(f"{scratch}/all")
            come = spark.read.schema(PAYMENTS_SCHEMA).parquet(f"{scratch}/all")
            keyed = dedup_stored(come, UPSERT_KEY, [c for c in PAYMENT_COLUMNS if c not in UPSERT_KEY])
            new, count = _staged(keyed, scratch, countries, regions)
            remove_path(spark, f"{scratch}/all")
            if not path_exists(spark, path):
                init_table(spark, path)
            touched = {tuple(r) for r in new.select(*PARTITION_COLUMNS).distinct().collect()}
            shared = touched & _partitions(spark, path)
            merged = new
            if shared:
                old = read_table(spark, path).where(in_partitions(shared))
                stays = unpack_ids(pack_ids(old).join(pack_ids(new.select(*UPSERT_KEY)), UPSERT_KEY, "left_anti")).select(*PAYMENT_COLUMNS)
                stays.write.option("compression", COMPRESSION).parquet(f"{scratch}/stays")
                merged = new.unionByName(spark.read.schema(PAYMENTS_SCHEMA).parquet(f"{scratch}/stays"))
            if touched:
                stamp(spark, path)
                _write(merged, path, "overwrite")
                stamp(spark, path)
    finally:
        remove_path(spark, scratch)
    return count
