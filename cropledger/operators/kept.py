"""Kept summaries (B1, A1-A11): partial sums beside a stored payments table.

The summaries' measures add up over disjoint sets of payments, and the distinct
(key, recipient) and (key, value) pairs that the counts and sets come from unite. So
each (country, year) partition of the table has its own cells here, in a folder per
kind of cell that is partitioned alike:

- ``<entity>``: measures by (key, recipient), for the recipients by recipient alone;
- ``<entity>_values``: the distinct (key, values) of the entity's sets;
- ``names``: the distinct (id, name, country) of recipients.

``refresh`` makes the cells of those partitions anew whose files changed, whoever wrote
them (upsert, ingest, another application), and no others; a summary then reads cells
only. What the cells were made from is noted last, in ``states``, as the number of files
and the sum of their hashes for each partition: after a crash the partitions that were
in work are made again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.errors import ImproperlyConfigured, InvalidQuery
from cropledger.functions import half_even_cents, packed
from cropledger.operators.summaries import ENTITIES, Entity, SummaryQuery, names_query, partial_measures
from cropledger.plans.query import Query, parse_filter
from cropledger.schema import PARTITION_COLUMNS, PAYMENTS_SCHEMA
from cropledger.session import shuffles_dropped
from cropledger.sources import store
from cropledger.sources.csv_source import path_exists, remove_path

STATE_SCHEMA = "country string, year int, files long, mark decimal(38,0)"
#: The summary of all rows is made from the cells of this entity.
GLOBAL_FROM = "country"


def states(spark: SparkSession, table: str) -> DataFrame:
    """``country, year, files, mark`` of each partition of the table, from the names,
    lengths and times of its files; no file is opened. The executors list the folders,
    and the sum of hashes is one number however many files there are."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", table).load(table)
    if any(c not in files.columns for c in PARTITION_COLUMNS):  # no file, or none in a partition
        return spark.createDataFrame([], STATE_SCHEMA)
    mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    return files.groupBy(F.col("country").cast("string").alias("country"), F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("files"), mark.cast("decimal(38,0)").alias("mark")
    )


@dataclass(frozen=True)
class KeptQuery(SummaryQuery):
    """A summary from kept cells. Filters may be on country, year, the entity's key and
    nothing else; other columns and keys need the payments."""

    kept: KeptSummaries | None = None

    def _cut(self, kind: str, key: str) -> DataFrame:
        renamed = {}
        for name, value in self.filters.items():
            column, suffix = parse_filter(name)
            if column not in (*PARTITION_COLUMNS, self.entity.key):
                raise InvalidQuery(f"kept summaries of {self.entity.key} have no column {column!r}")
            column = key if column == self.entity.key else column
            renamed[f"{column}__{suffix}" if suffix else column] = value
        return Query(self.kept.read(kind), filters=renamed).filtered()

    def result(self) -> tuple[DataFrame, list[str], list[str]]:
        if self.columns or self.keys:
            raise InvalidQuery("kept summaries take no further columns or keys")
        return super().result()

    def cells(self) -> DataFrame:
        rows = self._cut(self.kept.kind(self.entity), "_key")
        recipient = [packed("_recipient").alias("_recipient")] if self.entity.recipients else []
        return rows.groupBy(self.key("_key").alias("_key"), *recipient).agg(*_merged())

    def values(self) -> DataFrame:
        rows = self._cut(f"{self.kept.kind(self.entity)}_values", "_set_key")
        return rows.select(self.key("_set_key").alias("_set_key"), *(f"v{i}" for i in range(len(self.entity.sets)))).distinct()

    def count_df(self) -> DataFrame:
        return self._cut(self.kept.kind(self.entity), "_key").agg(F.count_distinct("_key").alias("count"))


def _merged() -> list:
    return [
        F.sum("n").alias("n"),
        F.sum("k").alias("k"),
        F.sum("s").cast("decimal(38,2)").alias("s"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
    ]


@dataclass(frozen=True)
class KeptSummaries:
    """The cells of the payments table at ``table``, in folders under ``root`` (not inside
    the table's). A query made before a refresh must be made anew after it."""

    spark: SparkSession
    table: str
    root: str

    # -- layout -------------------------------------------------------------
    def kind(self, entity: Entity) -> str:
        """Folder of an entity's cells: entities that differ in their sets alone share it."""
        return next(n for n, e in ENTITIES.items() if (e.key, e.recipients) == (entity.key, entity.recipients))

    def kinds(self) -> dict[str, Entity]:
        return {self.kind(e): e for e in reversed(ENTITIES.values())}

    def _path(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/{kind}"

    def _schema(self, kind: str) -> str:
        """Columns of a folder; the partition columns come last."""
        types = {f.name: f.dataType.simpleString() for f in PAYMENTS_SCHEMA.fields}
        if kind == "names":
            columns = [(c, types[c]) for c in ("recipient_id", "recipient_name", "recipient_country")]
        elif kind.endswith("_values"):
            e = self.kinds()[kind.removesuffix("_values")]
            columns = [("_set_key", types[e.key]), *((f"v{i}", types[c]) for i, (_, c) in enumerate(e.sets))]
        else:
            e = self.kinds()[kind]
            first = [("_key", types[e.key]), *([("_recipient", types["recipient_id"])] if e.recipients else [])]
            columns = [*first, ("n", "long"), ("k", "long"), ("s", "decimal(28,2)"), ("high", types["amount"]), ("low", types["amount"])]
        return ", ".join(f"{n} {t}" for n, t in (*columns, *((c, types[c]) for c in PARTITION_COLUMNS)))

    def read(self, kind: str) -> DataFrame:
        if not path_exists(self.spark, self._path("states")):
            raise ImproperlyConfigured(f"there are no kept summaries at {self.root}: refresh makes them")
        return self.spark.read.schema(self._schema(kind)).parquet(self._path(kind))

    # -- refresh --------------------------------------------------------------
    def _noted(self) -> DataFrame:
        if not path_exists(self.spark, f"{self._path('states')}/_SUCCESS"):
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(self._path("states"))

    def stale(self) -> set[tuple]:
        """The (country, year) pairs whose cells are not of the table's present files."""
        return self._stale([tuple(r) for r in states(self.spark, self.table).collect()])[0]

    def _stale(self, now: list[tuple]) -> tuple[set[tuple], set[tuple]]:
        """(pairs to make, pairs to remove); a few thousand rows at most."""
        old = {(c, y): (f, m) for c, y, f, m in map(tuple, self._noted().collect())}
        new = {(c, y): (f, m) for c, y, f, m in now}
        return {p for p, state in new.items() if old.get(p) != state}, set(old) - set(new)

    def refresh(self) -> set[tuple]:
        """Makes the cells of changed partitions and removes those of partitions that are
        gone; returns the pairs made. Only they are read from the table, a few columns
        for each folder, and only they are replaced."""
        # taken before the rows are read: what changes meanwhile is stale afterwards
        now = [tuple(r) for r in states(self.spark, self.table).collect()]
        changed, gone = self._stale(now)
        if changed or not path_exists(self.spark, self._path("states")):
            rows = store.read_table(self.spark, self.table).where(store.in_partitions(changed))
            with shuffles_dropped(self.spark):
                for kind, cells in self._cells(rows):
                    (
                        cells.hint("rebalance", *PARTITION_COLUMNS)
                        .write.mode("overwrite")
                        .option("partitionOverwriteMode", "dynamic")
                        .option("compression", store.COMPRESSION)
                        .partitionBy(*PARTITION_COLUMNS)
                        .parquet(self._path(kind))
                    )
        for country, year in gone:
            for kind, _ in self._cells(None):
                remove_path(self.spark, f"{self._path(kind)}/country={country}/year={year}")
        if changed or gone or not path_exists(self.spark, self._path("states")):
            noted = self.spark.createDataFrame(now, STATE_SCHEMA)
            noted.coalesce(1).write.mode("overwrite").parquet(self._path("states"))
        return changed

    def _cells(self, rows: DataFrame | None) -> Iterator[tuple[str, DataFrame | None]]:
        """(folder, cells of ``rows``) of every kind."""
        if rows is None:
            for kind, e in self.kinds().items():
                yield from ((kind, None), *([(f"{kind}_values", None)] if e.sets else []))
            yield "names", None
            return
        at = [F.col(c) for c in PARTITION_COLUMNS]
        for kind, e in self.kinds().items():
            key = F.col(e.key).alias("_key")
            by = ["_key", *(["_recipient"] if e.recipients else [])]
            flat = rows.select(*at, key, F.col("recipient_id").alias("_recipient"), "amount")
            yield kind, flat.groupBy(*PARTITION_COLUMNS, *by).agg(*partial_measures()).withColumn("s", F.col("s").cast("decimal(28,2)"))
            if e.sets:
                shown = (F.col(c).alias(f"v{i}") for i, (_, c) in enumerate(e.sets))
                yield f"{kind}_values", rows.select(*at, F.col(e.key).alias("_set_key"), *shown).distinct()
        yield "names", rows.select(*at, "recipient_id", "recipient_name", "recipient_country").distinct()

    # -- writes that keep the cells fresh ---------------------------------------
    def upsert(self, df: DataFrame, **options) -> int:
        """``store.upsert`` and a refresh of the partitions it touched."""
        count = store.upsert(self.spark, df, self.table, **options)
        self.refresh()
        return count

    # -- summaries --------------------------------------------------------------
    def query(self, name: str) -> Query:
        """The summary ``name`` of ``summaries.SUMMARIES`` from the cells."""
        if name == "recipient_name":
            return names_query(self.read("names"))
        if name == "aggregation":
            return Query(self._global())
        e = ENTITIES[name]
        return KeptQuery(
            self.read(self.kind(e)), identity=(e.alias,), filters={f"{e.key}__null": False} if e.key_needed else {}, entity=e, kept=self
        )

    def _global(self) -> DataFrame:
        cells = self.read(GLOBAL_FROM).groupBy(packed("_recipient").alias("_recipient")).agg(*_merged())
        total = cells.agg(F.count("_recipient").alias("r"), *_merged())
        return total.select(
            F.coalesce("n", F.lit(0)).alias("total_payments"),
            F.col("r").alias("total_recipients"),
            F.col("s").cast("decimal(28,2)").alias("amount_sum"),
            half_even_cents(F.col("s"), F.col("k")).alias("amount_avg"),
            F.col("high").alias("amount_max"),
            F.col("low").alias("amount_min"),
        )
