"""Summary entities.

``ENTITIES`` says what each summary is: its key, the sets of values it shows, and
whether it counts recipients. One builder plans them all:

- measures come from fixed-width hash aggregations. With a recipient count, rows are
  first combined by (key, recipient), which spreads a hot key over all tasks, then
  by key;
- sets of values come from the distinct (key, values) rows, combined in every task
  before the shuffle, and are joined to the measures by the key (null keys match).

A result is sorted only if the caller orders or slices it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.dims import countries_df, nuts_df, schemes_df
from cropledger.functions import avg_half_even, half_even_cents, pack_ids, packed, sum_amount, unpack_ids, unpacked
from cropledger.functions.text import ID_COLUMNS
from cropledger.plans.query import Query
from cropledger.session import ensure_checkpoint_dir, shuffles_dropped
from cropledger.sources.csv_source import remove_path


@dataclass(frozen=True)
class Entity:
    key: str
    alias: str
    #: output name -> column whose values are shown as a sorted set
    sets: tuple[tuple[str, str], ...] = ()
    #: output names of ``sets`` that show the smallest value only
    single: tuple[str, ...] = ()
    recipients: bool = True
    #: rows without a key don't form a group
    key_needed: bool = False


_NUTS = tuple((f"nuts{i}_codes", f"nuts{i}") for i in (1, 2, 3))
_YEARS, _COUNTRIES = ("years", "year"), ("countries", "country")

ENTITIES = {
    "recipient": Entity(
        "recipient_id",
        "id",
        (_YEARS, ("name", "recipient_name"), ("recipient_country", "recipient_country"), ("address", "recipient_address"), *_NUTS),
        single=("recipient_country",),
        recipients=False,
    ),
    "recipient_base": Entity("recipient_id", "id", recipients=False),
    "scheme": Entity("scheme_id", "id", (("name", "scheme"), _YEARS, _COUNTRIES), single=("name",), key_needed=True),
    "country": Entity("country", "country", (_YEARS,)),
    "year": Entity("year", "year", (_COUNTRIES,)),
    "location": Entity("recipient_address", "location", (_YEARS, _COUNTRIES, *_NUTS)),
    **{f"nuts{i}": Entity(f"nuts{i}", "nuts", (_YEARS,), key_needed=True) for i in (1, 2, 3)},
}


def measures(recipients: bool = True) -> list[Column]:
    """The shared measures as plain aggregates (global row, extended groupings)."""
    counted = [F.count_distinct(F.col("recipient_id")).alias("total_recipients")] if recipients else []
    return [
        F.count(F.lit(1)).alias("total_payments"),
        *counted,
        sum_amount("amount").alias("amount_sum"),
        avg_half_even("amount").alias("amount_avg"),
        F.max("amount").alias("amount_max"),
        F.min("amount").alias("amount_min"),
    ]


def partial_measures() -> list[Column]:
    """Fixed-width measures that add up over disjoint sets of payments."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.count("amount").alias("k"),
        F.sum("amount").alias("s"),
        F.max("amount").alias("high"),
        F.min("amount").alias("low"),
    ]


@dataclass(frozen=True)
class SummaryQuery(Query):
    """One row per key of an entity. Added columns or keys turn it into a plain
    grouped query of the entity's columns and the added ones."""

    entity: Entity | None = None

    @property
    def grouped(self) -> bool:
        return True

    def _plain(self) -> Query:
        e = self.entity
        shown = [
            (F.min(column) if name in e.single else F.sort_array(F.collect_set(column))).alias(name) for name, column in e.sets
        ]
        return Query(
            self.source, (F.col(e.key).alias(e.alias), *shown, *measures(e.recipients), *self.columns), (e.key, *self.keys), filters=self.filters
        )

    def key(self, column: str | None = None) -> Column:
        """The entity's key on its way to the result: an id goes packed."""
        column = column or self.entity.key
        return packed(column) if self.entity.key in ID_COLUMNS else F.col(column)

    def cells(self) -> DataFrame:
        """Measures by (key, recipient), by key alone if recipients aren't counted."""
        rows = self.filtered().select(self.key().alias("_key"), packed("recipient_id").alias("_recipient"), "amount")
        return rows.groupBy("_key", *(["_recipient"] if self.entity.recipients else [])).agg(*partial_measures())

    def values(self) -> DataFrame:
        """The distinct (key, values of the sets)."""
        shown = (F.col(c).alias(f"v{i}") for i, (_, c) in enumerate(self.entity.sets))
        return self.filtered().select(self.key().alias("_set_key"), *shown).distinct()

    def result(self) -> tuple[DataFrame, list[str], list[str]]:
        if self.columns or self.keys:
            return self._plain().result()
        e, first = self.entity, self.cells()
        counted = [F.count("_recipient").alias("r")] if e.recipients else []
        total = first.groupBy("_key").agg(F.sum("n").alias("n"), *counted, F.sum("k").alias("k"), F.sum("s").alias("s"), F.max("high").alias("high"), F.min("low").alias("low"))
        if e.sets:
            shown = self.values().groupBy("_set_key").agg(*(F.sort_array(F.collect_set(f"v{i}")).alias(f"v{i}") for i in range(len(e.sets))))
            total = total.join(shown, F.col("_key").eqNullSafe(F.col("_set_key")))
        sets = [(F.try_element_at(f"v{i}", F.lit(1)) if n in e.single else F.col(f"v{i}")).alias(n) for i, (n, _) in enumerate(e.sets)]
        key = unpacked("_key") if e.key in ID_COLUMNS else F.col("_key")
        out = total.select(
            key.alias("_key"),
            key.alias(e.alias),
            *sets,
            F.col("n").alias("total_payments"),
            *([F.col("r").alias("total_recipients")] if e.recipients else []),
            F.col("s").cast("decimal(28,2)").alias("amount_sum"),
            half_even_cents(F.col("s"), F.col("k")).alias("amount_avg"),
            F.col("high").alias("amount_max"),
            F.col("low").alias("amount_min"),
        )
        return out.toDF(*(f"_{i}" for i in range(len(out.columns)))), out.columns[1:], [e.key]

    def to_df(self, sliced: bool = True) -> DataFrame:
        # a slice of a summary needs an order to mean anything: by its key
        if sliced and not self.order and (self.start or self.size is not None):
            return self.order_by(self.entity.alias).to_df()
        return super().to_df(sliced)

    def count_df(self) -> DataFrame:
        return self.filtered().agg(F.count_distinct(*map(F.col, (self.entity.key, *self.keys))).alias("count"))


def entity_query(name: str, source: DataFrame) -> SummaryQuery:
    e = ENTITIES[name]
    return SummaryQuery(source, identity=(e.alias,), filters={f"{e.key}__null": False} if e.key_needed else {}, entity=e)


@dataclass(frozen=True)
class NamesQuery(Query):
    """A3: distinct (id, name, country), in that order; counts payments."""

    def to_df(self, sliced: bool = True) -> DataFrame:
        if not self.order:
            return replace(self, order=("id", "name", "recipient_country")).to_df(sliced)
        return super().to_df(sliced)


def names_query(source: DataFrame) -> NamesQuery:
    shown = tuple(F.col(c).alias(n) for n, c in (("id", "recipient_id"), ("name", "recipient_name"), ("recipient_country", "recipient_country")))
    return NamesQuery(source, shown, distinct=True, identity=("id", "name", "recipient_country"))


def global_query(source: DataFrame) -> Query:
    """One global row over any filter."""
    return Query(source, tuple(measures()))


SUMMARIES = {name: partial(entity_query, name) for name in ENTITIES} | {"recipient_name": names_query, "aggregation": global_query}
RecipientQuery, RecipientBaseQuery, SchemeQuery = (SUMMARIES[n] for n in ("recipient", "recipient_base", "scheme"))
CountryQuery, YearQuery, LocationQuery = (SUMMARIES[n] for n in ("country", "year", "location"))
Nuts1Query, Nuts2Query, Nuts3Query = (SUMMARIES[f"nuts{i}"] for i in (1, 2, 3))
RecipientNameQuery, AggregationQuery = names_query, global_query

# key column of each entity for point lookups and reverse navigation
LOOKUP_FIELDS = {
    "payment": "pk",
    "recipient": "recipient_id",
    "recipient_base": "recipient_id",
    "recipient_name": "recipient_fingerprint",
    "scheme": "scheme_id",
    "country": "country",
    "year": "year",
    "location": "recipient_address",
    "nuts1": "nuts1",
    "nuts2": "nuts2",
    "nuts3": "nuts3",
}


def get(payments: DataFrame, entity: str, value):
    """First summary row of one entity by its key, or None."""
    q = SUMMARIES[entity](payments).where(**{LOOKUP_FIELDS[entity]: value})
    return q.first()


def navigate(payments: DataFrame, entity: str, value, target: str) -> Query:
    """Summary ``target`` restricted to the payments of one entity, e.g.
    the schemes of one recipient or the years of one country."""
    return SUMMARIES[target](payments).where(**{LOOKUP_FIELDS[entity]: value})


def navigate_many(payments: DataFrame, keys: DataFrame, key: str, target: str) -> Query:
    """J9 for many keys at once: a left-semi join keeps the payments whose
    ``key`` is in ``keys`` (shuffle or broadcast chosen by AQE)."""
    return SUMMARIES[target](payments.join(keys.select(key).distinct(), key, "left_semi"))


@contextmanager
def summaries(payments: DataFrame, entities=None) -> Iterator[dict[str, DataFrame]]:
    """B1: several summaries from one filtered scan, which is kept in the shared checkpoint
    folder until the block ends: the columns that summaries read, a recipient's rows
    together (hot ones are split), so that every task combines them before a shuffle."""
    spark = payments.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/summaries-{uuid.uuid4().hex}"
    read = {"recipient_id", "recipient_name", "recipient_country", "amount"} | {c for e in ENTITIES.values() for c in (e.key, *(c for _, c in e.sets))}
    moved = pack_ids(payments.select(*(c for c in payments.columns if c in read))).hint("rebalance", "recipient_id")
    rows = unpack_ids(moved).sortWithinPartitions("recipient_id")
    try:
        with shuffles_dropped(spark):
            rows.write.option("compression", "zstd").parquet(path)
        base = spark.read.schema(rows.schema).parquet(path)
        yield {e: SUMMARIES[e](base).to_df() for e in (entities or SUMMARIES)}
    finally:
        remove_path(spark, path)


# ---------------------------------------------------------------------------
# Records attached to summary results (J5, J6, J8). The tables are inputs, so their
# joins are left to the planner.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Dimensions:
    """Lookup tables of a deployment; None takes the built-in one.

    ``countries(country, name)``, ``schemes(scheme_full_name, scheme_description)``,
    ``nuts(nuts_id, level, name)`` (``region_records``); ``parents``: the records of codes
    bring those of the regions above.
    """

    countries: DataFrame | None = None
    schemes: DataFrame | None = None
    nuts: DataFrame | None = None
    parents: bool = False


def with_country_name(spark: SparkSession, df: DataFrame, col: str = "country", countries: DataFrame | None = None) -> DataFrame:
    """Add the display ``name`` of the country code."""
    dim = (countries_df(spark) if countries is None else countries).select(F.col("country").alias("_cc"), "name")
    return df.join(dim, df[col] == dim["_cc"], "left").drop("_cc")


def with_scheme_description(spark: SparkSession, df: DataFrame, name_col: str = "name", schemes: DataFrame | None = None) -> DataFrame:
    """Scheme description looked up by full scheme name."""
    dim = (schemes_df(spark) if schemes is None else schemes).select(
        F.col("scheme_full_name").alias("_sfn"), F.col("scheme_description").alias("description")
    )
    return df.join(dim, df[name_col] == dim["_sfn"], "left").drop("_sfn")


def region_records(regions: DataFrame, parents: bool = False) -> DataFrame:
    """``nuts_id, record`` of a table of region codes: ``nuts_id``, ``name`` and, if there
    is one, ``level`` (else by the code's length: two letters of the country, then a
    character a level). ``record`` is ``struct<nuts_id, level, name>``; with ``parents`` also
    the same of the codes that it begins with and that the table has, highest first. Rows
    without a code are left out; of equal codes the least row counts."""
    level = F.col("level").cast("int") if "level" in regions.columns else F.length("nuts_id") - 2
    one = (
        regions.where("nuts_id IS NOT NULL")
        .groupBy("nuts_id")
        .agg(F.min(F.struct(level.alias("level"), "name")).alias("r"))
        .select("nuts_id", F.struct("nuts_id", "r.level", "r.name").alias("record"))
    )
    if not parents:
        return one
    above = one.where(F.length("nuts_id") > 2).select(
        "nuts_id", F.explode(F.transform(F.sequence(F.lit(2), F.length("nuts_id") - 1), lambda n: F.substring("nuts_id", F.lit(1), n))).alias("_above")
    )
    found = above.join(one.select(F.col("nuts_id").alias("_above"), F.col("record").alias("_record")), "_above")
    lists = found.groupBy("nuts_id").agg(F.sort_array(F.collect_list(F.struct(F.length("_above").alias("n"), "_record"))).alias("_parents"))
    none = F.array().cast("array<struct<nuts_id:string,level:int,name:string>>")
    shown = F.coalesce(F.transform("_parents", lambda x: x["_record"]), none)
    return one.join(lists, "nuts_id", "left").select(
        "nuts_id", F.struct("record.nuts_id", "record.level", "record.name", shown.alias("parents")).alias("record")
    )


def _nuts(spark: SparkSession, nuts: DataFrame | None, out_col: str, parents: bool = False) -> DataFrame:
    dim = region_records(nuts_df(spark) if nuts is None else nuts, parents)
    return dim.select(F.col("nuts_id").alias("_nid"), F.col("record").alias(out_col))


def with_nuts_records(
    spark: SparkSession, df: DataFrame, codes_col: str, out_col: str, nuts: DataFrame | None = None, key: str | None = None, parents: bool = False
) -> DataFrame:
    """An array of region codes as an array of records (``region_records``) in the same
    order, null for an unknown code. ``key`` is a column that tells the rows of ``df``
    apart, by which they are brought together again; without one all columns do."""
    flat = df.select("*", F.posexplode_outer(codes_col).alias("_pos", "_code"))
    joined = flat.join(_nuts(spark, nuts, "_record", parents), F.col("_code") == F.col("_nid"), "left")
    items = F.sort_array(F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_record"))))
    records = F.transform(items, lambda x: x["_record"]).alias(out_col)
    if key is None:
        return joined.groupBy(*df.columns).agg(records)
    others = [F.any_value(F.col(c)).alias(c) for c in df.columns if c != key]
    return joined.groupBy(key).agg(*others, records).select(*df.columns, out_col)


def with_nuts_record(
    spark: SparkSession, df: DataFrame, code_col: str, out_col: str, nuts: DataFrame | None = None, parents: bool = False
) -> DataFrame:
    """J8 for one code per row (payments, NUTS summaries)."""
    return df.join(_nuts(spark, nuts, out_col, parents), F.col(code_col) == F.col("_nid"), "left").drop("_nid")
