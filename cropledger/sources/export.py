"""Sinks and exports.

All writers are distributed DataFrame writes (one file per task); nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropledger.dims import PROGRAMME
from cropledger.errors import InvalidQuery
from cropledger.functions import packed, unpacked
from cropledger.functions.text import ID_COLUMNS
from cropledger.schema import PAYMENT_COLUMNS
from cropledger.sources.csv_source import CSV_OPTIONS, path_exists
from cropledger.sources.sql_guard import check_query
from cropledger.sources.versions import relist

CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": ""}


def write_csv(df: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite") -> None:
    """CSV with header, nulls as empty cells."""
    df.write.mode(mode).options(**CSV_WRITE).option("compression", compression).csv(path)


def write_clean_csv(payments: DataFrame, path: str) -> None:
    """Cleaned rows in the fixed table column order."""
    write_csv(payments.select(*PAYMENT_COLUMNS), path)


def export_form(df: DataFrame) -> DataFrame:
    """Every array cell as its values cast to text, sorted and joined
    with ``;``; other cells as text; nulls stay null (written empty)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.sort_array(c.cast("array<string>")), ";")
        elif isinstance(f.dataType, T.StructType | T.MapType):
            c = F.to_json(c)
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_export(df: DataFrame, path: str) -> None:
    write_csv(export_form(df), path, compression="none")


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Read back an export: header, all text."""
    return spark.read.options(**CSV_OPTIONS).option("header", True).csv(path)


def named_export(spark: SparkSession, view, export_dir: str) -> str:
    """A view's result, exactly as requested, under a name made from all that
    shapes it (filters, order, page, table and its version); a finished export of that
    name is used again."""
    out = f"{export_dir.rstrip('/')}/{view.export_name()}"
    if not path_exists(spark, f"{out}/_SUCCESS"):
        relist(view.payments)
        write_export(view.to_df(), out)
    return out


# ---------------------------------------------------------------------------
# S15 entity graph
# ---------------------------------------------------------------------------

# FIXED VALUES: entity mapping (schema, id column, property → column).
LEGAL_ENTITY_PROPS = {
    "name": "recipient_name",
    "address": "recipient_address",
    "country": "recipient_country",
    "website": "recipient_url",
}
PAYMENT_PROPS = {
    "purpose": "scheme",
    "description": "scheme_description",
    "amount": "amount_original",
    "currency": "currency_original",
    "amountEur": "amount",
    "date": "year",
    "beneficiary": "recipient_id",
}


def entity_graph(payments: DataFrame) -> DataFrame:
    """Fragments with one id merged into multi-valued properties:
    ``id, schema, properties map<string, array<string>>`` (values distinct, sorted,
    properties without a value left out).

    Both entities of a payment come from one pass: each row gives one narrow row per
    entity, with a column per property and ids packed; one aggregation by id keeps the
    different rows, combined in every task before the shuffle, and the sets are made of
    them."""
    legal, pay = list(LEGAL_ENTITY_PROPS.items()), list(PAYMENT_PROPS.items())
    width = max(len(legal), len(pay))
    ids = [i for i in range(width) if any(c in ID_COLUMNS for _, c in (*legal[i : i + 1], *pay[i : i + 1]))]

    def fragment(schema: str, id_col: str, props: list[tuple[str, str]]) -> Column:
        cells = [F.col(c).cast("string") for _, c in props] + [F.lit(None).cast("string")] * (width - len(props))
        cells = [packed(c) if i in ids else c for i, c in enumerate(cells)]
        return F.struct(packed(id_col).alias("id"), F.lit(schema).alias("schema"), F.struct(*(c.alias(f"v{i}") for i, c in enumerate(cells))).alias("cells"))

    rows = payments.select(F.inline(F.array(fragment("LegalEntity", "recipient_id", legal), fragment("Payment", "pk", pay))))
    found = rows.where(F.col("id").isNotNull()).groupBy("id", "schema").agg(F.collect_set("cells").alias("rows"))

    def values(i: int) -> Column:
        one = F.array_compact(F.array_distinct(F.transform("rows", lambda x: x[f"v{i}"])))
        return F.sort_array(F.transform(one, unpacked) if i in ids else one)

    sets = found.select(unpacked("id").alias("id"), "schema", *(values(i).alias(f"v{i}") for i in range(width)))

    def properties(props: list[tuple[str, str]], more: list[Column]) -> Column:
        entries = [F.when(F.size(f"v{i}") > 0, F.struct(F.lit(p).alias("prop"), F.col(f"v{i}").alias("values"))) for i, (p, _) in enumerate(props)]
        return F.map_from_entries(F.array_compact(F.array(*entries, *more)))

    programme = F.struct(F.lit("programme").alias("prop"), F.array(F.lit(PROGRAMME)).alias("values"))
    shown = F.when(F.col("schema") == "Payment", properties(pay, [programme])).otherwise(properties(legal, []))
    return sets.select("id", "schema", shown.alias("properties"))


def write_entity_graph(payments: DataFrame, path: str) -> None:
    entity_graph(payments).write.mode("overwrite").option("compression", "gzip").json(path)


# ---------------------------------------------------------------------------
# S16 guarded raw SQL
# ---------------------------------------------------------------------------


def run_sql(spark: SparkSession, payments: DataFrame, query: str, table: str = "payments") -> DataFrame:
    """A checked read-only query over ``payments``. The name stands for the table
    while the query is resolved; a view that had it before has it again afterwards."""
    text = check_query(spark, query, table)
    before = spark.table(table) if spark.catalog.tableExists(table) else None
    payments.createOrReplaceTempView(table)
    try:
        return spark.sql(text)
    except AnalysisException as e:
        raise InvalidQuery(f"Invalid query: {e.getCondition() or 'unresolved'}") from e
    finally:
        spark.catalog.dropTempView(table)
        if before is not None and not spark.catalog.tableExists(table):
            before.createOrReplaceTempView(table)


def export_sql(spark: SparkSession, payments: DataFrame, query: str, path: str) -> None:
    """A checked query's result written as CSV (export form)."""
    write_csv(export_form(run_sql(spark, payments, query)), path, compression="none")
