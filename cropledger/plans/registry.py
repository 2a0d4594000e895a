"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver's tables, with the DuckDB
SQL that must give the same rows (``None`` where SQL cannot express it).

Results are shown in export form (S13): arrays as sorted text joined by
``;``, decimals as correctly rounded doubles, so both engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return deco


def present(df: DataFrame) -> DataFrame:
    """Export form: arrays → sorted ';'-joined text, decimals → double via
    text, structs/maps → JSON text."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        dt = field.dataType
        if isinstance(dt, T.ArrayType):
            c = F.array_join(F.sort_array(c.cast("array<string>")), ";")
        elif isinstance(dt, T.DecimalType):
            c = c.cast("string").cast("double")
        elif isinstance(dt, T.StructType | T.MapType):
            c = F.to_json(c)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # registration happens on import of the query modules
    from cropledger.plans import queries_clean, queries_io, queries_summary  # noqa: F401
