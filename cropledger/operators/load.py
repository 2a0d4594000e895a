"""Clean source files end to end (S1-S7 into T22): read every file grouped
by header, fill country / year from the file name where the columns are
missing or blank, force the manual per-file currencies, clean."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cropledger.operators.clean import CleanResult, clean
from cropledger.sources.csv_source import MANUAL_CURRENCY, context_from_name, currency_override, read_sources


def clean_files(
    spark: SparkSession,
    paths,
    year: int | None = None,
    country: str | None = None,
    currency: str | None = None,
    header: list[str] | None = None,
    delimiter: str = ",",
    geocode=None,
    lookups=None,
    line_breaks: bool = True,
) -> tuple[CleanResult, object]:
    """Explicit options win over the file name (S4); a missing currency
    column is filled from the option or the manual fixes table (S7). A file
    with no year or country column, no option and nothing in its name is
    rejected whole (V1) and listed in ``src.rejected``."""

    def accept(path: str, columns: list[str]) -> str | None:
        ctx_country, ctx_year = context_from_name(path)
        if "year" not in columns and year is None and ctx_year is None:
            return "InvalidSource: no year in columns, options or file name"
        if "country" not in columns and country is None and ctx_country is None:
            return "InvalidSource: no country in columns, options or file name"
        return None

    src = read_sources(spark, paths, header=header, delimiter=delimiter, accept=accept, line_breaks=line_breaks)
    ctx_year = F.col("_ctx_year") if year is None else F.lit(str(year))
    ctx_country = F.col("_ctx_country") if country is None else F.lit(country)
    cur = F.lit(currency) if currency is not None else currency_override(MANUAL_CURRENCY, ctx_country, ctx_year)
    return clean(src.every, year=ctx_year, country=ctx_country, currency=cur, geocode=geocode, lookups=lookups), src
