"""Lookups (J1-J4, J7) as column expressions over bounded dictionaries.

Every dictionary here is a fixed table of at most a few hundred entries, so
it is inlined into the plan as a map literal or a CASE chain: no join, no
shuffle, no broadcast, and the expression stays inside whole-stage codegen.
The geocode lookup (J2) is the exception: its table is data, so it is an
ordinary left join left to the planner. So are scheme tables given as a DataFrame
(``match_schemes``).
"""

from __future__ import annotations

import json
import re
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropledger.dims import (
    COUNTRY_CODE_ALIASES,
    COUNTRY_CURRENCY,
    CURRENCY_RATES,
    SCHEMES,
    world_countries,
)


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _map(pairs) -> Column:
    """A map literal from (key, value) pairs. Text values go through one JSON literal,
    which the optimiser folds to a map: the plan it analyses stays small however
    many entries there are. Other values are SQL snippets given as ``("sql", text)``."""
    pairs = list(pairs)
    if all(v is None or isinstance(v, str) for _, v in pairs):
        return F.from_json(F.lit(json.dumps(dict(pairs))), "map<string,string>")
    return F.expr("map(" + ", ".join(f"{_sql_str(k)}, {v[1]}" for k, v in pairs) + ")")


def country_code(text: Column, countries=None) -> Column:
    """Country text (code, English or own name, any case, ``EL``, ``UK``) → ISO
    code; null when unknown. ``countries``: (code, name, other names) of a deployment,
    default every ISO country. Codes, the common case, hit a hashed ``isin`` set;
    only other text scans the (bounded) name map."""
    countries = world_countries() if countries is None else countries
    aliases = {}
    for code, name, more in countries:
        for alias in (name, *((more,) if isinstance(more, str) else more)):
            aliases.setdefault(alias.lower(), code)
    up = F.upper(F.trim(text))
    by_name = F.try_element_at(_map(sorted(aliases.items())), F.lower(F.trim(text)))
    out = F.when(up.isin(*[c for c, *_ in countries]), up)
    for alias, code in COUNTRY_CODE_ALIASES.items():
        out = out.when(up == alias, F.lit(code))
    return out.otherwise(by_name)


def country_name(code: Column, countries=None) -> Column:
    """J6 as an expression: ISO code → English display name."""
    countries = world_countries() if countries is None else countries
    return F.try_element_at(_map([(c, n) for c, n, *_ in countries]), code)


def national_currency(country: Column) -> Column:
    """J1 step 1: payment country → national currency (null when unknown)."""
    return F.try_element_at(_map(COUNTRY_CURRENCY.items()), country)


def rate_to_eur(currency: Column, year: Column, rates: dict[str, float] | None = None) -> Column:
    """J1 step 2: (currency, year) → rate as decimal(12,10); null when the
    table has no such year. Two-level lookup: currency → array of yearly
    rates (one map entry per currency), then the year indexes the array. ``rates``:
    ``CUR|year`` → rate of a deployment, default the built-in table."""
    table = rate_decimals(rates)
    first, last = _rate_years(table)
    by_cur: dict[str, list] = {}
    for key, rate in table.items():
        cur, yr = key.split("|")
        by_cur.setdefault(cur, [None] * (last - first + 1))[int(yr) - first] = rate
    def dec(r):
        return f"CAST('{r}' AS DECIMAL(12,10))" if r is not None else "CAST(NULL AS DECIMAL(12,10))"

    pairs = [(cur, ("sql", "array(" + ", ".join(dec(r) for r in rates) + ")")) for cur, rates in sorted(by_cur.items())]
    found = F.try_element_at(_map(pairs), currency)
    idx = (year - first + 1).cast("int")
    return F.when(year.between(first, last), F.try_element_at(found, idx))


def _rate_years(table) -> tuple[int, int]:
    years = [int(k.split("|")[1]) for k in table]
    return min(years), max(years)


def rate_decimals(rates: dict[str, float] | None = None) -> dict[str, Decimal]:
    """The rate table rounded half up to ten decimals (decimal(12,10))."""
    return {
        key: Decimal(repr(v)).quantize(Decimal("1e-10"), rounding=ROUND_HALF_UP)
        for key, v in (CURRENCY_RATES if rates is None else rates).items()
    }


# ---------------------------------------------------------------------------
# Scheme matching
# ---------------------------------------------------------------------------


def scheme_full_names(schemes=SCHEMES) -> list[tuple[str, str | None, str]]:
    """(id, name, full name) in dictionary order; full name is ``id - name``
    with a trailing `` -`` stripped."""
    out = []
    for sid, _art, name, _desc in schemes:
        full = f"{sid} - {name or ''}".rstrip(" -")
        out.append((sid, name, full))
    return out


def scheme_id_pattern(schemes=SCHEMES) -> str:
    """Alternation of the known ids, longest first, each followed by
    whitespace, case-insensitive."""
    ids = sorted((s[0] for s in schemes), key=len, reverse=True)
    return "(?i)(" + "|".join(re.escape(i) for i in ids) + r")\s"


def guess_scheme(text: Column, schemes=SCHEMES) -> Column:
    """J3 then J4: a known id followed by whitespace (leftmost, longest id
    first) gives that scheme's full name; else the first dictionary name that
    contains the text (lower case); else the text unchanged."""
    names = scheme_full_names(schemes)
    id_to_full = _map([(sid.lower(), full) for sid, _n, full in names])
    matched = F.regexp_extract(text, scheme_id_pattern(schemes), 1)
    by_id = F.when(matched != "", F.try_element_at(id_to_full, F.lower(matched)))
    low = F.lower(text)
    by_name = None
    for _sid, name, full in names:
        if name is None:
            continue
        cond = F.lit(name.lower()).contains(low)
        by_name = F.when(cond, F.lit(full)) if by_name is None else by_name.when(cond, F.lit(full))
    return F.coalesce(by_id, by_name, text) if by_name is not None else F.coalesce(by_id, text)


#: Characters of the pieces that names and texts are joined on; shorter texts are one piece.
GRAM = 3


def _grams(text: Column) -> Column:
    """The distinct pieces of up to ``GRAM`` characters of a text."""

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))

    sizes = [of(n) for n in range(1, GRAM + 1)]
    return F.array_distinct(F.concat(*sizes))


def scheme_index(schemes: DataFrame) -> DataFrame:
    """``place, id, name, full`` of a scheme table: ``scheme_id``, ``scheme_name`` and, if
    there is one, ``ord``, the place by which the first of several schemes is told (else
    id and name in their order). Rows without an id are left out."""
    order = ["ord", "scheme_id", "scheme_name"] if "ord" in schemes.columns else ["scheme_id", "scheme_name"]
    return schemes.where("scheme_id IS NOT NULL").select(
        F.struct(*order).alias("place"),
        F.lower("scheme_id").alias("id"),
        F.lower("scheme_name").alias("name"),
        F.regexp_replace(F.concat(F.col("scheme_id"), F.lit(" - "), F.coalesce("scheme_name", F.lit(""))), r"[ -]+$", "").alias("full"),
    )


def match_schemes(df: DataFrame, text: str, schemes: DataFrame, out: str) -> DataFrame:
    """J3, J4 for a scheme table of any size: ``guess_scheme`` as joins. Each different
    text is matched once:

    - the parts of a text that stand before a white space and are as long as some id are
      joined to the ids; the leftmost and of those the longest part wins (J3);
    - else the text is joined to the names by its rarest piece of three characters (a
      text of three or less is its own piece) and the names that contain it are kept;
      the first of them wins (J4). A text with a piece that no name has matches none.
      Of equal names only the first can win, so each different name is cut once.

    The sides of these joins grow by ``explode``, which Spark's estimates don't see: the
    hints keep the planner from sending them to the driver for a broadcast. Nulls stay null; an empty text matches nothing and stays; of equal ids the first
    scheme counts."""
    index = scheme_index(schemes)
    texts = df.select(F.col(text).alias("_text")).where("_text <> ''").distinct().withColumn("_low", F.lower("_text"))

    # One row per id, its lengths as a small array on every text
    ids = index.groupBy("id").agg(F.min_by("full", "place").alias("by_id"))
    lengths = ids.agg(F.sort_array(F.collect_set(F.length("id"))).alias("_lengths"))
    ends = F.filter(F.sequence(F.lit(2), F.length("_low")), lambda i: F.substring("_low", i, F.lit(1)).rlike(r"\s"))
    parts = (
        texts.where(F.length("_low") > 1)
        .select("_text", "_low", F.explode(ends).alias("_end"))
        .select("_text", "_low", "_end", F.explode(lengths.scalar()).alias("_n"))
        .where("_n < _end")
        .select("_text", (F.col("_end") - F.col("_n")).alias("_at"), "_n", F.substring("_low", F.col("_end") - F.col("_n"), F.col("_n")).alias("id"))
    )
    by_id = parts.join(ids.hint("merge"), "id").groupBy("_text").agg(F.min_by("by_id", F.struct("_at", -F.col("_n"))).alias("by_id"))

    # The rarest piece of a text that all of its pieces' counts tell
    names = index.where("name IS NOT NULL").groupBy("name").agg(F.min_by("full", "place").alias("full"), F.min("place").alias("place"))
    pieces = names.select("place", "name", "full", F.explode(_grams(F.col("name"))).alias("gram"))
    counts = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min_by("full", "place").alias("only"))
    own = F.filter(_grams(F.col("_low")), lambda g: F.length(g) == F.least(F.length("_low"), F.lit(GRAM)))
    rarest = (
        texts.select("_text", "_low", F.explode(own).alias("gram"))
        .join(counts.hint("merge"), "gram", "left")
        .groupBy("_text", "_low")
        .agg(
            F.count_if(F.col("n").isNull()).alias("_none"),
            F.min_by("gram", F.struct("n", "gram")).alias("gram"),
            F.first("only").alias("only"),
        )
        .where("_none = 0")
    )
    short = rarest.where(F.length("_low") <= GRAM).select("_text", F.col("only").alias("by_name"))
    long = (
        rarest.where(F.length("_low") > GRAM)
        .select("_text", "_low", "gram")
        .join(pieces.hint("merge"), "gram")
        .where(F.contains("name", "_low"))
        .groupBy("_text")
        .agg(F.min_by("full", "place").alias("by_name"))
    )
    found = by_id.join(short.union(long), "_text", "full").select("_text", F.coalesce("by_id", "by_name").alias("_full"))
    return df.join(found, F.col(text) == F.col("_text"), "left").withColumn(out, F.coalesce("_full", text)).drop("_text", "_full")


def scheme_description(full_name: Column, schemes=SCHEMES) -> Column:
    """J5 as an expression: full scheme name → description."""
    descs = {full: desc for (sid, _n, full), (_i, _a, _nm, desc) in zip(scheme_full_names(schemes), schemes)}
    return F.try_element_at(_map(descs.items()), full_name)


# ---------------------------------------------------------------------------
# Geocode (J2)
# ---------------------------------------------------------------------------


def with_geocode(df: DataFrame, geocode: DataFrame | None) -> DataFrame:
    """Region codes by (cleaned address, payment country). The geocode
    table is data and may be large: one row per key is enforced with a
    partial aggregate, then an equi left join (AQE broadcasts it when small,
    else shuffles both sides, splitting skewed keys)."""
    if geocode is None:
        null = F.lit(None).cast("string")
        return df.withColumns({"nuts1": null, "nuts2": null, "nuts3": null})
    geo = geocode.groupBy(
        F.trim("recipient_address").alias("_geo_address"), F.col("country").alias("_geo_country")
    ).agg(F.min(F.struct("nuts1", "nuts2", "nuts3")).alias("_geo"))
    joined = df.join(
        geo,
        (df["recipient_address"] == geo["_geo_address"]) & (df["country"] == geo["_geo_country"]),
        "left",
    )
    return joined.withColumns(
        {"nuts1": F.col("_geo.nuts1"), "nuts2": F.col("_geo.nuts2"), "nuts3": F.col("_geo.nuts3")}
    ).drop("_geo_address", "_geo_country", "_geo")
