"""Registered summary, filter, ordering and paging queries (A1-A18, P1-P15,
W2-W6, J5-J9) over the ``payments`` adapter view."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.functions import avg_half_even
from cropledger.operators import summaries as S
from cropledger.operators.kept import KeptSummaries
from cropledger.plans import views as V
from cropledger.dims import COUNTRIES
from cropledger.plans.oracle import avg_sql, fingerprint_sql, measures_sql, num, q, set_sql, with_payments
from cropledger.plans.query import Query
from cropledger.plans.registry import present, register
from cropledger.plans.testdata import payments
from cropledger.schema import PAYMENT_COLUMNS
from cropledger.session import ensure_checkpoint_dir, shuffles_dropped
from cropledger.sources import store

# FIXED VALUES (ours): literals used by the registered example queries.
FILTER_COUNTRY = "PL"
FILTER_YEAR = 2014
PUBLIC_YEARS_TEST = (2015, 2016)


def _p(spark, sf_dir):
    return payments(spark, sf_dir)


def scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------------------
# summaries
# ---------------------------------------------------------------------------

def _summary_sql(key_sql: str, key_alias: str, extra: list[str], recipients: bool, where: str = "") -> str:
    cols = [f"{key_sql} AS {key_alias}" if key_alias else key_sql] + extra + [measures_sql(recipients)]
    body = f"SELECT {', '.join(cols)} FROM payments {where} GROUP BY {key_sql}"
    return with_payments(body)


SUMMARY_SQL = {
    "recipient": _summary_sql(
        "recipient_id",
        "id",
        [
            f"{set_sql('year')} AS years",
            f"{set_sql('recipient_name')} AS name",
            "min(recipient_country) AS recipient_country",
            f"{set_sql('recipient_address')} AS address",
            f"{set_sql('nuts1')} AS nuts1_codes",
            f"{set_sql('nuts2')} AS nuts2_codes",
            f"{set_sql('nuts3')} AS nuts3_codes",
        ],
        recipients=False,
    ),
    "recipient_base": _summary_sql("recipient_id", "id", [], recipients=False),
    "scheme": _summary_sql(
        "scheme_id",
        "id",
        ["min(scheme) AS name", f"{set_sql('year')} AS years", f"{set_sql('country')} AS countries"],
        recipients=True,
        where="WHERE scheme_id IS NOT NULL",
    ),
    "country": _summary_sql("country", "", [f"{set_sql('year')} AS years"], recipients=True),
    "year": _summary_sql("year", "", [f"{set_sql('country')} AS countries"], recipients=True),
    "location": _summary_sql(
        "recipient_address",
        "location",
        [
            f"{set_sql('year')} AS years",
            f"{set_sql('country')} AS countries",
            f"{set_sql('nuts1')} AS nuts1_codes",
            f"{set_sql('nuts2')} AS nuts2_codes",
            f"{set_sql('nuts3')} AS nuts3_codes",
        ],
        recipients=True,
    ),
    "nuts1": _summary_sql("nuts1", "nuts", [f"{set_sql('year')} AS years"], True, "WHERE nuts1 IS NOT NULL"),
    "nuts2": _summary_sql("nuts2", "nuts", [f"{set_sql('year')} AS years"], True, "WHERE nuts2 IS NOT NULL"),
    "nuts3": _summary_sql("nuts3", "nuts", [f"{set_sql('year')} AS years"], True, "WHERE nuts3 IS NOT NULL"),
}


def _summary_fn(entity: str):
    def fn(spark, sf_dir):
        return present(S.SUMMARIES[entity](_p(spark, sf_dir)).to_df())

    return fn


for _entity, _sql in SUMMARY_SQL.items():
    register(f"summary_{_entity}", _sql)(_summary_fn(_entity))


@register("summary_global", with_payments(f"SELECT {measures_sql(True)} FROM payments"))
def summary_global(spark, sf_dir):
    return present(S.AggregationQuery(_p(spark, sf_dir)).to_df())


# ---------------------------------------------------------------------------
# A3 autocomplete, P3-P8 filters, P14 payment rows
# ---------------------------------------------------------------------------


@register(
    "recipient_autocomplete",
    with_payments(
        f"SELECT DISTINCT recipient_id AS id, recipient_name AS name, recipient_country FROM payments "
        f"WHERE country = {q(FILTER_COUNTRY)} AND recipient_fingerprint LIKE '%customer%' "
        f"ORDER BY name, id, recipient_country LIMIT 50"
    ),
)
def recipient_autocomplete(spark, sf_dir):
    view = V.RecipientNameView(
        _p(spark, sf_dir),
        {"country": FILTER_COUNTRY, "recipient_fingerprint__like": "%CUSTOMER%", "limit": 50, "order_by": "name"},
        authenticated=True,
    )
    return present(view.to_df())


_ROW_COLS = "pk, country, year, recipient_id, recipient_name, scheme, amount"


def _rows_sql(where: str) -> str:
    return with_payments(
        f"SELECT pk, country, year, recipient_id, recipient_name, scheme, {num('amount')} AS amount "
        f"FROM payments WHERE {where}"
    )


def _rows(spark, sf_dir, **where):
    return present(
        Query(_p(spark, sf_dir)).select(*_ROW_COLS.split(", ")).where(**where).to_df()
    )


@register("filter_eq", _rows_sql(f"country = {q(FILTER_COUNTRY)} AND year = {FILTER_YEAR}"))
def filter_eq(spark, sf_dir):
    return _rows(spark, sf_dir, country=FILTER_COUNTRY, year=FILTER_YEAR)


@register("filter_cmp", _rows_sql("amount >= 50000 AND amount < 60000 AND year > 2012 AND year <= 2014"))
def filter_cmp(spark, sf_dir):
    return _rows(spark, sf_dir, amount__gte=50000, amount__lt=60000, year__gt=2012, year__lte=2014)


@register("filter_like", _rows_sql("recipient_name LIKE 'Customer#00000001%'"))
def filter_like(spark, sf_dir):
    return _rows(spark, sf_dir, recipient_name__like="Customer#00000001%")


@register("filter_ilike", _rows_sql("scheme ILIKE 'economy brand#1%'"))
def filter_ilike(spark, sf_dir):
    return _rows(spark, sf_dir, scheme__ilike="economy brand#1%")


@register("filter_in", _rows_sql("country IN ('HU', 'RO', 'LT') AND year IN (2010, 2016)"))
def filter_in(spark, sf_dir):
    return _rows(spark, sf_dir, country__in=["HU", "RO", "LT"], year__in=(2010, 2016))


@register("filter_null", _rows_sql("scheme IS NULL AND recipient_address IS NOT NULL"))
def filter_null(spark, sf_dir):
    return _rows(spark, sf_dir, scheme__null=True, recipient_address__null=False)


@register(
    "payments_select",
    with_payments(
        "SELECT pk, country, year, recipient_id, recipient_name, recipient_fingerprint, recipient_address, "
        "recipient_country, recipient_url, scheme_id, scheme, scheme_code, scheme_description, "
        f"{num('amount')} AS amount, currency, {num('amount_original')} AS amount_original, currency_original, "
        f"nuts1, nuts2, nuts3 FROM payments WHERE country = 'LU'"
    ),
)
def payments_select(spark, sf_dir):
    """Payment rows through the payment view (authenticated: no year
    restriction)."""
    view = V.PaymentView(_p(spark, sf_dir), {"country": "LU"}, authenticated=True)
    return present(view.to_df())


# ---------------------------------------------------------------------------
# Grouping, having, counts
# ---------------------------------------------------------------------------


@register(
    "where_vs_having",
    with_payments(
        f"SELECT country, {set_sql('year')} AS years, {measures_sql(True)} FROM payments "
        f"WHERE year = {FILTER_YEAR} GROUP BY country HAVING sum(amount) >= 10000000"
    ),
)
def where_vs_having(spark, sf_dir):
    """WHERE before the aggregation, HAVING after it."""
    qy = S.CountryQuery(_p(spark, sf_dir)).where(year=FILTER_YEAR).having(amount_sum__gte=10_000_000)
    return present(qy.to_df())


@register(
    "group_by_custom",
    with_payments(
        f"SELECT country, year, count(*) AS n, {num('CAST(sum(amount) AS DECIMAL(28,2))')} AS amount_sum "
        "FROM payments GROUP BY country, year"
    ),
)
def group_by_custom(spark, sf_dir):
    """User grouping; repeated ``group_by`` calls extend the keys."""
    qy = (
        Query(_p(spark, sf_dir))
        .select("country", "year", "count(*) AS n", "CAST(sum(amount) AS DECIMAL(28,2)) AS amount_sum")
        .group_by("country")
        .group_by("year")
    )
    return present(qy.to_df())


@register(
    "count_reference",
    with_payments(
        "SELECT count(DISTINCT recipient_id) AS count FROM payments WHERE country = 'PL'"
    ),
)
def count_reference(spark, sf_dir):
    """Reference count, HAVING and slicing ignored."""
    qy = S.RecipientQuery(_p(spark, sf_dir)).where(country="PL").having(total_payments__gte=40)[:5]
    return qy.count_df()


@register(
    "count_exact",
    with_payments(
        "SELECT count(*) AS count FROM (SELECT recipient_id FROM payments WHERE country = 'PL' "
        "GROUP BY recipient_id HAVING count(*) >= 40) t"
    ),
)
def count_exact(spark, sf_dir):
    """A14 exact variant: rows of the real result, HAVING applied."""
    qy = S.RecipientQuery(_p(spark, sf_dir)).where(country="PL").having(total_payments__gte=40)[:5]
    return qy.count_exact_df()


# ---------------------------------------------------------------------------
# Ordering, top-k, pages
# ---------------------------------------------------------------------------


@register(
    "order_last_only",
    with_payments(
        f"SELECT country, year, {num('amount')} AS amount, pk FROM payments WHERE country = 'LU' "
        "ORDER BY year ASC NULLS LAST, amount ASC NULLS LAST, pk DESC NULLS LAST LIMIT 25"
    ),
)
def order_last_only(spark, sf_dir):
    """One direction word applies to the last ordering column only."""
    qy = (
        Query(_p(spark, sf_dir))
        .select("country", "year", "amount", "pk")
        .where(country="LU")
        .order_by("year", "amount", "pk", ascending=False)[:25]
    )
    return present(qy.to_df())


@register(
    "topk_recipients",
    with_payments(
        f"SELECT recipient_id AS id, {measures_sql(False)} FROM payments WHERE country = 'BE' "
        "GROUP BY recipient_id ORDER BY sum(amount) DESC LIMIT 10"
    ),
)
def topk_recipients(spark, sf_dir):
    """Top 10 recipients of one country by total amount."""
    qy = S.RecipientBaseQuery(_p(spark, sf_dir)).where(country="BE").order_by("amount_sum", ascending=False)[:10]
    return present(qy.to_df())


@register(
    "page_2",
    with_payments(
        f"SELECT country, {set_sql('year')} AS years, {measures_sql(True)} FROM payments "
        "GROUP BY country ORDER BY country LIMIT 5 OFFSET 5"
    ),
)
def page_2(spark, sf_dir):
    """Second page of five countries."""
    view = V.CountryView(_p(spark, sf_dir), {"p": 2, "limit": 5, "order_by": "country"})
    return present(view.to_df())


@register(
    "page_desc_measure",
    with_payments(
        f"SELECT scheme_id AS id, min(scheme) AS name, {set_sql('year')} AS years, "
        f"{set_sql('country')} AS countries, {measures_sql(True)} FROM payments "
        "WHERE scheme_id IS NOT NULL GROUP BY scheme_id ORDER BY count(*) DESC, scheme_id LIMIT 7 OFFSET 7"
    ),
)
def page_desc_measure(spark, sf_dir):
    """W3 + W6: order by ``-total_payments``, page 2 of 7; the view adds the
    group key as the last sort key so pages never overlap."""
    view = V.SchemeView(_p(spark, sf_dir), {"p": 2, "limit": 7, "order_by": "-total_payments"})
    return present(view.to_df())


# ---------------------------------------------------------------------------
# Fingerprint search and public-year restriction
# ---------------------------------------------------------------------------


@register(
    "fingerprint_search",
    with_payments(
        f"SELECT recipient_id AS id, {measures_sql(False)} FROM payments "
        f"WHERE recipient_fingerprint LIKE '%' || {fingerprint_sql(q('CUSTOMER#00000012'))} || '%' "
        "GROUP BY recipient_id"
    ),
)
def fingerprint_search(spark, sf_dir):
    """P10: the search text is normalised like the stored fingerprint."""
    view = V.RecipientBaseView(
        _p(spark, sf_dir), {"recipient_fingerprint__like": "%CUSTOMER#00000012%"}, authenticated=True
    )
    return present(view.base_query().to_df())


@register(
    "restricted_years",
    with_payments(
        f"SELECT {measures_sql(True)} FROM payments WHERE year >= 2014 AND year IN {tuple(PUBLIC_YEARS_TEST)}"
    ),
)
def restricted_years(spark, sf_dir):
    """Anonymous callers see only public years, ANDed with their filter."""
    view = V.AggregationView(_p(spark, sf_dir), {"year__gte": 2014}, public_years=PUBLIC_YEARS_TEST)
    return present(view.to_df())


# ---------------------------------------------------------------------------
# Notebook examples
# ---------------------------------------------------------------------------


@register(
    "example_by_year",
    with_payments(
        "SELECT year, count(*) AS payments, count(DISTINCT recipient_id) AS recipients, "
        f"{num('CAST(sum(amount) AS DECIMAL(28,2))')} AS amount_total, "
        f"{num(avg_sql('amount'))} AS amount_avg "
        "FROM payments GROUP BY year"
    ),
)
def example_by_year(spark, sf_dir):
    qy = Query(_p(spark, sf_dir)).select(
        "year",
        "count(*) AS payments",
        "count(DISTINCT recipient_id) AS recipients",
        lambda: F.sum("amount").cast("decimal(28,2)").alias("amount_total"),
        lambda: avg_half_even("amount").alias("amount_avg"),
    ).group_by("year").order_by("year")
    return present(qy.to_df())


@register(
    "example_country_by_year",
    with_payments(
        "SELECT year, count(*) AS payments, count(DISTINCT recipient_id) AS recipients, "
        f"{num('CAST(sum(amount) AS DECIMAL(28,2))')} AS amount_total "
        "FROM payments WHERE country = 'DE' GROUP BY year"
    ),
)
def example_country_by_year(spark, sf_dir):
    qy = (
        Query(_p(spark, sf_dir))
        .select("year", "count(*) AS payments", "count(DISTINCT recipient_id) AS recipients",
                "CAST(sum(amount) AS DECIMAL(28,2)) AS amount_total")
        .where(country="DE")
        .group_by("year")
        .order_by("year")
    )
    return present(qy.to_df())


@register(
    "listagg_names",
    with_payments(
        "SELECT recipient_id, string_agg(recipient_name, '; ' ORDER BY recipient_name) AS names, "
        f"count(*) AS payments, {num('CAST(sum(amount) AS DECIMAL(28,2))')} AS amount_total "
        "FROM payments WHERE country = 'BE' GROUP BY recipient_id ORDER BY sum(amount) DESC LIMIT 10"
    ),
)
def listagg_names(spark, sf_dir):
    """A17 + A18: top 10 recipients of a country with their names joined
    (duplicates kept)."""
    qy = (
        Query(_p(spark, sf_dir))
        .select(
            "recipient_id",
            "listagg(recipient_name, '; ') WITHIN GROUP (ORDER BY recipient_name) AS names",
            "count(*) AS payments",
            "CAST(sum(amount) AS DECIMAL(28,2)) AS amount_total",
        )
        .where(country="BE")
        .group_by("recipient_id")
        .order_by("amount_total", ascending=False)[:10]
    )
    return present(qy.to_df())


# ---------------------------------------------------------------------------
# J5, J6, J8, J9, P15
# ---------------------------------------------------------------------------


@register(
    "reverse_nav",
    with_payments(
        f"SELECT scheme_id AS id, min(scheme) AS name, {set_sql('year')} AS years, "
        f"{set_sql('country')} AS countries, {measures_sql(True)} FROM payments "
        "WHERE scheme_id IS NOT NULL AND recipient_id IN (SELECT recipient_id FROM payments "
        "WHERE country = 'RO' AND year = 2013 AND amount > 100000) GROUP BY scheme_id"
    ),
)
def reverse_nav(spark, sf_dir):
    """Schemes of many recipients at once (left-semi join on the keys)."""
    p = _p(spark, sf_dir)
    keys = Query(p).select("recipient_id").where(country="RO", year=2013, amount__gt=100000).to_df()
    return present(S.navigate_many(p, keys, "recipient_id", "scheme").to_df())


@register(
    "point_lookup",
    with_payments(
        f"SELECT country, {set_sql('year')} AS years, {measures_sql(True)} FROM payments "
        "WHERE country = 'HR' GROUP BY country"
    ),
)
def point_lookup(spark, sf_dir):
    """One entity by key (first match)."""
    return present(S.CountryQuery(_p(spark, sf_dir)).where(country="HR")[0].to_df())


@register(
    "country_names",
    with_payments(
        f"SELECT p.country, {set_sql('year')} AS years, {measures_sql(True)}, min(cn.name) AS name "
        "FROM payments p LEFT JOIN (VALUES "
        + ", ".join(f"({q(c)}, {q(n)})" for c, n, _ in COUNTRIES)
        + ") AS cn(country, name) ON p.country = cn.country GROUP BY p.country"
    ),
)
def country_names(spark, sf_dir):
    """Country summary with display names."""
    return present(S.with_country_name(spark, S.CountryQuery(_p(spark, sf_dir)).to_df()))


_REGIONS_SQL = "(" + " UNION ".join(f"SELECT {i} AS level, nuts{i} AS nuts_id, 'Region ' || nuts{i} AS name FROM payments WHERE nuts{i} IS NOT NULL" for i in (1, 2, 3)) + ")"


def _regions(p):
    """A region table of the deployment's own codes, as an input would bring it."""
    parts = [
        p.where(F.col(f"nuts{i}").isNotNull())
        .select(F.lit(i).alias("level"), F.col(f"nuts{i}").alias("nuts_id"), F.concat(F.lit("Region "), F.col(f"nuts{i}")).alias("name"))
        .distinct()
        for i in (1, 2, 3)
    ]
    return parts[0].union(parts[1]).union(parts[2])


def _record_sql(i: int) -> str:
    return "CASE WHEN r.nuts_id IS NULL THEN NULL ELSE " "'{\"nuts_id\":\"' || r.nuts_id || '\",\"level\":' || r.level || ',\"name\":\"' || r.name || '\"}' END"


@register(
    "nuts_enrich",
    with_payments(
        " UNION ALL ".join(
            f"SELECT s.*, {_record_sql(i)} AS nuts_record FROM (SELECT nuts{i} AS nuts, {set_sql('year')} AS years, {measures_sql(True)} FROM payments "
            f"WHERE nuts{i} IS NOT NULL GROUP BY nuts{i}) s LEFT JOIN {_REGIONS_SQL} r ON r.level = {i} AND s.nuts = r.nuts_id"
            for i in (1, 2, 3)
        )
    ),
)
def nuts_enrich(spark, sf_dir):
    """J8 through the views: the region record of each code, at levels 1 to 3."""
    p = _p(spark, sf_dir)
    regions = _regions(p)
    parts = [
        V.call(p, f"nuts/{i}", dims=S.Dimensions(nuts=regions.where(F.col("level") == i)))["results"] for i in (1, 2, 3)
    ]
    return present(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@register(
    "nuts_lists",
    with_payments(
        "SELECT l.location, l.total_payments, string_agg(r.name, ';' ORDER BY r.nuts_id) AS regions FROM "
        "(SELECT recipient_address AS location, count(*) AS total_payments FROM payments GROUP BY recipient_address) l "
        f"LEFT JOIN (SELECT DISTINCT recipient_address, nuts3 FROM payments) c ON c.recipient_address = l.location "
        f"LEFT JOIN {_REGIONS_SQL} r ON r.level = 3 AND c.nuts3 = r.nuts_id GROUP BY l.location, l.total_payments"
    ),
)
def nuts_lists(spark, sf_dir):
    """J8, array form: region records of a location's list of codes."""
    p = _p(spark, sf_dir)
    out = V.call(p, "locations", dims=S.Dimensions(nuts=_regions(p).where("level = 3")))["results"]
    names = F.array_join(F.transform("nuts3_records", lambda x: x["name"]), ";")
    return present(out.select("location", "total_payments", F.nullif(names, F.lit("")).alias("regions")))


# codes of three levels below a country, as "FR", "FR1", "FR10", and payments that name the lowest
_CODE3 = "concat(country, year % 3 + 1, year % 2)"
_CODES = {0: "country", 1: "concat(country, year % 3 + 1)", 2: _CODE3}
_CODES_SQL = " UNION ".join(f"SELECT {level} AS level, {code} AS nuts_id, 'Region ' || {code} AS name FROM payments WHERE country <> 'SE'" for level, code in _CODES.items())


@register(
    "nuts_parents",
    with_payments(
        f"SELECT u.code, u.total_payments, r.level, r.name, a.parents FROM (SELECT code, count(*) AS total_payments FROM (SELECT {_CODE3} AS code FROM payments) GROUP BY code) u "
        f"LEFT JOIN ({_CODES_SQL}) r ON u.code = r.nuts_id LEFT JOIN (SELECT c.nuts_id, string_agg(p.nuts_id || '=' || p.name, ';' ORDER BY p.level) AS parents "
        f"FROM ({_CODES_SQL}) c JOIN ({_CODES_SQL}) p ON p.level < c.level AND starts_with(c.nuts_id, p.nuts_id) GROUP BY c.nuts_id) a ON u.code = a.nuts_id"
    ),
)
def nuts_parents(spark, sf_dir):
    """Codes with the records of all regions above them, from a table of codes;
    codes that the table doesn't have (of SE) get none."""
    p = _p(spark, sf_dir)
    cells = F.array(*[F.struct(F.expr(code).alias("nuts_id"), F.concat(F.lit("Region "), F.expr(code)).alias("name")) for code in _CODES.values()])
    regions = p.where("country <> 'SE'").select(F.inline(cells)).distinct()
    used = p.groupBy(F.expr(_CODE3).alias("code")).agg(F.count(F.lit(1)).alias("total_payments"))
    above = F.transform("r.parents", lambda x: F.concat(x["nuts_id"], F.lit("="), x["name"]))
    out = S.with_nuts_record(spark, used, "code", "r", regions, parents=True)
    return out.select("code", "total_payments", "r.level", "r.name", F.array_join(above, ";").alias("parents"))


# ---------------------------------------------------------------------------
# Refusals, measure filters, paging flags, reuse
# ---------------------------------------------------------------------------

_REQUESTS = {
    "unknown field": ("countries", {"planet": "DE"}),
    "unknown comparison": ("countries", {"country__near": "DE"}),
    "comparison of another type": ("countries", {"country__gt": "DE"}),
    "text for a number": ("countries", {"year__gt": "abc"}),
    "measure of rows": ("payments", {"amount_sum__gte": 1}),
    "unknown order": ("years", {"order_by": "recipient_name"}),
    "page zero": ("years", {"p": 0, "limit": 3}),
    "no limit of zero": ("years", {"limit": 0}),
    "id is equal or not": ("recipients", {"recipient_id__like": "x%"}),
    "good request": ("countries", {"year__gte": "2014", "amount_sum__gt": "0"}),
}


@register(
    "request_checks",
    "SELECT name, expected AS refused, n FROM (VALUES "
    + ", ".join(f"({q(k)}, {str(k != 'good request').lower()})" for k in _REQUESTS)
    + ") AS t(name, expected), (SELECT count(*) AS n FROM nation)",
)
def request_checks(spark, sf_dir):
    """Requests that must be refused before any plan runs, and one that
    must not, run over the payments: ``n`` is the number of countries it gives."""
    p = _p(spark, sf_dir)
    rows, good = [], None
    for name, (endpoint, params) in _REQUESTS.items():
        try:
            view = V.View(endpoint, p, params)
            view.query()
            rows.append((name, False))
            good = view.to_df()
        except V.InvalidQuery:
            rows.append((name, True))
    return spark.createDataFrame(rows, "name string, refused boolean").withColumn("n", F.lit(good.count()).cast("long"))


@register(
    "view_measure_filter",
    with_payments(
        f"SELECT year, {set_sql('country')} AS countries, {measures_sql(True)} FROM payments "
        "WHERE country IN ('DE', 'FR') OR country = 'FR' GROUP BY year HAVING count(*) >= 5 AND max(amount) > 1000"
    ).replace("country IN ('DE', 'FR') OR country = 'FR'", "country LIKE 'F%'"),
)
def view_measure_filter(spark, sf_dir):
    """One request with a row filter and measure filters, routed by the view."""
    view = V.YearView(payments(spark, sf_dir, few_recipients=True), {"country__like": "F%", "total_payments__gte": "5", "amount_max__gt": 1000})
    return present(view.to_df())


@register(
    "paging_flags",
    with_payments(
        "SELECT p AS page, n AS item_count, p * 7 < n AS has_next, p > 1 AS has_prev, least(7, greatest(0, n - (p - 1) * 7)) AS rows "
        "FROM (SELECT count(DISTINCT country) AS n FROM payments) t, (VALUES (1), (2), (4), (9)) AS v(p)"
    ),
)
def paging_flags(spark, sf_dir):
    """Page flags and page sizes, in the middle, at the end and behind it."""
    # the four requests read the same four columns: the payments are made once
    p, rows = _p(spark, sf_dir).select("country", "year", "recipient_id", "amount").persist(), []
    try:
        for page in (1, 2, 4, 9):
            r = V.CountryView(p, {"limit": 7, "p": page}).result()
            rows.append((page, r["item_count"], r["has_next"], r["has_prev"], r["results"].count()))
    finally:
        p.unpersist()
    return spark.createDataFrame(rows, "page int, item_count long, has_next boolean, has_prev boolean, rows long")


@register(
    "result_cache",
    with_payments(
        "SELECT 'cached' AS how, * FROM (SELECT recipient_id AS id, "
        + measures_sql(False)
        + " FROM payments WHERE country = 'PL' GROUP BY recipient_id ORDER BY count(*) DESC, recipient_id LIMIT 20 OFFSET 20) "
        "UNION ALL SELECT 'other table', * FROM (SELECT recipient_id AS id, "
        + measures_sql(False)
        + " FROM payments WHERE country = 'PL' AND year >= 2014 GROUP BY recipient_id ORDER BY count(*) DESC, recipient_id LIMIT 20 OFFSET 20)"
    ),
)
def result_cache(spark, sf_dir):
    """Page 2 from a kept result, in the order of the page made afresh; the same
    request over another table gets its own result."""
    p, cache = _p(spark, sf_dir), V.ResultCache()
    params = {"country": "PL", "limit": 20, "order_by": "-total_payments"}
    out = None
    for how, source in (("cached", p), ("other table", p.where("year >= 2014"))):
        cache.page(V.RecipientBaseView(source, params | {"p": 1}, authenticated=True)).count()
        page = cache.page(V.RecipientBaseView(source, params | {"p": 2}, authenticated=True)).select(F.lit(how).alias("how"), "*")
        out = page if out is None else out.unionByName(page)
    return present(out)


_ITEM = ("total_payments", "total_recipients", "amount_sum", "amount_avg", "amount_max", "amount_min")


def _long(made: dict) -> list:
    """All summaries with one set of columns: the entity, its key, the measures it has
    (null if none) and the sets' values as text."""
    out = []
    for name, df in made.items():
        df = present(df)
        key = S.ENTITIES[name].alias if name in S.ENTITIES else "id" if name == "recipient_name" else None
        rest = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns if c != key and c not in _ITEM]
        out.append(
            df.select(
                F.lit(name).alias("entity"),
                (F.col(key) if key else F.lit(None)).cast("string").alias("item"),
                *((F.col(c) if c in df.columns else F.lit(None).cast("long" if c.startswith("total") else "double")).alias(c) for c in _ITEM),
                F.concat_ws("|", *rest).alias("sets"),
            )
        )
    return out


def _long_sql() -> str:
    """The same by SQL, over the view ``payments``."""
    types = {c: "BIGINT" if c.startswith("total") else "DOUBLE" for c in _ITEM}
    measures = measures_sql(True)
    without = measures.replace("count(DISTINCT recipient_id) AS total_recipients", "CAST(NULL AS BIGINT) AS total_recipients")
    names = "SELECT 'recipient_name' AS entity, id AS item, " + ", ".join(f"CAST(NULL AS {types[c]}) AS {c}" for c in _ITEM)
    parts = [
        f"SELECT 'aggregation' AS entity, CAST(NULL AS VARCHAR) AS item, {measures}, '' AS sets FROM payments",
        f"{names}, coalesce(name, '') || '|' || coalesce(recipient_country, '') AS sets "
        "FROM (SELECT DISTINCT recipient_id AS id, recipient_name AS name, recipient_country FROM payments)",
    ]
    for name, e in S.ENTITIES.items():
        shown = [f"coalesce(min({c}), '')" if n in e.single else set_sql(c) for n, c in e.sets]
        where = f"WHERE {e.key} IS NOT NULL" if e.key_needed else ""
        parts.append(
            f"SELECT {q(name)} AS entity, CAST({e.key} AS VARCHAR) AS item, {measures if e.recipients else without}, "
            f"{' || '.join(_barred(shown)) or repr('')} AS sets FROM payments {where} GROUP BY {e.key}"
        )
    return " UNION ALL ".join(parts)


def _barred(parts: list[str]) -> list[str]:
    return [x for i, p in enumerate(parts) for x in (["'|'", p] if i else [p])]


def _stored(spark, frames: list[DataFrame]) -> DataFrame:
    """The frames' rows, each frame made by a job of its own whose shuffle files then go."""
    path = scratch(spark, "summaries")
    with shuffles_dropped(spark):
        for df in frames:
            df.write.mode("append").parquet(path)
    return spark.read.schema(frames[0].schema).parquet(path)


@register("bulk_summaries", with_payments(_long_sql()))
def bulk_summaries(spark, sf_dir):
    """B1: all eleven summaries, all measures and sets, from one kept scan."""
    with S.summaries(_p(spark, sf_dir)) as made:
        # the kept scan is given back when the block ends, so the results are stored first
        return _stored(spark, _long(made))


# of rows with one key the first by the other columns stays
_FIRST_SQL = ", ".join(f"{c} NULLS FIRST" for c in PAYMENT_COLUMNS if c not in store.UPSERT_KEY)


@register(
    "kept_summaries",
    with_payments(
        "SELECT * FROM ("
        + _long_sql().replace(
            "FROM payments",
            "FROM (SELECT * FROM payments WHERE year < 2014 UNION ALL SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {', '.join(store.UPSERT_KEY)} ORDER BY {_FIRST_SQL}) AS r FROM payments WHERE year >= 2014) WHERE r = 1) p",
        )
        + ")"
    ),
)
def kept_summaries(spark, sf_dir):
    """B1, A1-A11 from partial sums by (country, year): made for a stored table, refreshed
    by an upsert for the partitions it touches alone, then all eleven summaries read
    from them."""
    p, table = _p(spark, sf_dir), scratch(spark, "kept-table")
    kept = KeptSummaries(spark, table, scratch(spark, "kept-cells"))
    store.insert(p.where("year < 2014"), table)
    before = kept.refresh()
    store.upsert(spark, p.where("year >= 2014"), table)
    after = kept.refresh()
    if not before or before & after or kept.stale():
        raise ValueError("the cells made are not those of the partitions written")
    return _stored(spark, _long({n: kept.query(n).to_df() for n in S.SUMMARIES}))


@register(
    "endpoint_records",
    with_payments(
        f"SELECT p.country, {set_sql('year')} AS years, {measures_sql(True)}, min(cn.name) AS name "
        "FROM payments p LEFT JOIN (VALUES "
        + ", ".join(f"({q(c)}, {q(n)})" for c, n, _ in COUNTRIES)
        + ") AS cn(country, name) ON p.country = cn.country GROUP BY p.country ORDER BY sum(amount) DESC LIMIT 4"
    ),
)
def endpoint_records(spark, sf_dir):
    """J6 through an API request: a page of countries with their names."""
    return present(V.call(_p(spark, sf_dir), "countries", {"order_by": "-amount_sum", "limit": 4})["results"])
