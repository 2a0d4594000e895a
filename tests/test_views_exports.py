"""API views (P10-P13, W3, W6-W8), exports (S13-S16) and identities."""

import glob
import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cropledger.errors import InvalidQuery
from cropledger.operators import summaries as S
from cropledger.plans import views as V
from cropledger.session import ensure_checkpoint_dir
from cropledger.sources import export as X
from cropledger.sources import store, versions


def test_param_checks(ten):
    with pytest.raises(InvalidQuery):
        V.RecipientView(ten, {"foo": 1})
    with pytest.raises(InvalidQuery):
        V.RecipientView(ten, {"recipient_id__like": "x"})  # id: equality only
    with pytest.raises(InvalidQuery):
        V.PaymentView(ten, {"amount_sum__gte": 1})  # measures only on summaries
    with pytest.raises(InvalidQuery):
        V.CountryView(ten, {"p": 0})
    with pytest.raises(InvalidQuery):
        V.CountryView(ten, {"year__gt": "abc"})  # a bad value is refused here, not in Spark


def test_where_having_split(ten):
    v = V.CountryView(ten, {"year": 2019, "amount_sum__gte": 100, "limit": 10})
    assert v.where == {"year": 2019} and v.having == {"amount_sum__gte": 100}
    assert [r["country"] for r in v.to_df().collect()] == ["DE"]


def test_restriction_and_paging(ten):
    anon = V.RecipientView(ten, {"limit": 2, "order_by": "-amount_sum"})
    res = anon.result()
    assert res["item_count"] == 5  # only 2020/2021 payments: recipients r2..r6
    ids = [r["id"] for r in res["results"].collect()]
    assert ids == ["r4", "r2"]
    auth = V.RecipientView(ten, {"limit": 2, "p": 2, "order_by": "-amount_sum"}, authenticated=True)
    res = auth.result()
    assert res["item_count"] == 7 and res["has_next"] and res["has_prev"]
    assert len(res["results"].collect()) == 2
    assert V.RecipientNameView(ten, {"limit": 1_000_000}).limit == 1_000_000  # never cut silently
    with pytest.raises(InvalidQuery):
        V.RecipientNameView(ten, {"limit": 500}, max_limit=10)


def test_fingerprint_search(ten):
    v = V.PaymentView(ten, {"recipient_fingerprint__like": "%CARLA%"}, authenticated=True)
    assert sorted(r["pk"] for r in v.to_df().collect()) == ["p05", "p06"]


def test_order_by_unknown_summary_field(ten):
    with pytest.raises(InvalidQuery):
        V.CountryView(ten, {"order_by": "recipient_name"}).to_df()


def test_result_cache(ten):
    cache = V.ResultCache()
    v1 = V.CountryView(ten, {"limit": 1, "p": 1, "order_by": "country"})
    v2 = V.CountryView(ten, {"limit": 1, "p": 2, "order_by": "-country"})
    assert cache.page(v1).collect()[0]["country"] == "DE"
    assert cache.page(v2).collect()[0]["country"] == "HU"
    assert len(cache.store) == 1
    cache.clear()


def _stored(spark, df):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/version-test-{uuid.uuid4().hex}"
    store.insert(df, path)
    return path


def test_export_and_cache_follow_the_table(spark, ten, tmp_path):
    """An upsert, and then a write of another application, give new results."""
    path = _stored(spark, ten)
    table = store.read_table(spark, path)
    cache, params = V.ResultCache(), {"order_by": "country", "country": "LU"}
    view = lambda: V.CountryView(table, params)
    first = X.named_export(spark, view(), str(tmp_path))
    assert X.named_export(spark, view(), str(tmp_path)) == first
    assert [r["total_payments"] for r in cache.page(view()).collect()] == [4]
    store.upsert(spark, ten.where("pk = 'p01'").withColumn("pk", F.lit("p99")), path)
    second = X.named_export(spark, view(), str(tmp_path))
    assert second != first
    assert [r["total_payments"] for r in X.read_csv_text(spark, second).collect()] == ["5"]
    assert [r["total_payments"] for r in cache.page(view()).collect()] == [5]
    # another application replaces the files of a partition and leaves its stamp
    path = path.removeprefix("file:")
    part = glob.glob(f"{path}/country=LU/year=2019/*.parquet")
    rows = pa.concat_tables([pq.read_table(f, partitioning=None) for f in part])
    pq.write_table(pa.concat_tables([rows, rows]), f"{path}/country=LU/year=2019/part-other.parquet")
    for f in part:
        os.remove(f)
    assert X.named_export(spark, view(), str(tmp_path)) == second  # no stamp yet
    versions.stamp(spark, path)
    third = X.named_export(spark, view(), str(tmp_path))
    assert third not in (first, second)
    assert [r["total_payments"] for r in X.read_csv_text(spark, third).collect()] == ["8"]
    assert [r["total_payments"] for r in cache.page(view()).collect()] == [8]
    assert len(cache.store) == 1
    cache.clear()


def test_versions(spark, ten):
    path = _stored(spark, ten)
    table = store.read_table(spark, path)
    seen = {versions.version(table)}
    for _ in range(2 * versions.KEPT):
        versions.stamp(spark, path)
        seen.add(versions.version(table))
    assert len(seen) == 2 * versions.KEPT + 1
    assert len(versions._names(spark, path)) <= versions.KEPT + 1
    assert versions.version(table.where("year > 2019")) == versions.version(table)
    assert store.read_table(spark, path).count() == 10  # stamps are no rows


def test_sql_guard(spark, ten):
    assert X.check_query(spark, "SELECT *\nFROM payments WHERE year = 2019;") == "SELECT *\nFROM payments WHERE year = 2019"
    got = X.run_sql(spark, ten, "\"select count(*) AS n from payments where country = 'DE'\"").first()["n"]
    assert got == 3
    assert X.run_sql(spark, ten, "select 'a;b' AS s from payments limit 1").first()["s"] == "a;b"


@pytest.mark.parametrize(
    "sql",
    [
        "select country, case when amount > 5 then 'a' else lower(scheme) end AS c, extract(year from current_date()) AS y from payments limit 3 offset 2",
        "select country, sum(amount) over w AS r from payments window w as (partition by year order by amount rows between 1 preceding and current row)",
        "select country, year, grouping(country) AS g, sum(amount) AS a from payments group by rollup(country, year) order by 1 nulls last",
        "select (select max(amount) from payments) AS m, exists(select 1 from payments p where p.pk = q.pk) AS e from payments q",
        "select distinct country from payments union all select scheme from payments except select 'x'",
        "select transform(array(1, 2), x -> x + amount) AS t, listagg(scheme, ',') within group (order by scheme) AS l from payments group by amount",
    ],
)
def test_sql_guard_accepts(spark, ten, sql):
    X.run_sql(spark, ten, sql).collect()


@pytest.mark.parametrize(
    "sql",
    [
        "DROP TABLE payments", "select 1", "delete from payments", "set x=1", "explain select * from payments", "values (1)", "select * from",
        "select value from payments join text.`/etc/hostname`", "select * from spark_catalog.default.payments",
        "select reflect('java.lang.System', 'getProperty', 'user.home') from payments", "select java_method('java.lang.System', 'exit', 1) from payments",
        "select input_file_name() from payments", "select identifier('reflect')('a') from payments", "select transform(pk) using 'cat' from payments",
        "select (select max(v) from other) from payments", "select no_such_column from payments",
    ],
)
def test_sql_guard_refuses(spark, ten, sql):
    with pytest.raises(InvalidQuery):
        X.run_sql(spark, ten, sql)


def test_sql_guard_gives_the_name_back(spark, ten):
    spark.range(3).createOrReplaceTempView("payments")
    try:
        assert X.run_sql(spark, ten, "select count(*) AS n from payments").first()["n"] == 10
        assert spark.table("payments").count() == 3
    finally:
        spark.catalog.dropTempView("payments")


def test_export_form(ten):
    df = X.export_form(S.RecipientQuery(ten).where(recipient_id="r4").to_df())
    r = df.first()
    assert r["years"] == "2019;2020" and r["name"] == "Carla;Carla GmbH" and r["amount_sum"] == "500.00"


def test_entity_graph(ten):
    g = {(r["id"], r["schema"]): r["properties"] for r in X.entity_graph(ten).collect()}
    assert g[("r4", "LegalEntity")]["name"] == ["Carla", "Carla GmbH"]
    p = g[("p05", "Payment")]
    assert p["beneficiary"] == ["r4"] and p["programme"] == [X.PROGRAMME] and p["amountEur"] == ["200.00"]
    assert "amount" not in g[("p07", "Payment")]


def test_identities(ten):
    """Sum of recipients' payment counts equals the payment count; reverse
    navigation equals the filtered select."""
    total = S.RecipientQuery(ten).to_df().agg(F.sum("total_payments")).first()[0]
    assert total == ten.count()
    nav = S.navigate(ten, "country", "DE", "scheme").to_df().collect()
    direct = S.SchemeQuery(ten.filter("country = 'DE'")).to_df().collect()
    assert sorted(map(tuple, nav)) == sorted(map(tuple, direct))


def test_named_export_reused(spark, ten, tmp_path):
    v = V.CountryView(ten, {"year": 2019}, authenticated=True)
    out = X.named_export(spark, v, str(tmp_path / "exports"))
    assert out.endswith(v.export_name())
    first = X.read_csv_text(spark, out).collect()
    assert sorted(r["country"] for r in first) == ["DE", "LU"]
    again = X.named_export(spark, V.CountryView(ten, {"year": 2019}, authenticated=True), str(tmp_path / "exports"))
    assert again == out  # same spec → same file, not rewritten


def test_bulk_summaries(ten):
    with S.summaries(ten, ["country", "year", "aggregation"]) as out:
        assert set(out) == {"country", "year", "aggregation"}
        assert out["aggregation"].first()["total_payments"] == 10


def test_nuts_records(spark, ten):
    df = S.RecipientQuery(ten).where(recipient_id="r4").to_df()
    df = S.with_nuts_records(spark, df.withColumn("codes", F.array(F.lit("DE1"), F.lit("XX9"))), "codes", "regions")
    regions = df.first()["regions"]
    assert regions[0]["name"] == "Germany 1" and regions[0]["level"] == 1 and regions[1] is None


def test_region_parents_and_key(spark, ten):
    regions = spark.createDataFrame(
        [("FR", "France"), ("FR1", "Ile-de-France"), ("FR10", "Ile-de-France"), ("FR101", "Paris"), ("DE", None), (None, "x"), ("FR", "Frankreich")],
        "nuts_id string, name string",
    )
    codes = spark.createDataFrame([(1, ["FR101", "XX", None]), (2, ["FR10", "DE", "FR"]), (3, []), (4, None), (None, ["FR1"])], "k int, codes array<string>")
    out = S.with_nuts_records(spark, codes, "codes", "r", regions, key="k", parents=True)
    got = {x["k"]: x["r"] for x in out.collect()}
    assert out.columns == ["k", "codes", "r"]
    paris = got[1][0]
    assert paris["level"] == 3 and paris["name"] == "Paris" and got[1][1:] == [None, None]
    assert [(p["nuts_id"], p["level"]) for p in paris["parents"]] == [("FR", 0), ("FR1", 1), ("FR10", 2)]
    assert [len(x["parents"]) for x in got[2]] == [2, 0, 0] and got[2][2]["name"] == "France"
    assert got[3] == [] and got[4] == [] and got[None][0]["nuts_id"] == "FR1"
    page = V.call(ten, "recipients", {"limit": 3}, dims=S.Dimensions(nuts=regions, parents=True))["results"]
    assert page.count() == 3 and "nuts1_records" in page.columns


def test_clean_csv_sink(spark, ten, tmp_path):
    from cropledger.schema import PAYMENT_COLUMNS

    path = str(tmp_path / "clean_csv")
    X.write_clean_csv(ten, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == PAYMENT_COLUMNS and back.count() == 10
    assert back.filter(F.col("pk") == "p04").first()["recipient_address"] is None  # null written empty


def test_export_sql(spark, ten, tmp_path):
    path = str(tmp_path / "q")
    X.export_sql(spark, ten, "select country, count(*) as n from payments group by country", path)
    got = {r["country"]: r["n"] for r in X.read_csv_text(spark, path).collect()}
    assert got == {"LU": "4", "DE": "3", "HU": "3"}


def test_endpoint_dispatch(ten):
    out = V.call(ten, "countries", {"order_by": "-total_payments", "limit": 2})
    assert [r["country"] for r in out["results"].collect()] == ["LU", "DE"] and out["has_next"]
    csv = V.call(ten, "recipients", {"country": "DE", "output": "csv"}, authenticated=True)
    assert csv["results"].first()["years"] == "2019;2020"
    with pytest.raises(InvalidQuery):
        V.call(ten, "nope")


def test_result_cache_bounded(ten):
    cache = V.ResultCache(max_entries=2)
    for y in (2019, 2020, 2021):
        cache.page(V.CountryView(ten, {"year": y, "limit": 5}))
    assert len(cache.store) == 2
    cache.clear()


def test_csv_files_hold_every_raw_row(spark):
    """All countries and years, the padded, quoted and placeholder names with them."""
    from cropledger.plans.registry import queries
    from cropledger.plans.testdata import raw_payments

    raw = raw_payments(spark, "/root/testdata/sf0.001")
    got = queries()["csv_files_all"](spark, "/root/testdata/sf0.001").collect()
    assert sum(r["rows"] for r in got) == raw.count()
    pairs = raw.selectExpr("upper(country) AS c", "int(year) AS y").distinct().collect()
    assert {(r["country"], r["year"]) for r in got} == {(r["c"], r["y"]) for r in pairs}


def test_request_checks_run_the_good_request(spark, monkeypatch):
    from cropledger.plans import queries_summary

    some = queries_summary._p(spark, "/root/testdata/sf0.001").where("country IN ('DE', 'FR')")
    monkeypatch.setattr(queries_summary, "_p", lambda *_: some)
    got = queries_summary.request_checks(spark, "/root/testdata/sf0.001").collect()
    assert {r["n"] for r in got} == {some.select("country").distinct().count()}
