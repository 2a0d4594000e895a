"""Builder semantics restated as result checks (model: the reference's
rendered-SQL unit tests)."""

from decimal import Decimal

import pytest

from cropledger.errors import InvalidQuery
from cropledger.operators import summaries as S
from cropledger.plans.query import Query


def rows(q):
    return [r.asDict() for r in q.to_df().collect()]


def test_select_default_and_append(ten):
    assert len(Query(ten).to_df().columns) == 20
    assert Query(ten).select().to_df().columns == Query(ten).to_df().columns
    q = Query(ten).select("recipient_id").where(country="DE").select("recipient_name")
    assert q.to_df().columns == ["recipient_id", "recipient_name"]
    assert sorted(r["recipient_name"] for r in rows(q)) == ["Carla", "Carla GmbH", "Dora"]


def test_where_merge_and_overwrite(ten):
    q = Query(ten).where(country="LU").where(year=2019)
    assert {r["pk"] for r in rows(q)} == {"p01", "p02"}
    q = Query(ten).where(country="LU").where(country="DE")  # same key overwrites
    assert {r["country"] for r in rows(q)} == {"DE"}


def test_operators(ten):
    def pks(**kw):
        return {r["pk"] for r in rows(Query(ten).where(**kw))}

    assert pks(recipient_name__like="Carla%") == {"p05", "p06"}
    assert pks(recipient_name__ilike="carla%") == {"p05", "p06"}
    assert pks(amount__gt=200) == {"p06", "p10"}
    assert pks(amount__gte=200) == {"p05", "p06", "p10"}
    assert pks(amount__lt=0.02) == {"p08"}
    assert pks(amount__lte="0.02") == {"p08", "p09"}
    assert pks(country__in=("HU",), year__in=[2014]) == {"p10"}
    assert pks(recipient_address__null=True) == {"p04"}
    assert len(pks(recipient_address__null=False)) == 9


@pytest.mark.parametrize("kw", [{"recipient_id__invalid_op": 0}, {"recipient_id__invalid__op": 0}])
def test_invalid_operator(ten, kw):
    with pytest.raises(InvalidQuery, match="comparison"):
        Query(ten).where(**kw)


def test_in_needs_list(ten):
    with pytest.raises(InvalidQuery, match="IN"):
        Query(ten).where(country__in="DE").to_df()


def test_group_by_extends_and_having(ten):
    q = Query(ten).select("country", "year", "count(*) AS n").group_by("country").group_by("year")
    assert len(rows(q)) == 7
    q = (
        Query(ten)
        .select("country", "CAST(sum(amount) AS DECIMAL(28,2)) AS amount_sum")
        .where(year=2019)
        .group_by("country")
        .having(amount_sum__gte=100)
    )
    assert rows(q) == [{"country": "DE", "amount_sum": Decimal("200.00")}]


def test_having_ignored_without_group(ten):
    assert Query(ten).having(country="XX").to_df().count() == 10


def test_order_last_column_only(ten):
    q = Query(ten).select("country", "year", "pk").order_by("country", "year", ascending=False)
    got = [(r["country"], r["year"]) for r in rows(q)]
    # country ascending, year descending
    assert got[0][0] == "DE" and got[0][1] == 2021 and got[-1][0] == "LU" and got[-1][1] == 2019
    q2 = Query(ten).order_by("pk").order_by("amount")  # later call replaces
    assert q2.order == ("amount",)
    assert rows(q2)[-1]["amount"] is None  # nulls last


def test_slicing(ten):
    base = Query(ten).select("pk").order_by("pk")
    assert [r["pk"] for r in rows(base[:3])] == ["p01", "p02", "p03"]
    assert [r["pk"] for r in rows(base[2:4])] == ["p03", "p04"]
    assert [r["pk"] for r in rows(base[8:])] == ["p09", "p10"]
    assert [r["pk"] for r in rows(base[4])] == ["p05"]
    assert rows(base[3:3]) == []
    with pytest.raises(InvalidQuery):
        base[-1]
    with pytest.raises(InvalidQuery):
        base[100:50]
    with pytest.raises(InvalidQuery):
        base[100:50:2]


def test_counts(ten):
    q = S.RecipientQuery(ten).where(country="LU").having(total_payments__gte=2)[:1]
    assert q.count() == 3  # reference count ignores HAVING and slicing
    assert q.count(exact=True) == 1
    assert S.AggregationQuery(ten).count() == 10
    assert Query(ten).group_by("recipient_address").select("recipient_address").count() == 6  # null key not counted


def test_recipient_summary(ten):
    r = {x["id"]: x for x in rows(S.RecipientQuery(ten))}
    assert r["r1"]["total_payments"] == 2 and r["r1"]["amount_avg"] == Decimal("10.02")  # 10.025 → even
    assert r["r6"]["amount_avg"] == Decimal("0.02")  # 0.015 → even is 0.02
    assert r["r4"]["name"] == ["Carla", "Carla GmbH"]
    assert r["r4"]["years"] == [2019, 2020]
    assert r["r5"]["amount_sum"] is None and r["r5"]["total_payments"] == 1


def test_summaries(ten):
    schemes = rows(S.SchemeQuery(ten))
    assert all(s["id"] is not None for s in schemes) and len(schemes) == 4
    loc = {x["location"]: x for x in rows(S.LocationQuery(ten))}
    assert None in loc and loc[None]["total_payments"] == 1  # null location kept
    n1 = rows(S.Nuts1Query(ten))
    assert {x["nuts"] for x in n1} == {"LU0", "DE1"}
    g = rows(S.AggregationQuery(ten))[0]
    assert g["total_payments"] == 10 and g["total_recipients"] == 7
    assert g["amount_sum"] == Decimal("1625.58")
    c = {x["country"]: x for x in rows(S.CountryQuery(ten))}
    assert c["HU"]["years"] == [2014, 2021] and c["HU"]["total_recipients"] == 2
    y = {x["year"]: x for x in rows(S.YearQuery(ten))}
    assert y[2021]["countries"] == ["DE", "HU"]


def test_autocomplete_distinct(ten):
    q = S.RecipientNameQuery(ten).where(country="LU")
    assert sorted((r["id"], r["name"]) for r in rows(q)) == [("r1", "Andre"), ("r2", "Andre"), ("r3", "Bert")]


def test_restricted_years_anded(ten):
    q = Query(ten).where(year=2014).where(year__in=[2020, 2021])
    assert rows(q) == []


def test_point_lookup_and_navigation(ten):
    assert S.get(ten, "recipient", "r4")["total_payments"] == 2
    assert S.get(ten, "recipient", "nobody") is None
    years = rows(S.navigate(ten, "recipient", "r4", "year"))
    assert sorted(x["year"] for x in years) == [2019, 2020]


def test_descending_keeps_nulls_last(ten):
    got = [r["amount"] for r in rows(Query(ten).select("amount").order_by("amount", ascending=False))]
    assert got[0] == Decimal("1000.00") and got[-1] is None
