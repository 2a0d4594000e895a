"""API-style views: typed filter parameters, filters on rows and on measures,
public years, ordering, paging, exports and result reuse (P10-P13, W3, W6-W8, S14).

A view turns a flat parameter dict (as a web request would carry it) into a
``Query`` over the payments. It returns what was asked for: without a limit the whole
result, with one exactly that page. A caller that wants a largest page passes
``max_limit``; a request beyond it is refused, never cut silently.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.dims import PUBLIC_YEARS
from cropledger.errors import InvalidQuery
from cropledger.functions import fingerprint
from cropledger.operators import summaries as S
from cropledger.plans.query import Query, truth
from cropledger.sources.versions import relist
from cropledger.sources.versions import version as table_version

STRING, NUMERIC, ID = "string", "numeric", "id"

# FIXED VALUES: the filterable row fields and measures, and their lookups.
BASE_FIELDS = {
    "country": STRING,
    "year": NUMERIC,
    "recipient_id": ID,
    "recipient_name": STRING,
    "recipient_fingerprint": STRING,
    "recipient_address": STRING,
    "scheme_id": STRING,
    "scheme": STRING,
    "scheme_code": STRING,
    "scheme_description": STRING,
    "nuts1": STRING,
    "nuts2": STRING,
    "nuts3": STRING,
    "amount": NUMERIC,
}
AGGREGATED_FIELDS = {
    "amount_sum": NUMERIC,
    "amount_avg": NUMERIC,
    "amount_min": NUMERIC,
    "amount_max": NUMERIC,
    "total_payments": NUMERIC,
    "total_recipients": NUMERIC,
}
LOOKUPS = {
    STRING: ("null", "like", "ilike"),
    NUMERIC: ("null", "gt", "gte", "lt", "lte"),
    ID: (),
}
CONTROL_PARAMS = ("order_by", "limit", "p", "output", "api_key")


def fingerprint_pattern(value: str) -> Column:
    """P10: normalise the text inside ``%`` wrappers with the same
    fingerprint as the stored column. Built on a literal, so Catalyst folds
    it to a constant pattern before the scan."""
    inner = value.strip("%")
    head = value[: len(value) - len(value.lstrip("%"))]
    tail = value[len(value.rstrip("%")) :] if inner else ""
    return F.concat(F.lit(head), fingerprint(F.lit(inner)), F.lit(tail))


def typed(name: str, kind: str, suffix: str, value: Any) -> Any:
    """The value in its field's type; one that isn't of the type is refused."""
    if suffix == "null":
        if not isinstance(value, bool) and str(value).strip().lower() not in ("0", "1", "true", "false", "yes", "no", "y", "n", "t", "f", "on", "off"):
            raise InvalidQuery(f"{name} takes true or false, not {value!r}")
        return truth(value)
    if kind == NUMERIC:
        try:
            number = Decimal(str(value).strip())
        except InvalidOperation:
            number = Decimal("NaN")
        if isinstance(value, bool) or not number.is_finite():
            raise InvalidQuery(f"{name} takes a number, not {value!r}")
        return int(number) if number == number.to_integral_value() and abs(number) < 2**63 else number
    return str(value)


def whole(name: str, value: Any, default: int | None) -> int | None:
    """A parameter of 1 or more."""
    if value is None:
        return default
    try:
        number = int(str(value))
    except ValueError:
        number = 0
    if number < 1:
        raise InvalidQuery(f"{name} takes a whole number of 1 or more, not {value!r}")
    return number


@dataclass(frozen=True)
class Kind:
    """What a view shows."""

    query: Callable[[DataFrame], Query]
    #: columns a result may be ordered by
    orders: tuple[str, ...]
    aggregated: bool = False
    restricted: bool = False
    #: a single row: no pages
    single: bool = False
    #: columns that records are attached to: name -> "country", "scheme", "nuts" or "nuts list"
    enrich: tuple[tuple[str, str], ...] = ()


_MEASURES = ("total_payments", "amount_sum", "amount_avg", "amount_max", "amount_min")
_WITH_RECIPIENTS = (*_MEASURES, "total_recipients")
_NUTS = tuple((f"nuts{i}", "nuts") for i in (1, 2, 3))
_NUTS_LISTS = tuple((f"nuts{i}_codes", "nuts list") for i in (1, 2, 3))


def _payments(source: DataFrame) -> Query:
    return Query(source, identity=("pk", "country", "year", "recipient_id"))


KINDS: dict[str, Kind] = {
    "payments": Kind(_payments, ("pk", *(f for f in BASE_FIELDS if f != "recipient_fingerprint")), restricted=True, enrich=_NUTS),
    "recipients": Kind(S.RecipientQuery, ("id", "recipient_country", *_MEASURES), aggregated=True, restricted=True, enrich=_NUTS_LISTS),
    "recipients/base": Kind(S.RecipientBaseQuery, ("id", *_MEASURES), aggregated=True, restricted=True),
    "recipients/autocomplete": Kind(S.RecipientNameQuery, ("id", "name", "recipient_country"), restricted=True),
    "schemes": Kind(S.SchemeQuery, ("id", "name", *_WITH_RECIPIENTS), aggregated=True, enrich=(("name", "scheme"),)),
    "countries": Kind(S.CountryQuery, ("country", *_WITH_RECIPIENTS), aggregated=True, enrich=(("country", "country"),)),
    "years": Kind(S.YearQuery, ("year", *_WITH_RECIPIENTS), aggregated=True),
    "locations": Kind(S.LocationQuery, ("location", *_WITH_RECIPIENTS), aggregated=True, enrich=_NUTS_LISTS),
    **{f"nuts/{i}": Kind(q, ("nuts", *_WITH_RECIPIENTS), aggregated=True, enrich=(("nuts", "nuts"),)) for i, q in ((1, S.Nuts1Query), (2, S.Nuts2Query), (3, S.Nuts3Query))},
    "agg": Kind(S.AggregationQuery, (), restricted=True, single=True),
}


@dataclass
class View:
    """One request: ``endpoint`` names a kind. The state of the files behind the payments
    (the table's version stamp) tells cached results and export files of different
    states apart; ``version`` is a caller's own name for a state, beside it."""

    endpoint: str
    payments: DataFrame
    params: dict[str, Any] = field(default_factory=dict)
    authenticated: bool = False
    public_years: tuple[int, ...] = tuple(PUBLIC_YEARS)
    max_limit: int | None = None
    version: str = ""

    def __post_init__(self) -> None:
        if self.endpoint not in KINDS:
            raise InvalidQuery(f"no such view: {self.endpoint!r}")
        self.kind = KINDS[self.endpoint]
        self.page = whole("p", self.params.get("p"), 1)
        self.limit = whole("limit", self.params.get("limit"), None)
        if self.max_limit is not None and (self.limit is None or self.limit > self.max_limit):
            raise InvalidQuery(f"limit must be given and be at most {self.max_limit}")
        if self.page > 1 and self.limit is None:
            raise InvalidQuery("a page needs a limit")
        self.where, self.having, self.shown = {}, {}, {}
        for name, value in self.params.items():
            if name not in CONTROL_PARAMS and value is not None:
                self._filter(name, value)
        self.order = self._order(self.params.get("order_by"))

    def _filter(self, name: str, value: Any) -> None:
        """Check one filter and route it to rows or measures."""
        column, _, suffix = name.partition("__")
        measure = column in AGGREGATED_FIELDS and self.kind.aggregated
        kind = AGGREGATED_FIELDS[column] if measure else BASE_FIELDS.get(column)
        if kind is None:
            raise InvalidQuery(f"no such filter here: {name!r}")
        if "__" in name and suffix not in LOOKUPS[kind]:
            raise InvalidQuery(f"{column} has no comparison {suffix!r}")
        value = typed(name, kind, suffix, value)
        self.shown[name] = str(value)
        if column == "recipient_fingerprint" and suffix != "null":
            value = fingerprint_pattern(value)
        (self.having if measure else self.where)[name] = value

    def _order(self, text: str | None) -> tuple[str, bool] | None:
        if not text:
            return None
        name = text.removeprefix("-")
        if name not in self.kind.orders:
            raise InvalidQuery(f"{self.endpoint} can't be ordered by {name!r}")
        return name, not text.startswith("-")

    # -- building ---------------------------------------------------------
    def base_query(self) -> Query:
        """The full result: no order, no slice (reused across pages, W8)."""
        query = self.kind.query(self.payments).where(**self.where)
        if self.having:
            query = query.having(**self.having)
        if self.kind.restricted and not self.authenticated:
            # Public years, beside any year filter of the request
            query = query.where(year__in=self.public_years)
        return query

    def arranged(self, query: Query) -> Query:
        """The request's order and page. A page is ordered by the row's identity at
        least, so pages never overlap."""
        name, ascending = self.order or (None, True)
        if name or self.limit is not None:
            first = (name,) if name else query.identity[:1]
            if first:
                query = query.order_by(*first, ascending=ascending).with_tiebreak(*query.identity)
        if self.limit is not None:
            query = query.rows((self.page - 1) * self.limit, self.limit)
        return query

    def query(self) -> Query:
        return self.arranged(self.base_query())

    def to_df(self) -> DataFrame:
        return self.query().to_df()

    def item_count(self) -> int:
        return self.base_query().count()

    def result(self) -> dict[str, Any]:
        """The page and its place (W7: ``has_next`` when more rows exist)."""
        count = self.item_count()
        more = self.limit is not None and not self.kind.single
        return {
            "page": self.page,
            "limit": self.limit,
            "item_count": count,
            "has_next": more and count > self.page * self.limit,
            "has_prev": more and self.page > 1,
            "results": self.to_df(),
        }

    # -- names ------------------------------------------------------------
    def spec(self, sliced: bool = False) -> str:
        """What the result depends on: the full one, or with order and page."""
        data = {
            "view": self.endpoint,
            "filters": sorted(self.shown.items()),
            "years": list(self.public_years) if self.kind.restricted and not self.authenticated else None,
            "table": [self.version, table_version(self.payments), self.payments.semanticHash()],
        }
        if sliced:
            data |= {"order": self.order, "page": self.page, "limit": self.limit}
        return json.dumps(data, sort_keys=True)

    def export_name(self) -> str:
        """The file name, from all that shapes the file."""
        return hashlib.sha1(self.spec(sliced=True).encode()).hexdigest() + ".csv"


@dataclass
class ResultCache:
    """Full results of views, kept by Spark (memory, then disk) and served page by
    page with the same order as without the cache. At most ``max_entries`` results;
    the least recently used goes first."""

    max_entries: int = 32
    #: name of the result -> the frame, the payments it is made of and their state
    store: dict[str, tuple[DataFrame, int, str]] = field(default_factory=dict)

    def page(self, view: View) -> DataFrame:
        name, source, state = view.spec(), view.payments.semanticHash(), table_version(view.payments)
        # results of an older state go first: Spark would take them for the new ones
        stale = [n for n, (_, s, v) in self.store.items() if s == source and v != state]
        for n in stale:
            self.store.pop(n)[0].unpersist(blocking=True)
        if stale:
            relist(view.payments)
        frame = self.store.pop(name, (None,))[0]
        if frame is None:
            frame = view.base_query().to_df(sliced=False).persist()
        self.store[name] = (frame, source, state)  # most recently used last
        while len(self.store) > self.max_entries:
            self.store.pop(next(iter(self.store)))[0].unpersist()
        return view.arranged(Query(frame, identity=view.base_query().identity)).to_df()

    def clear(self) -> None:
        while self.store:
            self.store.popitem()[1][0].unpersist()


def _named(endpoint: str) -> Callable[..., View]:
    def make(payments: DataFrame, params: dict[str, Any] | None = None, **options: Any) -> View:
        return View(endpoint, payments, dict(params or {}), **options)

    return make


PaymentView, RecipientView, RecipientBaseView = _named("payments"), _named("recipients"), _named("recipients/base")
RecipientNameView, SchemeView, CountryView = _named("recipients/autocomplete"), _named("schemes"), _named("countries")
YearView, LocationView, AggregationView = _named("years"), _named("locations"), _named("agg")
Nuts1View, Nuts2View, Nuts3View = _named("nuts/1"), _named("nuts/2"), _named("nuts/3")


def enriched(spark: SparkSession, kind: Kind, df: DataFrame, dims: S.Dimensions, key: str | None = None) -> DataFrame:
    """The records that belong to a result's codes; ``key`` tells its rows apart."""
    for column, what in kind.enrich:
        if what == "country":
            df = S.with_country_name(spark, df, column, dims.countries)
        elif what == "scheme":
            df = S.with_scheme_description(spark, df, column, dims.schemes)
        elif what == "nuts":
            df = S.with_nuts_record(spark, df, column, f"{column}_record", dims.nuts, dims.parents)
        else:
            df = S.with_nuts_records(spark, df, column, column.removesuffix("_codes") + "_records", dims.nuts, key, dims.parents)
    return df


def call(
    payments: DataFrame,
    endpoint: str,
    params: dict[str, Any] | None = None,
    authenticated: bool = False,
    export_dir: str | None = None,
    dims: S.Dimensions | None = None,
    **options: Any,
) -> dict[str, Any]:
    """Answer one API request: the page with its records attached and the paging
    fields. ``output=csv`` gives the page in export form; ``output=export`` writes it
    to ``export_dir`` and returns its ``path``."""
    from cropledger.sources.export import export_form, named_export

    spark = payments.sparkSession
    view = View(endpoint, payments, dict(params or {}), authenticated, **options)
    output = view.params.get("output")
    if output == "export":
        if export_dir is None:
            raise InvalidQuery("an export needs a folder")
        return {"path": named_export(spark, view, export_dir)}
    out = view.result()
    if output == "csv":
        out["results"] = export_form(out["results"])
    elif view.kind.enrich:
        identity = view.base_query().identity
        page = enriched(spark, view.kind, out["results"], dims or S.Dimensions(), identity[0] if len(identity) == 1 else None)
        # records are joined to the page, so the page's order is set again
        name, ascending = view.order or (None, True)
        first = name or (view.base_query().identity or (None,))[0]
        if first and (view.order or view.limit is not None):
            column = F.col(first)
            ties = [F.col(c).asc_nulls_last() for c in view.base_query().identity if c != first]
            page = page.orderBy(column.asc_nulls_last() if ascending else column.desc_nulls_last(), *ties)
        out["results"] = page
    return out
