"""Which SQL statements may run over the payments table.

Spark's own parser reads the statement; nothing is resolved or run. The tree it
gives is walked whole, subqueries and common table expressions included, and every
kind of node, expression and function must be one that is allowed: a query over
the one view and the CTEs in scope. So no other table, file or path, no table
function, no command, no Java call and no registered function gets through.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from cropledger.errors import InvalidQuery

PLANS = frozenset(
    """OneRowRelation Project Filter Aggregate Sort GlobalLimit LocalLimit Offset SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedRelation
    UnresolvedWith Join LateralJoin Union Distinct Except Intersect UnresolvedHaving WithWindowDefinition Pivot""".split()
)
EXPRESSIONS = frozenset(
    """UnresolvedAttribute UnresolvedStar UnresolvedAlias Alias Literal Cast Add Subtract Multiply Divide IntegralDivide Remainder
    UnaryMinus UnaryPositive And Or Not EqualTo EqualNullSafe LessThan LessThanOrEqual GreaterThan GreaterThanOrEqual IsNull
    IsNotNull IsTrue IsFalse In InSubquery ListQuery Exists ScalarSubquery Like ILike RLike LikeAll LikeAny NotLikeAll NotLikeAny
    Between UnresolvedBetween CaseWhen SortOrder UnresolvedFunction UnresolvedExtractValue UnresolvedOrdinal StringTrim StringTrimLeft
    StringTrimRight Substring CurrentDate CurrentTimestamp Concat BitwiseAnd BitwiseOr BitwiseXor WindowExpression
    UnresolvedWindowExpression WindowSpecDefinition WindowSpecReference SpecifiedWindowFrame UnspecifiedFrame CurrentRow
    UnboundedPreceding UnboundedFollowing LambdaFunction UnresolvedNamedLambdaVariable GroupingSets Cube Rollup BaseGroupingSets
    CreateNamedStruct CreateStruct""".split()
)
FUNCTIONS = frozenset(
    """abs any any_value approx_count_distinct array array_agg array_contains array_distinct array_join array_max array_min array_size
    array_sort ascii avg between bool_and bool_or cardinality ceil ceiling char_length coalesce collect_list collect_set concat concat_ws
    contains corr count count_if covar_pop covar_samp cube cume_dist current_date current_timestamp date date_add date_part date_sub date_trunc datediff day
    dayofmonth dense_rank element_at endswith every exp explode extract filter first first_value floor format_number greatest
    grouping grouping_id histogram_numeric if ifnull initcap instr isnan isnotnull isnull kurtosis lag last last_value lcase lead
    least left len length levenshtein listagg ln locate log log10 log2 lower lpad ltrim map max max_by mean median min min_by mod
    mode month named_struct now nth_value ntile nullif nullifzero nvl nvl2 percent_rank percentile percentile_approx percentile_cont
    percentile_disc position pow power quarter rank regexp_count regexp_extract regexp_extract_all regexp_like regexp_replace
    replace reverse right round row_number rpad rtrim sign size skewness slice some sort_array split split_part sqrt startswith std
    stddev stddev_pop stddev_samp string_agg struct substr substring substring_index sum to_date transform trim trunc try_add
    try_avg try_cast try_divide try_element_at try_sum ucase upper var_pop var_samp variance when width_bucket year zeroifnull""".split()
)


def _items(seq) -> Iterator:
    """The elements of a Scala sequence."""
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _refuse(what: str) -> None:
    raise InvalidQuery(f"Invalid query: {what}")


class _Walk:
    """The tree of one statement. ``scope`` holds the names of CTEs that can be seen."""

    def __init__(self, table: str):
        self.table, self.found = table.lower(), False

    def plan(self, node, scope: frozenset[str]) -> None:
        kind = _kind(node)
        if kind not in PLANS:
            _refuse(f"{kind} is not allowed")
        if kind == "UnresolvedRelation":
            parts = [str(p).lower() for p in _items(node.multipartIdentifier())]
            if len(parts) != 1 or (parts[0] not in scope and parts[0] != self.table):
                _refuse(f"no table {'.'.join(parts)}")
            # a CTE of the table's name hides it
            self.found |= parts[0] not in scope
        if kind == "UnresolvedWith":
            for relation in _items(node.cteRelations()):
                self.plan(relation._2(), scope)
                scope = scope | {str(relation._1()).lower()}
        for e in _items(node.expressions()):
            self.expression(e, scope)
        for child in _items(node.children()):
            self.plan(child, scope)

    def expression(self, node, scope: frozenset[str]) -> None:
        kind = _kind(node)
        if kind not in EXPRESSIONS:
            _refuse(f"{kind} is not allowed")
        if kind == "UnresolvedFunction":
            parts = [str(p).lower() for p in _items(node.nameParts())]
            if len(parts) != 1 or parts[0] not in FUNCTIONS:
                _refuse(f"no function {'.'.join(parts)}")
        if kind in ("ScalarSubquery", "Exists", "ListQuery"):
            self.plan(node.plan(), scope)
        for child in _items(node.children()):
            self.expression(child, scope)


def check_query(spark: SparkSession, query: str, table: str = "payments") -> str:
    """The statement, without closing semicolons and one pair of wrapping quotes, if it
    only reads ``table``; ``InvalidQuery`` otherwise."""
    text = query.strip().rstrip("; \t\r\n").lstrip()
    if len(text) >= 2 and text[0] == text[-1] and text[0] in "\"'":
        text = text[1:-1].strip().rstrip("; \t\r\n")
    if text[:6].lower() != "select" and text[:4].lower() != "with":
        _refuse("it must be a select")
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except PySparkException as e:
        raise InvalidQuery("Invalid query") from e
    walk = _Walk(table)
    walk.plan(parsed, frozenset())
    if not walk.found:
        _refuse(f"it doesn't read {table}")
    return text
