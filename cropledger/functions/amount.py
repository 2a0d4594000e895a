"""Amount parsing and decimal aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cropledger.schema import AMOUNT_TYPE, SUM_TYPE

PARSE_TYPE = "decimal(24,6)"
_CENTS = "decimal(38,0)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_is_malformed(c) -> Column:
    """A comma followed by more than two characters is an error."""
    c = _c(c)
    return c.contains(",") & (F.length(F.substring_index(c, ",", -1)) > 2)


def parse_amount(c) -> Column:
    """Text to decimal(24,6); decimal comma allowed with at most two
    decimals; anything unparsable gives null (``1.234,56`` included)."""
    c = _c(c)
    parsed = F.replace(c, F.lit(","), F.lit(".")).try_cast(PARSE_TYPE)
    return F.when(amount_is_malformed(c), F.lit(None).cast(PARSE_TYPE)).otherwise(parsed)


def to_amount(c) -> Column:
    """Round to the stored decimal(18,2), half up; null on overflow."""
    return _c(c).try_cast(AMOUNT_TYPE)


def avg_half_even(c) -> Column:
    """round(avg(x), 2) with exact half-even rounding in cents.

    The average is formed from the exact decimal sum and the count with
    integer arithmetic, so the result does not depend on the scale Spark picks
    for decimal division; ties go to the even cent. Null for no values.
    """
    c = _c(c)
    return half_even_cents(F.sum(c), F.count(c))


def half_even_cents(total: Column, n: Column) -> Column:
    """total / n rounded half-even to cents, exact; null where n is 0."""
    cents = (total * 100).cast(_CENTS)
    n = n.cast(_CENTS)
    abs_cents = F.abs(cents)
    rem = F.pmod(abs_cents, n)
    quot = ((abs_cents - rem) / n).cast(_CENTS)
    bump = (rem * 2 > n) | ((rem * 2 == n) & (F.pmod(quot, F.lit(2)) == 1))
    mag = (quot + F.when(bump, 1).otherwise(0)).cast(_CENTS)
    signed = F.when(cents < 0, -mag).otherwise(mag)
    return F.when(n == 0, F.lit(None).cast(AMOUNT_TYPE)).otherwise((signed / 100).cast(AMOUNT_TYPE))


def sum_amount(c) -> Column:
    return F.sum(_c(c)).cast(SUM_TYPE)
