"""Exact ratios on decimals.

Averages are ``sum / count``: Spark's ``avg`` of a decimal keeps six fraction digits, so rounding
its result can round twice. For the same reason both sides are narrowed first: each further ``sum``
widens a decimal by ten digits, and Spark pays for them with fraction digits of the quotient.
A total beyond 18 whole digits fails the cast instead of losing digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "decimal(20,2)"


def fare_total(fare: Column | str = "fare_amount") -> Column:
    """Exact sum of a two-digit decimal, added up as whole cents.

    A sum of decimals this wide keeps a big-number buffer per group, which costs more than the rest
    of a scan; 64-bit cents cost next to nothing and hold totals up to 9.2e16.
    """
    fare = F.col(fare) if isinstance(fare, str) else fare
    cents = F.sum((fare * F.lit(100)).cast("bigint"))
    return (as_decimal(cents) * F.lit("0.01").cast("decimal(2,2)")).cast(TOTAL)


def as_decimal(count: Column) -> Column:
    """Counts as decimals, because ``/`` on integers is a double."""
    return count.cast("decimal(20,0)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to 18 digits; blank on a zero or blank denominator."""
    return F.try_divide(numerator.cast(TOTAL), denominator.cast(TOTAL))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part.cast(TOTAL) * F.lit(100), whole.cast(TOTAL)), digits)


def mean(total: Column, count: Column, digits: int | None = None) -> Column:
    value = F.try_divide(total.cast(TOTAL), as_decimal(count))
    return value if digits is None else F.round(value, digits)
