"""Column builders for exact sums, means and rates.

Values are summed as decimals or integers, so partial sums merge to the same
answer whatever the partitioning; the quotient is a decimal and is rounded
half-up.  Nothing here is a UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

STAT_TYPE = "decimal(18,6)"
SUM_TYPE = "decimal(28,6)"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


def flag(predicate: Column) -> Column:
    """1 where the predicate holds; NULL and false both give 0."""
    return F.when(predicate, 1).otherwise(0)


def quotient(numerator: Column, denominator: Column) -> Column:
    return numerator.cast(SUM_TYPE) / F.nullif(denominator, F.lit(0))


def mean(c: Column | str, digits: int | None = None) -> Column:
    """Average over non-NULL values, optionally rounded."""
    value = quotient(F.sum(as_col(c)), F.count(as_col(c)))
    return value if digits is None else F.round(value, digits)


def mean_filled(c: Column | str, digits: int | None = None) -> Column:
    """Average in which a missing value counts as 0."""
    value = quotient(F.sum(zero(c)), F.count(F.lit(1)))
    return value if digits is None else F.round(value, digits)


def mean_nonzero(c: Column | str, digits: int = 1) -> Column:
    """Average that ignores both missing and zero values."""
    return mean(F.nullif(as_col(c), F.lit(0).cast(STAT_TYPE)), digits)


def percent(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    hundredfold = numerator.cast(SUM_TYPE) * 100
    return F.round(hundredfold / F.nullif(denominator, F.lit(0)), digits)


def rate(predicate: Column, digits: int = 1, among: Column | None = None) -> Column:
    """Percent of rows for which ``predicate`` holds, optionally ``among`` some rows."""
    if among is None:
        return percent(F.sum(flag(predicate)), F.count(F.lit(1)), digits)
    return percent(F.sum(flag(predicate & among)), F.sum(flag(among)), digits)


def ratio_of_sums(numerator: Column | str, denominator: Column | str, digits: int = 1) -> Column:
    return percent(F.sum(zero(numerator)), F.sum(zero(denominator)), digits)


def over_rates(
    c: Column | str, prefix: str, thresholds: Sequence[int] = (1, 2, 3, 4), among: Column | None = None
) -> dict[str, Column]:
    """``<prefix>_over_05_pct`` (at least 1) up to ``_over_35_pct`` (at least 4)."""
    return {
        f"{prefix}_over_{n - 1}5_pct": F.coalesce(rate(as_col(c) >= n, 1, among), F.lit(0)) for n in thresholds
    }
