"""Number rules: guarded ratios, exact money, NULL-strict greatest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as an exact decimal; it becomes a double at the first division.
MONEY = "decimal(18,4)"
COUNT = "bigint"


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def money(column: Column | str) -> Column:
    return _c(column).cast(MONEY)


def flag(condition: Column) -> Column:
    """1 where the condition holds, otherwise 0 (also where it is NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast(COUNT)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Plain division; a zero denominator gives NULL instead of an error."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def safe_ratio(numerator: Column | str, denominator: Column | str,
               guard: Column | str | None = None, zero: float = 0.0) -> Column:
    """``zero`` where the guard (by default the denominator) is 0, else the ratio."""
    tested = _c(denominator if guard is None else guard)
    return F.when(tested == 0, F.lit(zero)).otherwise(ratio(numerator, denominator))


def greatest_or_null(first: Column, second: Column) -> Column:
    """Larger of two values, NULL as soon as one is NULL."""
    return F.when(first.isNotNull() & second.isNotNull(), F.greatest(first, second))
