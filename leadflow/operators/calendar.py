"""Days: the calendar, the year end, and the dashboard periods."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def year_end(as_of: date) -> date:
    return date(as_of.year, 12, 31)


def calendar(spark: SparkSession, after: date, through: date | Column) -> DataFrame:
    """One row per day of ``(after, through]``; the lower bound is exclusive.

    The rows are made by Spark.  ``through`` may be a scalar-subquery column;
    a NULL bound, or one not after ``after``, gives no rows.
    """
    first = F.date_add(F.lit(after), 1)
    if isinstance(through, Column):
        days = F.when(through >= first, F.sequence(first, through))
        return spark.range(0, 1, 1, 1).select(F.explode(days).alias("date"))
    count = max((through - after).days, 0)
    return spark.range(0, count, 1, 1).select(
        F.date_add(first, F.col("id").cast("int")).alias("date"))


def years_before(day: date, years: int) -> date:
    """The same day some years earlier; 29 February becomes the 28th."""
    try:
        return day.replace(year=day.year - years)
    except ValueError:
        return day.replace(year=day.year - years, day=28)


def in_calendar(day: Column, after: date, through: date | Column) -> Column:
    """The calendar has no gaps, so membership is a range test that reaches the scan."""
    last = through if isinstance(through, Column) else F.lit(through)
    return day.between(F.lit(after + timedelta(days=1)), last)


PERIODS = ("R12", "YTD", "today", "yesterday", "last_week_to_date", "this_week_to_date", "R4W")


def period_bounds(as_of: Column) -> dict[str, tuple[Column, Column]]:
    """First and last day of each dashboard period; weeks start on Monday."""
    monday = F.date_trunc("week", as_of).cast("date")
    return {
        "R12": (F.date_add(F.add_months(as_of, -12), 1), as_of),
        "YTD": (F.make_date(F.year(as_of), F.lit(1), F.lit(1)), as_of),
        "today": (as_of, as_of),
        "yesterday": (F.date_sub(as_of, 1), F.date_sub(as_of, 1)),
        "last_week_to_date": (F.date_sub(monday, 7), F.date_sub(as_of, 7)),
        "this_week_to_date": (monday, as_of),
        "R4W": (F.date_sub(as_of, 27), as_of),
    }


def period_filter(df: DataFrame, date_col: str, period: str, as_of: date) -> DataFrame:
    """Rows of one period.  The bounds fold to literals and reach the scan."""
    first, last = period_bounds(F.lit(as_of))[period]
    return df.where(F.col(date_col).between(first, last))


def by_period(df: DataFrame, date_col: str, as_of: date, sums: list[str]) -> DataFrame:
    """All periods side by side from one pass: a row counts in every period it falls in."""
    bounds = period_bounds(F.lit(as_of))
    hits = F.array(*[
        F.when(F.col(date_col).between(first, last), F.lit(name))
        for name, (first, last) in bounds.items()
    ])
    return (
        df.select(F.explode(hits).alias("period"), *sums)
        .where("period IS NOT NULL")
        .groupBy("period")
        .agg(*[F.sum(s).alias(s) for s in sums])
    )
