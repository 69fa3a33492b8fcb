"""Goals: yearly amounts to days, seasonal and yearly shares, funnel chains.

A month's goal is the same on each of its days.  So everything is computed per
month, and the days are written out last, from the month itself: no join with
the calendar takes place at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..functions.text import ci_ne, fold
from ..functions.fixed_values import RATE_ROW_TYPE


def amount_rows(yearly_goals: DataFrame) -> DataFrame:
    """Yearly goals proper, without the row of percent rates (and without untyped rows)."""
    return yearly_goals.where(ci_ne("type", RATE_ROW_TYPE))


def month_days() -> Column:
    """Days in the month of columns ``year`` and ``month``."""
    return F.day(F.last_day(F.make_date("year", "month", F.lit(1))))


def spread_days(monthly: DataFrame, after: date, through: date) -> DataFrame:
    """Repeat each ``(year, month)`` row on all its days within ``(after, through]``."""
    first = F.make_date("year", "month", F.lit(1))
    start = F.greatest(first, F.date_add(F.lit(after), 1))
    stop = F.least(F.last_day(first), F.lit(through))
    days = F.when(start <= stop, F.sequence(start, stop))
    return monthly.select(F.explode(days).alias("date"), *monthly.columns)


def allocate_monthly(goals: DataFrame, shares: DataFrame,
                     metrics: Mapping[str, tuple[str, str]],
                     keys: Sequence[str] = ()) -> DataFrame:
    """Daily amount of each month: yearly amount x share of the month / days in it.

    ``metrics`` maps an output to its (goal column, share column).
    """
    used = list(dict.fromkeys(share for _, share in metrics.values()))
    by_month = shares.select("year", "month", *[F.col(s).alias(f"_share_{s}") for s in used])
    joined = goals.join(by_month, "year")
    return joined.select(
        F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), *keys,
        *[(F.col(goal) * F.col(f"_share_{share}") / month_days()).alias(out)
          for out, (goal, share) in metrics.items()],
    )


def allocate_daily(goals: DataFrame, shares: DataFrame, metrics: Mapping[str, tuple[str, str]],
                   after: date, through: date, keys: Sequence[str] = (),
                   total: bool = True) -> DataFrame:
    """Goals per day.  With ``total`` rows of a day (and keys, without regard to case) are added up."""
    monthly = allocate_monthly(goals, shares, metrics, keys)
    if total:
        monthly = total_months(monthly, list(metrics), keys)
    return spread_days(monthly, after, through).select("date", *keys, *metrics)


def total_months(monthly: DataFrame, measures: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return (
        monthly.groupBy("year", "month", *[fold(k).alias(f"_{k}") for k in keys])
        .agg(*[F.min(k).alias(k) for k in keys], *[F.sum(m).alias(m) for m in measures])
        .drop(*[f"_{k}" for k in keys])
    )


def even_split_daily(goals: DataFrame, metrics: Mapping[str, str], after: date, through: date,
                     keys: Sequence[str] = ()) -> DataFrame:
    """Goals per day with every month getting a twelfth of the year."""
    months = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")
    monthly = goals.select("*", months)
    monthly = monthly.select(
        "year", "month", *keys,
        *[(F.col(goal) / 12 / month_days()).alias(out) for out, goal in metrics.items()])
    return spread_days(monthly, after, through).select("date", *keys, *metrics)


def trailing_mean(monthly: DataFrame, metrics: Sequence[str], years: int = 3) -> DataFrame:
    """Same-month mean of up to ``years`` earlier years on record; the first year has none.

    The window holds one row per year and calendar month, whatever the size of the facts.
    """
    earlier = Window.partitionBy("month").orderBy("year").rowsBetween(-years, -1)
    return monthly.select("year", "month", *[F.avg(m).over(earlier).alias(m) for m in metrics])


def year_totals(df: DataFrame, metrics: Sequence[str], year: Column) -> DataFrame:
    return (df.groupBy(year.alias("_year"))
            .agg(*[F.sum(m).alias(f"_total_{m}") for m in metrics]))


def share_of_year(df: DataFrame, metrics: Mapping[str, str], year: Column) -> DataFrame:
    """Percent of the year's total: adds the output columns named by ``metrics``.

    Totals are added up inside the map tasks and joined back; a window by year
    would pull a whole year into one task.
    """
    totals = year_totals(df, list(metrics.values()), year)
    with_year = df.withColumn("_year", year)
    joined = with_year.join(totals, "_year", "left")
    return joined.select(
        *df.columns,
        *[(ratio(m, f"_total_{m}") * 100).alias(out) for out, m in metrics.items()])


def seasonal_share(monthly: DataFrame, metrics: Sequence[str], years: int = 3) -> DataFrame:
    """Percent of the year each month is expected to have, from the trailing mean."""
    means = trailing_mean(monthly, metrics, years)
    shared = share_of_year(means, {f"_{m}": m for m in metrics}, F.col("year"))
    return shared.select("year", "month", *[F.col(f"_{m}").alias(m) for m in metrics])


def with_rates(df: DataFrame, rates: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Give every row the percent rates, under the names in ``columns``.

    The rates come from a table of one row per year and goal type.  They travel
    as one array value (a scalar subquery), not through a cross join; with
    several rate rows each input row repeats once per rate row.
    """
    packed = F.collect_list(F.struct(*[F.col(c).cast("double").alias(o) for o, c in columns.items()]))
    rate_rows = rates.agg(packed.alias("rates")).scalar()
    return df.select("*", F.explode(rate_rows).alias("_rate")).select(*df.columns, "_rate.*")


def funnel_chain(df: DataFrame, start: str, steps: Sequence[tuple[str, str, str]],
                 digits: int | None = None) -> DataFrame:
    """Chain of percent rates: each step is its parent x rate / 100.

    ``steps`` lists (output, parent, rate column); a parent may feed several
    steps.  With ``digits`` the start and every step are rounded.
    """
    def cut(value: Column) -> Column:
        return value if digits is None else F.round(value, digits)

    df = df.withColumn(start, cut(F.col(start).cast("double")))
    for out, parent, rate in steps:
        df = df.withColumn(out, cut(F.col(parent) * (F.col(rate) / 100)))
    return df


def stack_actual_goal(actual: DataFrame, goal: DataFrame) -> DataFrame:
    """Actual and goal rows in one frame, told apart by ``type``."""
    return (goal.withColumn("type", F.lit("goal"))
            .unionByName(actual.withColumn("type", F.lit("actual"))))
