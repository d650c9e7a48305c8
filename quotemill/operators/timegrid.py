"""Calendar operators: month grids without holes, missing business days, gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_start(column: Column | str) -> Column:
    return F.trunc(column, "MM")


def month_end(column: Column | str) -> Column:
    return F.last_day(column)


def fill_months(
    monthly: DataFrame, month: str, series: Sequence[str] = ()
) -> DataFrame:
    """Add the months that are missing between the first and last of a series.

    ``monthly`` holds at most one row per series and month, the month given as
    its first day. Each row also emits the empty months up to the row after it,
    so neither a second read for the range nor a join with a calendar is
    needed. The window sees months, never source rows: a series cannot be
    longer than its calendar.
    """
    order = Window.partitionBy(*series).orderBy(month)
    upto = F.coalesce(F.add_months(F.lead(month).over(order), -1), F.col(month))
    values = [c for c in monthly.columns if c != month and c not in series]
    grid = monthly.withColumn("_upto", upto).withColumn(
        "_month", F.explode(F.sequence(month, "_upto", F.expr("interval 1 month")))
    )
    return grid.select(
        *series,
        F.col("_month").alias(month),
        *[F.when(F.col("_month") == F.col(month), F.col(v)).alias(v) for v in values],
    )


def monthly_mean(
    df: DataFrame,
    value: str,
    alias: str,
    date: str = "date",
    series: Sequence[str] = (),
) -> DataFrame:
    """Mean per calendar month labelled by its last day, empty months included.

    Rows without a date fall out; rows without a value still extend the grid.
    """
    monthly = (
        df.where(F.col(date).isNotNull())
        .groupBy(*series, month_start(date).alias(date))
        .agg(F.avg(value).alias(alias))
    )
    return fill_months(monthly, date, series).withColumn(date, month_end(date))


def daily_counts(df: DataFrame, date: str, series: Sequence[str] = ()) -> DataFrame:
    """Rows per observed day. Everything below works on this small result."""
    return (
        df.where(F.col(date).isNotNull())
        .groupBy(*series, F.col(date).cast("date").alias(date))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _with_next_day(df: DataFrame, date: str, series: Sequence[str]) -> DataFrame:
    order = Window.partitionBy(*series).orderBy(date)
    return daily_counts(df, date, series).withColumn("_next", F.lead(date).over(order))


def is_business_day(column: Column | str) -> Column:
    """Monday to Friday."""
    return F.weekday(column) < 5


def missing_business_days(
    df: DataFrame, date: str = "date", series: Sequence[str] = ()
) -> DataFrame:
    """Business days between the first and last observed day that have no row.

    Between two neighbouring observed days every day is missing, so the holes
    are listed straight from the neighbours; no calendar is joined.
    """
    holes = _with_next_day(df, date, series).where(F.datediff("_next", date) > 1)
    days = F.sequence(F.date_add(date, 1), F.date_sub("_next", 1), F.expr("interval 1 day"))
    return (
        holes.select(*series, F.explode(days).alias(date)).where(is_business_day(date))
    )


def weekday_histogram(
    df: DataFrame, date: str = "date", series: Sequence[str] = ()
) -> DataFrame:
    """Rows per day name."""
    return df.groupBy(*series, F.date_format(date, "EEEE").alias("day_name")).agg(
        F.count(F.lit(1)).alias("days")
    )


def business_day_coverage(
    df: DataFrame, date: str = "date", series: Sequence[str] = ()
) -> DataFrame:
    """First and last day, expected business days, observed days, missing ones."""
    step = _with_next_day(df, date, series)
    hole = F.sequence(F.date_add(date, 1), F.date_sub("_next", 1), F.expr("interval 1 day"))
    absent = F.when(
        F.datediff("_next", date) > 1, F.size(F.filter(hole, is_business_day))
    ).otherwise(0)
    return (
        step.withColumn("_absent", absent)
        .groupBy(*series)
        .agg(
            F.min(date).alias("first_day"),
            F.max(date).alias("last_day"),
            F.sum("rows").alias("rows"),
            F.count(F.lit(1)).alias("observed_days"),
            F.count_if(is_business_day(date)).alias("_observed_business"),
            F.sum("_absent").cast("bigint").alias("missing_days"),
        )
        .withColumn("expected_days", F.col("_observed_business") + F.col("missing_days"))
        .drop("_observed_business")
    )


def gap_distribution(
    df: DataFrame, date: str = "date", series: Sequence[str] = ()
) -> DataFrame:
    """How often each distance in days between consecutive rows occurs.

    Rows of one day are zero days apart, so a day of n rows adds n - 1 zeros;
    the ordering step therefore runs on distinct days only.
    """
    steps = F.array(
        F.struct(F.datediff("_next", date).alias("gap_days"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.lit(0).alias("gap_days"), (F.col("rows") - 1).alias("n")),
    )
    return (
        _with_next_day(df, date, series)
        .select(*series, F.inline(steps))
        .where(F.col("gap_days").isNotNull() & (F.col("n") > 0))
        .groupBy(*series, "gap_days")
        .agg(F.sum("n").alias("occurrences"))
    )
