"""Shares of a period's total volume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.naming import require_columns
from quotemill.functions.parsing import percent_of, zero_sum


def _bounded_by_type(df: DataFrame, column: str) -> bool:
    """Whether the type alone limits the distinct values: at most one per day."""
    return isinstance(
        df.schema[column].dataType, (T.DateType, T.BooleanType, T.ByteType, T.ShortType)
    )


def market_share_rows(
    df: DataFrame,
    group_by: Sequence[str] = ("periodo", "bandera"),
    volume: str = "volumen",
    alias: str = "market_share_pct",
) -> DataFrame:
    """Every row with its share of the total volume of its period, in percent.

    The period is the first name of ``group_by``; the rest must exist but does
    not change the result (for shares per brand see `market_share_by_brand`). A
    row without a period keeps a null share, as does a period that sums to zero.

    Totals are one row per period. With a date as period they are broadcast:
    the calendar bounds them to a few MB whatever the data size, and the wide
    rows stay where they are. For other types no hint is given, so the session's
    broadcast threshold decides on the totals' measured size, and otherwise the
    join is shuffled with skewed periods split by adaptive execution.

    The join is null-safe, so that no null filter tells the two uses of the rows
    apart: a shuffle below them, as cleaning has one, is computed once.
    """
    require_columns(df, [*group_by, volume])
    period = group_by[0]
    totals = df.groupBy(F.col(period).alias("_period")).agg(zero_sum(volume).alias("_total"))
    if _bounded_by_type(df, period):
        totals = F.broadcast(totals)
    return (
        df.join(totals, F.col(period).eqNullSafe(F.col("_period")), "left")
        .withColumn(alias, F.when(F.col(period).isNotNull(), percent_of(volume, "_total")))
        .drop("_period", "_total")
    )


def market_share_by_brand(
    df: DataFrame,
    period: str = "periodo",
    brand: str = "bandera",
    volume: str = "volumen",
    alias: str = "market_share_pct",
) -> DataFrame:
    """Volume and share of each brand within its period, in percent.

    The window runs over brand totals, not over source rows.
    """
    require_columns(df, [period, brand, volume])
    brands = (
        df.where(F.col(period).isNotNull() & F.col(brand).isNotNull())
        .groupBy(period, brand)
        .agg(zero_sum(volume).alias("volumen_total"))
    )
    total = F.sum("volumen_total").over(Window.partitionBy(period))
    return brands.withColumn(alias, percent_of("volumen_total", total))
