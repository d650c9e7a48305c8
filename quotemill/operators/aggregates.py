"""Grouped measures: exact medians and sums, monthly statistics, pivoted rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.naming import select_available
from quotemill.functions.parsing import percent_of, round_half_even, zero_sum
from quotemill.operators.median import grouped_median, known
from quotemill.operators.timegrid import fill_months, month_end, month_start
from quotemill.schemas import FX_SOURCES, STATION_AGG_COLUMNS

def product_month(
    df: DataFrame,
    keys: Sequence[str] = ("periodo", "producto"),
    columns: Sequence[str] = STATION_AGG_COLUMNS,
    approx: bool = False,
) -> DataFrame:
    """Median price and total volume per month and product, or per other keys."""
    return grouped_median(
        select_available(df, columns),
        keys,
        "precio_surtidor",
        "precio_surtidor_mediana",
        sums={"volumen_total": "volumen"},
        approx=approx,
    )


def weighted_mean_price(
    df: DataFrame,
    keys: Sequence[str] = ("periodo", "provincia", "producto"),
    price: str = "precio_surtidor",
    volume: str = "volumen",
    alias: str = "precio_ponderado",
) -> DataFrame:
    """Volume-weighted mean price; rows lacking price or volume have no weight."""
    weight = F.when(F.col(price).isNotNull(), F.col(volume))
    return (
        df.where(known(keys))
        .groupBy(*keys)
        .agg(
            F.try_divide(F.sum(F.col(price) * F.col(volume)), F.sum(weight)).alias(alias),
            zero_sum(volume).alias("volumen_total"),
        )
    )


def monthly_spread(
    df: DataFrame,
    value: str,
    prefix: str,
    date: str = "date",
    series: Sequence[str] = (),
    digits: int | None = 2,
) -> DataFrame:
    """Mean, min, max and median per year and month that has rows, rounded."""
    names = {stat: f"{prefix}_{stat}" for stat in ("mean", "min", "max")}
    median = f"{prefix}_median"
    stats = grouped_median(
        df.withColumn("year", F.year(date)).withColumn("month", F.month(date)),
        [*series, "year", "month"],
        value,
        median,
        spread=names,
    )
    outputs = [names["mean"], names["min"], names["max"], median]
    return stats.select(
        *series,
        "year",
        "month",
        *[
            (F.col(c) if digits is None else round_half_even(c, digits)).alias(c)
            for c in outputs
        ],
    )


def monthly_stats(
    df: DataFrame, value: str, prefix: str, date: str = "date", series: Sequence[str] = ()
) -> DataFrame:
    """Mean, min, max and sample standard deviation per calendar month."""
    return (
        df.where(F.col(date).isNotNull())
        .groupBy(*series, month_end(date).alias(date))
        .agg(
            F.avg(value).alias(f"{prefix}_mean"),
            F.min(value).alias(f"{prefix}_min"),
            F.max(value).alias(f"{prefix}_max"),
            F.stddev_samp(value).alias(f"{prefix}_stddev"),
        )
    )


def rate_column(source: str) -> str:
    return f"usd_ars_{source.lower()}"


def discover_sources(df: DataFrame, most: int = 64) -> list[str]:
    """The sources that a feed holds, lower-cased and sorted; more than ``most`` are an error.

    For `daily_rates` of whatever is there, the two that the gap needs put first.
    """
    found = df.select(F.lower("source").alias("source")).dropna().distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} sources: a pivot needs a list of them")
    return sorted(row["source"] for row in found)


def unlisted_sources(df: DataFrame, sources: Sequence[str] = FX_SOURCES, value: str = "value_sell") -> DataFrame:
    """Rows and quotes that `daily_rates` leaves out, by source; null is a source here."""
    source = F.lower("source")
    listed = F.coalesce(source.isin(*[s.lower() for s in sources]), F.lit(False))
    return (
        df.where(~listed)
        .groupBy(source.alias("source"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count(value).alias("quotes"))
    )


def daily_rates(
    df: DataFrame,
    sources: Sequence[str] = FX_SOURCES,
    date: str = "date",
    value: str = "value_sell",
) -> DataFrame:
    """Quotes by day, one column per source holding the day's mean.

    Sources match whatever their case. The source list fixes the schema, so the data is not read for it, and each
    column is a conditional mean: one hash aggregate. Days on which no source
    has a value are left out; a source without quotes gives a null column.
    """
    source = F.lower("source")
    return (
        df.where(
            F.col(date).isNotNull()
            & F.col(value).isNotNull()
            & source.isin(*[s.lower() for s in sources])
        )
        .groupBy(F.col(date).cast("date").alias(date))
        .agg(
            *[
                F.avg(F.when(source == s.lower(), F.col(value))).alias(rate_column(s))
                for s in sources
            ]
        )
    )


def monthly_rates(
    df: DataFrame,
    sources: Sequence[str] = FX_SOURCES,
    date: str = "date",
    value: str = "value_sell",
) -> DataFrame:
    """Monthly mean of daily means per source, and the gap between the first two.

    The gap is (second - first) / first x 100 of the monthly means. Months
    without quotes are kept with nulls and months are labelled by the last day.
    """
    daily = daily_rates(df, sources, date, value)
    names = [rate_column(s) for s in sources]
    monthly = daily.groupBy(month_start(date).alias(date)).agg(
        *[F.avg(n).alias(n) for n in names]
    )
    filled = fill_months(monthly, date).withColumn(date, month_end(date))
    official, other = names[0], names[1]
    return filled.withColumn(
        "brecha_cambiaria_pct", percent_of(F.col(other) - F.col(official), official)
    )


def monthly_fact(
    station_month: DataFrame, oil_month: DataFrame, rates_month: DataFrame
) -> DataFrame:
    """Station months with that month's oil price and rates, price in dollars.

    The feeds label months differently, first day here and last day there, so
    they meet on the last day. Oil and rates are meant to hold one row per month;
    no hint is given, so Spark broadcasts them only if their size allows it.
    """
    oil = oil_month.select(month_end("date").alias("_month"), "avg_brent_price")
    rates = rates_month.select(
        month_end("date").alias("_month"),
        "usd_ars_oficial",
        "usd_ars_blue",
        "brecha_cambiaria_pct",
    )
    return (
        station_month.withColumn("_month", month_end("periodo"))
        .join(oil, "_month", "left")
        .join(rates, "_month", "left")
        .drop("_month")
        .withColumn(
            "precio_usd", F.try_divide("precio_surtidor_mediana", "usd_ars_oficial")
        )
    )


def fact_correlations(fact: DataFrame, keys: Sequence[str] = ("producto",)) -> DataFrame:
    """Correlation of the median price with oil and with the exchange rate."""
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("months"),
        F.corr("precio_surtidor_mediana", "avg_brent_price").alias("corr_oil"),
        F.corr("precio_surtidor_mediana", "usd_ars_oficial").alias("corr_oficial"),
        F.corr("precio_surtidor_mediana", "usd_ars_blue").alias("corr_blue"),
    )
