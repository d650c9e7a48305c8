"""The three feed pipelines and the publishing run, as plain functions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quotemill.operators.aggregates import monthly_rates, product_month
from quotemill.operators.cleaning import clean_fx, clean_oil, clean_stations
from quotemill.operators.shares import market_share_rows
from quotemill.operators.timegrid import monthly_mean
from quotemill.schemas import (
    ANALYTICS_FUEL,
    ANALYTICS_FX,
    ANALYTICS_OIL,
    DEFAULT_PRICE_FLOOR,
    DEFAULT_START_DATE,
    FX_FILES,
    OIL_FILES,
    STAGING_FUEL,
    STAGING_FX,
    STAGING_OIL,
    STATION_FILES,
)
from quotemill.sinks.files import write_parquet
from quotemill.sinks.tables import publish_all
from quotemill.sources.files import read_parquet


@dataclass(frozen=True)
class Staged:
    """Cleaned rows and their monthly aggregate."""

    cleaned: DataFrame
    monthly: DataFrame


def oil_pipeline(raw: DataFrame) -> Staged:
    cleaned = clean_oil(raw)
    return Staged(cleaned, monthly_mean(cleaned, "brent_price", "avg_brent_price"))


def fx_pipeline(raw: DataFrame) -> Staged:
    cleaned = clean_fx(raw)
    return Staged(cleaned, monthly_rates(cleaned))


def station_pipeline(
    raw: DataFrame, start: str = DEFAULT_START_DATE, floor: float = DEFAULT_PRICE_FLOOR
) -> Staged:
    """Cleaned rows carry their market share; the aggregate ignores it."""
    cleaned = clean_stations(raw, start, floor)
    return Staged(market_share_rows(cleaned), product_month(cleaned))


def save(staged: Staged, folder: str, names: tuple[str, str]) -> Staged:
    """Write both parts as Parquet and go on from the files."""
    cleaned, monthly = (f"{folder.rstrip('/')}/{n}.parquet" for n in names)
    write_parquet(staged.cleaned, cleaned)
    write_parquet(staged.monthly, monthly)
    return saved(staged.cleaned.sparkSession, folder, names)


def saved(spark: SparkSession, folder: str, names: tuple[str, str]) -> Staged:
    """Both parts as an earlier run left them in a folder."""
    paths = [f"{folder.rstrip('/')}/{n}.parquet" for n in names]
    return Staged(*[read_parquet(spark, path, staged=True) for path in paths])


def run_oil(raw: DataFrame, folder: str) -> Staged:
    return save(oil_pipeline(raw), folder, OIL_FILES)


def run_fx(raw: DataFrame, folder: str) -> Staged:
    return save(fx_pipeline(raw), folder, FX_FILES)


def run_stations(
    raw: DataFrame,
    folder: str,
    start: str = DEFAULT_START_DATE,
    floor: float = DEFAULT_PRICE_FLOOR,
    save_staging: bool = True,
) -> Staged:
    """Clean once, then share and aggregate from the written result.

    Cleaning holds the wide distinct shuffle and has three readers: the
    period totals, the share join and the monthly aggregate. They read the
    file it is written to, partitioned by month, instead of repeating it.
    """
    if not save_staging:
        return station_pipeline(raw, start, floor)
    spark = raw.sparkSession
    distinct = f"{folder.rstrip('/')}/stations_distinct.parquet"
    write_parquet(
        clean_stations(raw, start, floor), distinct, partition_by=["periodo"], cluster=True
    )
    cleaned = read_parquet(spark, distinct, staged=True)
    staged = Staged(market_share_rows(cleaned), product_month(cleaned))
    return save(staged, folder, STATION_FILES)


def publish(
    oil: Staged, stations: Staged, fx: Staged, targets: Mapping[str, str], **options
) -> dict[str, dict[str, int]]:
    """The six published tables into every target database."""
    frames = {
        STAGING_OIL.key: oil.cleaned,
        STAGING_FUEL.key: stations.cleaned,
        STAGING_FX.key: fx.cleaned,
        ANALYTICS_OIL.key: oil.monthly,
        ANALYTICS_FUEL.key: stations.monthly,
        ANALYTICS_FX.key: fx.monthly,
    }
    return publish_all(frames, targets, **options)


def staged_files(spark: SparkSession, folder: str) -> tuple[Staged, Staged, Staged]:
    """(oil, stations, fx) as an earlier run left them in a folder."""
    oil, stations, fx = (saved(spark, folder, n) for n in (OIL_FILES, STATION_FILES, FX_FILES))
    return oil, stations, fx
