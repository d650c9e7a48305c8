"""The three feeds: daily oil quotes, daily exchange rates, station prices."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.naming import normalize_columns, require_columns
from quotemill.functions.parsing import nan_to_null, strict_cast
from quotemill.operators.profiling import feed_summary
from quotemill.operators.quality import require_rows
from quotemill.schemas import DEFAULT_START_DATE, FX_SCHEMA, FX_SOURCES
from quotemill.sources.files import (
    PRICE_FILE_PATTERN,
    path_missing,
    read_csv_folder,
    read_csv_text,
    read_json_records,
)


def _day(value: str | Column | None) -> Column:
    """A date bound; None means the current date."""
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def _dated(df: DataFrame, column: str) -> Column:
    """A date or timestamp column as it is, a text strictly read as a date.

    Range filters on it reach the Parquet scan, which they would not through a
    cast of the column.
    """
    if isinstance(df.schema[column].dataType, T.StringType):
        return strict_cast(column, T.DateType(), column)
    return F.col(column)


def oil_quotes(
    raw: DataFrame, start: str | Column = DEFAULT_START_DATE, end: str | Column | None = None
) -> DataFrame:
    """Vendor frame (Date, Close, ...) as (date, brent_price) in [start, end)."""
    require_columns(raw, ["Date", "Close"])
    date = _dated(raw, "Date")
    return nan_to_null(
        raw.where((date >= _day(start)) & (date < _day(end))).select(
            date.cast("date").alias("date"),
            strict_cast("Close", T.DoubleType(), "Close").alias("brent_price"),
        )
    )


def fx_quotes(
    raw: DataFrame,
    start: str | Column = DEFAULT_START_DATE,
    end: str | Column | None = None,
    sources: Sequence[str] = FX_SOURCES,
) -> DataFrame:
    """Exchange quotes with start <= date <= end from the given sources.

    Sources match whatever their case; an empty list keeps every source.
    Ordering by date belongs to the output: see `quotemill.operators.listing`.
    """
    require_columns(raw, ["date", "source"])
    date = _dated(raw, "date")
    quotes = raw.where((date >= _day(start)) & (date < F.date_add(_day(end), 1)))
    if sources:
        quotes = quotes.where(F.lower("source").isin([s.lower() for s in sources]))
    return nan_to_null(quotes.withColumn("date", date.cast("date")))


def load_oil(
    spark: SparkSession,
    path: str,
    start: str = DEFAULT_START_DATE,
    end: str | None = None,
) -> DataFrame:
    """Oil quotes from a landed vendor CSV; ValueError if unreadable or empty."""
    try:
        raw = read_csv_text(spark, path)
    except AnalysisException as error:
        raise ValueError(f"oil feed cannot be read: {path}") from error
    return require_rows(oil_quotes(raw, start, end), f"no oil quotes from {start} to {end}")


def load_fx(
    spark: SparkSession,
    path: str,
    start: str = DEFAULT_START_DATE,
    end: str | None = None,
    sources: Sequence[str] = FX_SOURCES,
    json_lines: bool = False,
) -> DataFrame:
    """Exchange quotes from landed JSON; ValueError if unreadable, damaged or empty.

    The feed is read once to see that every record is whole.
    """
    try:
        raw = read_json_records(spark, path, FX_SCHEMA, json_lines=json_lines)
        rows = raw.agg(F.count("*"), *[F.count(c) for c in raw.columns]).first()[0]
    except (PySparkException, Py4JJavaError) as error:  # the latter from tasks
        raise ValueError(f"exchange feed cannot be read: {path}") from error
    if not rows:
        raise ValueError("the exchange feed holds no records")
    return fx_quotes(raw, start, end, sources)


def load_station_files(
    spark: SparkSession,
    path: str,
    *,
    pattern: str | None = PRICE_FILE_PATTERN,
    name_contains: str | None = None,
    skip_unreadable: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Station prices as landed, all text, and the report of their files.

    Files may have different headers; they are aligned by column name. A file that
    cannot be read is an error, or with ``skip_unreadable`` left out whole and named
    in the report. FileNotFoundError if there is none.
    """
    try:
        return read_csv_folder(
            spark, path, pattern=pattern, name_contains=name_contains, skip_unreadable=skip_unreadable
        )
    except AnalysisException as error:
        if path_missing(error):
            raise FileNotFoundError(f"no station price file below {path}") from error
        raise


def load_station_prices(spark: SparkSession, path: str, **options) -> DataFrame:
    """The rows of `load_station_files`."""
    return load_station_files(spark, path, **options)[0]


@dataclass(frozen=True)
class Feeds:
    oil: DataFrame
    stations: DataFrame
    fx: DataFrame

    def summary(self) -> DataFrame:
        """One row per feed; each feed is scanned once."""
        stations = normalize_columns(self.stations)
        present = [c for c in ("producto", "provincia") if c in stations.columns]
        return (
            feed_summary(self.oil, "oil", date="date", price="brent_price")
            .unionByName(feed_summary(stations, "stations", distinct=present))
            .unionByName(feed_summary(self.fx, "fx", date="date", price="value_sell"))
        )


def load_all(
    spark: SparkSession,
    oil_path: str,
    station_path: str,
    fx_path: str,
    *,
    start: str = DEFAULT_START_DATE,
    end: str | None = None,
    fx_start: str = DEFAULT_START_DATE,
) -> Feeds:
    """The three feeds of one run. The job's parameters are plain arguments."""
    return Feeds(
        oil=load_oil(spark, oil_path, start, end),
        stations=load_station_prices(spark, station_path),
        fx=load_fx(spark, fx_path, fx_start, end),
    )
