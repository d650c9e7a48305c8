"""Data profiling: frequencies, nulls, duplicates, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions.naming import columns_of


def value_counts(df: DataFrame, column: str, alias: str = "count") -> DataFrame:
    """Rows per value, nulls left out, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(alias))
        .orderBy(F.desc(alias), column)
    )


def _as_rows(totals: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return totals.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one row per column, in a single pass."""
    totals = df.agg(
        *[F.count_if(c.isNull()).alias(f"_{i}") for i, c in enumerate(columns_of(df))]
    )
    return _as_rows(
        totals,
        [
            F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("nulls"))
            for i, c in enumerate(df.columns)
        ],
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Position, name, type, non-null count and row count of every column."""
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"_{i}") for i, c in enumerate(columns_of(df))],
    )
    return _as_rows(
        totals,
        [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column"),
                F.lit(kind).alias("type"),
                F.col(f"_{i}").alias("non_null"),
                F.col("_rows").alias("rows"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ],
    )


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier one in the columns (all by default).

    Nulls equal nulls. Copies are combined on the map side before the shuffle.
    """
    return (
        df.groupBy(*columns_of(df, columns))
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Values without nulls, in order."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def series_mean(df: DataFrame, column: str, alias: str = "mean") -> DataFrame:
    """Mean of the whole column."""
    return df.agg(F.avg(column).alias(alias))


def feed_summary(
    df: DataFrame,
    feed: str,
    *,
    date: str | None = None,
    price: str | None = None,
    distinct: Sequence[str] = (),
) -> DataFrame:
    """One row: rows, first and last day, mean price, distinct products, provinces.

    Rows are first reduced to the combinations of the counted columns. The
    distinct counts then expand that small result, not the feed.
    """
    counted = [c for c in ("producto", "provincia") if c in distinct]
    parts = [F.count(F.lit(1)).alias("_rows")]
    if date:
        parts += [
            F.min(F.col(date).cast("date")).alias("_first"),
            F.max(F.col(date).cast("date")).alias("_last"),
        ]
    if price:
        parts += [F.sum(price).alias("_sum"), F.count(price).alias("_priced")]
    combos = df.groupBy(*counted).agg(*parts) if counted else df.agg(*parts)
    none = F.lit(None)
    return combos.agg(
        F.lit(feed).alias("feed"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows"),
        (F.min("_first") if date else none.cast("date")).alias("first_day"),
        (F.max("_last") if date else none.cast("date")).alias("last_day"),
        (
            F.try_divide(F.sum("_sum"), F.sum("_priced")) if price else none.cast("double")
        ).alias("mean_price"),
        *[
            (F.count_distinct(c) if c in counted else none.cast("bigint")).alias(name)
            for c, name in (("producto", "products"), ("provincia", "provinces"))
        ],
    )


def grand_total(summaries: DataFrame) -> DataFrame:
    """Rows of all feeds together."""
    return summaries.agg(F.sum("rows").alias("total_rows"))


def rows_per_batch(df: DataFrame, batch: Column | str, alias: str = "batch") -> DataFrame:
    """Rows per ingested batch, for example per file name, in one scan."""
    label = F.col(batch) if isinstance(batch, str) else batch
    return df.groupBy(label.alias(alias)).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns")
    )


def file_counts(df: DataFrame) -> DataFrame:
    """Row and column counts per scanned file; ``df`` is a direct file scan."""
    return rows_per_batch(df, F.col("_metadata.file_name"), "file_name")


def with_grand_total(counts: DataFrame, label: str = "batch") -> DataFrame:
    """Batch counts followed by one row with their total."""
    total = counts.agg(
        F.lit("TOTAL").alias(label),
        F.sum("rows").alias("rows"),
        F.max("columns").alias("columns"),
    )
    return counts.unionByName(total)
