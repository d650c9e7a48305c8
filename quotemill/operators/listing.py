"""Ordered and limited listings. A limit here is the feature asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def earliest(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First n rows of the order; each task keeps n, nothing is sorted whole."""
    return df.orderBy(*order_by).limit(n)


def latest(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """Last n rows of the order, latest first."""
    return df.orderBy(*[F.desc(c) for c in order_by]).limit(n)


def latest_first(
    df: DataFrame, n: int, newest: Sequence[str], then: Sequence[str] = ()
) -> DataFrame:
    """Top n: newest first, ties in ascending order of further columns."""
    return df.orderBy(*[F.desc(c) for c in newest], *[F.asc(c) for c in then]).limit(n)


def matching(df: DataFrame, **values) -> DataFrame:
    """Rows equal to every given column value."""
    for column, value in values.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def ordered(df: DataFrame, *order_by: str) -> DataFrame:
    """Total order for an output."""
    return df.orderBy(*order_by)
