"""Parquet, CSV and JDBC writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quotemill.functions.parsing import nan_to_null


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The DataFrame with a row count that the next action over it fills in."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    cluster: bool = False,
) -> int:
    """Replace the Parquet data at a path (snappy); returns the rows written.

    NaN is written as null, so that filters on numbers can be left to the scan.

    ``cluster`` first brings the rows of a partition value together, so a run
    does not leave one small file per task and value. Adaptive execution splits
    a value that outgrows one task, so a hot month still writes in parallel.
    """
    df, seen = counted(nan_to_null(df))
    if cluster and partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str) -> int:
    """Replace the CSV data at a path, header included; returns the rows.

    Cells keep their outer blanks, and quotes inside a cell are doubled.
    """
    df, seen = counted(df)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return seen.get["rows"]


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    truncate: bool = True,
    properties: Mapping[str, str] | None = None,
    batch_rows: int = 1000,
    connections: int | None = None,
) -> int:
    """Load a database table through Spark's JDBC writer; returns the rows.

    With ``truncate`` the table is emptied but keeps its definition; otherwise
    rows are appended. ``connections`` limits how many tasks write at a time; it
    also limits those of the last computing stage.
    """
    df, seen = counted(df)
    writer = (
        df.write.mode("overwrite" if truncate else "append")
        .option("truncate", truncate)
        .option("batchsize", batch_rows)
    )
    if connections is not None:
        writer = writer.option("numPartitions", connections)
    writer.jdbc(url, table, properties=dict(properties or {}))
    return seen.get["rows"]
