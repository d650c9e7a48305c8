"""Published tables: definitions, conforming projection, refresh and upsert."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.naming import columns_of, require_columns
from quotemill.operators.combine import (
    concat_batches,
    distinct_rows,
    unseen_rows,
    upsert,
    upsert_columns,
)
from quotemill.operators.quality import table_rules, violation_counts
from quotemill.schemas import TABLES, Table
from quotemill.session import ensure_checkpoint_dir
from quotemill.sinks.files import counted

AUDIT_COLUMN = "load_timestamp"


# --- projection ----------------------------------------------------------------


def dates_only(df: DataFrame) -> DataFrame:
    """Timestamp columns as dates."""
    return df.select(
        [
            F.col(f"`{f.name}`").cast("date").alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def conform(df: DataFrame, table: Table | None, target: str = "relational") -> DataFrame:
    """The table's columns that the data has, in table order, with table types.

    Columns marked blank are published as nulls. Values that do not fit the
    type become null; `constraint_report` counts them beforehand. Data of a
    table that is not in the registry passes with all its columns.
    """
    if table is None:
        return dates_only(df)
    chosen = []
    for field in table.fields:
        if field.name not in df.columns:
            continue
        if target == "relational" and field.relational is None:
            continue
        chosen.append(_published(table, target, [field.name])[0].alias(field.name))
    return df.select(chosen)


def _published(table: Table, target: str, names: Sequence[str]) -> list[Column]:
    """Columns as their table's types; a value that does not fit is null."""
    out = []
    for field in (next(f for f in table.fields if f.name == name) for name in names):
        kind = table.type_of(field, target)
        value = F.lit(None) if field.blank else F.col(field.name)
        if isinstance(kind, (T.DecimalType, T.DoubleType)):
            value = F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))
        out.append(value.try_cast(kind))
    return out


def stamped(df: DataFrame) -> DataFrame:
    """With the time of this load."""
    return df.withColumn(AUDIT_COLUMN, F.current_timestamp())


# --- catalog -------------------------------------------------------------------


def require_database(spark: SparkSession, database: str) -> None:
    if not spark.catalog.databaseExists(database):
        raise ValueError(f"database does not exist: {database}")


def qualified(database: str, table: Table | str) -> str:
    return f"`{database}`.`{table.key if isinstance(table, Table) else table}`"


def table_columns(table: Table, target: str) -> list[tuple[str, T.DataType]]:
    return [
        (f.name, table.type_of(f, target))
        for f in table.fields
        if target == "warehouse" or f.relational is not None
    ] + [(AUDIT_COLUMN, T.TimestampType())]


def create_table(
    spark: SparkSession, database: str, table: Table, target: str = "relational"
) -> None:
    """Drop the table if present and create it empty, partitioned as registered.

    Partitions are those of the table's folder and not listed in the catalog, so
    that a refresh can change all of them by pointing the table to a new folder.
    """
    name = qualified(database, table)
    columns = ", ".join(f"`{n}` {k.simpleString()}" for n, k in table_columns(table, target))
    layout = (
        f"PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
    )
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    listed = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(listed)
    spark.conf.set(listed, "false")
    try:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {layout}")
    finally:
        spark.conf.set(listed, before)


def create_tables(spark: SparkSession, database: str, target: str = "relational") -> None:
    """All registered tables, dropped and created anew in an existing database."""
    require_database(spark, database)
    for table in TABLES.values():
        create_table(spark, database, table, target)


def record_version(spark: SparkSession, database: str, version: str = "1.0") -> None:
    """Append one row (created_at, version) to the database's version table."""
    row = spark.range(1).select(
        F.current_timestamp().alias("created_at"), F.lit(version).alias("version")
    )
    row.write.mode("append").saveAsTable(qualified(database, "db_info"))


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`")


def list_columns(spark: SparkSession, database: str, table: Table | str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {qualified(database, table)}")


# --- loading -------------------------------------------------------------------


def _laid_out(df: DataFrame, table: Table) -> DataFrame:
    """Rows gathered and sorted as the table stores them.

    Rebalancing keeps the files of a partition value few and still lets
    adaptive execution split a value that holds a third of all rows.
    """
    if table.partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in table.partition_by])
    return df.sortWithinPartitions(*table.partition_by, *table.sort_by)


def _all_columns(df: DataFrame, table: Table, target: str) -> DataFrame:
    """Every stored column in stored order, absent ones null, partitions last."""
    stored = table_columns(table, target)
    by_name = {
        n: (F.col(n) if n in df.columns else F.lit(None).cast(k)).alias(n) for n, k in stored
    }
    order = [n for n, _ in stored if n not in table.partition_by] + list(table.partition_by)
    return df.select(*[by_name[n] for n in order])


def _location(spark: SparkSession, database: str, name: str | None = None) -> str:
    """Folder of a database, or of one of its tables."""
    described = f"TABLE EXTENDED {qualified(database, name)}" if name else f"DATABASE `{database}`"
    rows = spark.sql(f"DESCRIBE {described}").collect()
    return next(row[1] for row in rows if row[0] == "Location").rstrip("/")


def _delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage_table(
    df: DataFrame,
    database: str,
    table: Table,
    *,
    target: str = "relational",
    complete: bool = True,
    validate: bool = True,
) -> tuple[int, str]:
    """Write the rows as published to a new folder beside the tables, checked on the way.

    Returns their number and the folder. The input is evaluated once: the rules are
    counted on the source's values and on the published ones, which rounding or a
    cut to the day may change, while the rows are written. Uniqueness is counted on
    what was written. ValueError names the broken rules, and then no folder is left,
    nor without rows. With ``complete`` columns that the data lacks are written as
    nulls.
    """
    spark = df.sparkSession
    rules = table_rules(df, table, target) if validate else {}
    source, published = Observation(), Observation()
    observed = df.observe(source, F.count(F.lit(1)).alias("rows"), *violation_counts(rules))
    ready = conform(observed, table, target)
    ready_rules = table_rules(ready, table, target) if validate else {}
    if ready_rules:
        ready = ready.observe(published, *violation_counts(ready_rules))
    ready = stamped(ready)
    if complete:
        ready = _all_columns(ready, table, target)
    path = f"{_location(spark, database)}/{table.key}__{uuid.uuid4().hex}"
    found: list = []
    try:
        _write(_laid_out(ready, table), path, table.partition_by)
        counts = source.get
        broken = {name: counts[f"_v{i}"] for i, name in enumerate(rules)}
        for i, name in enumerate(ready_rules):
            broken[name] = max(broken.get(name, 0), published.get[f"_v{i}"])
        if validate and counts["rows"]:
            absent = [
                f.name for f in table.fields if table.requires(f, target) and not f.blank and f.name not in df.columns
            ]
            if absent:
                raise ValueError(f"{table.key}: required columns absent {absent}")
            if table.unique and all(c in ready.columns for c in table.unique):
                written = spark.read.schema(ready.schema).parquet(path).dropna(subset=list(table.unique))
                repeated = written.groupBy(*table.unique).count().agg(F.sum(F.col("count") - 1)).first()[0]
                broken[f"unique ({', '.join(table.unique)})"] = repeated or 0
        found = [(name, n) for name, n in broken.items() if n]
        if found:
            raise ValueError(f"{table.key}: constraint violations {found}")
    except Exception:
        _delete_folder(spark, path)
        raise
    if not counts["rows"]:
        _delete_folder(spark, path)
    return counts["rows"], path


def point_to(spark: SparkSession, database: str, name: str, path: str) -> None:
    """Let the table's content be that of a folder: one change in the catalog.

    Before it the table has its old content, after it the new one, with all
    partitions at once. The folder it had is deleted last.
    """
    before = _location(spark, database, name)
    spark.sql(f"ALTER TABLE {qualified(database, name)} SET LOCATION '{path}'")
    spark.catalog.refreshTable(f"{database}.{name}")
    _delete_folder(spark, before)


def load_table(
    df: DataFrame,
    database: str,
    table: Table,
    *,
    target: str = "relational",
    truncate: bool = True,
    validate: bool = True,
) -> int:
    """Publish a DataFrame into its table; returns the rows loaded.

    ``truncate`` replaces the content. Otherwise tables with a unique key are
    upserted and the others appended. Without rows nothing is written and the
    old content stays.

    The input is evaluated once, into a folder of its own, and checked on the way. A
    refresh then points the table to that folder, whether partitioned or not: stale
    months and rows without a month need no step of their own, and a load that fails
    anywhere leaves the old content or the new one.
    """
    spark = df.sparkSession
    finish_replacement(spark, database, table.key)
    keyed = bool(table.unique) and not truncate
    if keyed:
        require_columns(df, list(table.unique))
    rows, path = stage_table(df, database, table, target=target, complete=not keyed, validate=validate)
    if not rows:
        return 0
    if truncate:
        point_to(spark, database, table.key, path)
        return rows
    if keyed:
        stored = dict(table_columns(table, target))
        held = [c for c in stored if c in (*df.columns, AUDIT_COLUMN)]
        schema = T.StructType([T.StructField(c, stored[c]) for c in held])
        _merge_batch(spark, database, table, spark.read.schema(schema).parquet(path), target)
    else:
        batch = spark.read.schema(spark.table(qualified(database, table)).schema).parquet(path)
        batch.write.insertInto(qualified(database, table))
    _delete_folder(spark, path)
    return rows


def _write(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)


def interim_name(name: str) -> str:
    return f"{name}__next"


def finish_replacement(spark: SparkSession, database: str, name: str) -> None:
    """Complete a replacement that was lost between its drop and its rename.

    Spark registers the interim table after its data is committed, so an interim
    table without the published one is the complete new content.
    """
    interim = interim_name(name)
    if not spark.catalog.tableExists(f"{database}.{name}") and spark.catalog.tableExists(
        f"{database}.{interim}"
    ):
        spark.sql(
            f"ALTER TABLE {qualified(database, interim)} RENAME TO {qualified(database, name)}"
        )


def replace_table(df: DataFrame, database: str, name: str) -> None:
    """Replace a table's content and columns; ``df`` may read the table itself.

    Overwriting in place would delete the old files first. Here the new content
    is written to a table beside the published one, which is then dropped and
    replaced by rename, so a job lost on the way leaves the old content or the
    complete new one.
    """
    spark = df.sparkSession
    interim, full = qualified(database, interim_name(name)), qualified(database, name)
    spark.sql(f"DROP TABLE IF EXISTS {interim}")
    df.write.format("parquet").saveAsTable(interim)
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.sql(f"ALTER TABLE {interim} RENAME TO {full}")


def _overwrite_partitions(df: DataFrame, database: str, table: Table) -> None:
    """Replace the partitions that occur in the data, when the job commits."""
    # Inserting into a table heeds the session's mode, not a writer option.
    conf, mode = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(mode)
    conf.set(mode, "dynamic")
    try:
        df.write.insertInto(qualified(database, table), overwrite=True)
    finally:
        conf.set(mode, before)


def _merge_batch(
    spark: SparkSession, database: str, table: Table, batch: DataFrame, target: str
) -> None:
    """Merge a staged batch into the table by the unique key.

    Where the table is partitioned by a part of its key, a row can only replace one
    of its own partition: only partitions that the batch has rows of are read, merged
    into a folder and exchanged, and the files of all others stay as they are. The
    partition values, a calendar's worth at most, are metadata. Other tables are
    pointed to a folder with all merged rows.
    """
    current = spark.table(qualified(database, table))
    stored = [n for n, _ in table_columns(table, target)]
    merge = upsert if all(c in batch.columns for c in stored) else upsert_columns
    path = f"{_location(spark, database)}/{table.key}__{uuid.uuid4().hex}"
    if not table.partition_by or not set(table.partition_by) <= set(table.unique):
        merged = merge(current, batch, table.unique).select(*current.columns)
        _write(_laid_out(merged, table), path, table.partition_by)
        point_to(spark, database, table.key, path)
        return
    touched = F.lit(False)
    for value in batch.select(*table.partition_by).distinct().collect():
        same = F.lit(True)
        for column in table.partition_by:
            same = same & F.col(column).eqNullSafe(F.lit(value[column]))
        touched = touched | same
    merged = merge(current.where(touched), batch, table.unique).select(*current.columns)
    _write(merged, path, table.partition_by)
    fixed = spark.read.schema(current.schema).parquet(path).select(*current.columns)
    _overwrite_partitions(_laid_out(fixed, table), database, table)
    _delete_folder(spark, path)


def upsert_table(
    spark: SparkSession,
    database: str,
    table: Table,
    batch: DataFrame,
    target: str = "relational",
) -> int:
    """Upsert a batch by the table's unique key, unchecked; returns its rows."""
    return load_table(batch, database, table, target=target, truncate=False, validate=False)


def refresh_partitions(
    df: DataFrame, database: str, table: Table, target: str = "relational"
) -> int:
    """Replace only the partitions for which the data has rows.

    The data may come from the table itself: it is first written to the
    session's checkpoint folder, so reading and replacing do not meet.
    """
    if not table.partition_by:
        raise ValueError(f"{table.key} has no partitions")
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    rows, seen = counted(_all_columns(stamped(conform(df, table, target)), table, target))
    fixed = rows.checkpoint(eager=True)
    _overwrite_partitions(_laid_out(fixed, table), database, table)
    return seen.get["rows"]


def publish_all(
    frames: Mapping[str, DataFrame],
    targets: Mapping[str, str],
    *,
    truncate: bool = True,
    validate: bool = True,
) -> dict[str, dict[str, int]]:
    """Publish tables to several databases; returns rows per target and table.

    ``frames`` maps table keys to data, ``targets`` database names to flavours
    ("relational" or "warehouse"). Each target evaluates the data once, so with
    several targets publish what a pipeline has written. Tables are published one by one: a failure leaves the
    earlier ones loaded.
    """
    unknown = sorted(set(frames) - set(TABLES))
    if unknown:
        raise ValueError(f"unknown tables: {unknown}")
    loaded: dict[str, dict[str, int]] = {}
    for database, target in targets.items():
        loaded[database] = {}
        for key, df in frames.items():
            require_database(df.sparkSession, database)
            loaded[database][key] = load_table(
                df, database, TABLES[key], target=target, truncate=truncate, validate=validate
            )
    return loaded


def load_unregistered(
    df: DataFrame, database: str, name: str, truncate: bool = True
) -> int:
    """Publish all columns to a table outside the registry; returns the rows."""
    require_database(df.sparkSession, database)
    if df.isEmpty():
        return 0
    rows, seen = counted(conform(df, None))
    writer = rows.write.mode("overwrite" if truncate else "append").format("parquet")
    writer.saveAsTable(qualified(database, name))
    return seen.get["rows"]


# --- accumulation ----------------------------------------------------------------

DISTINCT_PROPERTY = "quotemill.distinct"


def _marked_distinct(spark: SparkSession, name: str) -> bool:
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}")
    return not properties.where(
        (F.col("key") == DISTINCT_PROPERTY) & (F.col("value") == "true")
    ).isEmpty()


def accumulate_table(
    spark: SparkSession,
    database: str,
    name: str,
    batches: Sequence[DataFrame],
    dedup_first: bool = False,
) -> bool:
    """Add landed batches to an accumulated table; whether anything was done.

    The content is that of `quotemill.operators.combine.accumulate`. The first
    run keeps repeated rows unless ``dedup_first``; the run after it rewrites
    the table without repeats. From then on the table is marked as distinct and
    a run only appends the rows it lacks, so its cost follows the batch. Running
    a batch again adds nothing.
    """
    if not batches:
        return False
    full = qualified(database, name)
    finish_replacement(spark, database, name)
    new = concat_batches(batches)

    def mark() -> None:
        spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('{DISTINCT_PROPERTY}'='true')")

    if not spark.catalog.tableExists(f"{database}.{name}"):
        first = distinct_rows(new) if dedup_first else new
        first.write.format("parquet").saveAsTable(full)
        if dedup_first:
            mark()
        return True
    existing = spark.table(full)
    same_columns = set(existing.columns) == set(new.columns)
    if same_columns and _marked_distinct(spark, full):
        added = unseen_rows(existing, batches).select(*columns_of(existing))
        added.write.insertInto(full)
        return True
    replace_table(distinct_rows(concat_batches([existing, new])), database, name)
    mark()
    return True


def published_columns(df: DataFrame, key: str, target: str) -> Sequence[str]:
    """Names that `conform` would publish for a table key."""
    return conform(df, TABLES.get(key), target).columns
