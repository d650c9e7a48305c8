"""Guards and constraint checks that run before anything is published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.schemas import Table


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The same DataFrame, or ValueError when it has no row (reads at most one)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def table_rules(df: DataFrame, table: Table, target: str = "relational") -> dict[str, Column]:
    """Row rules of a table as violation predicates over the columns present.

    A null passes every rule except NOT NULL, as in SQL. Text must have the form
    of its column's type, and a number that a type cannot hold, NaN included,
    breaks a rule of its own.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    rules: dict[str, Column] = {}
    for field in table.fields:
        if field.name not in types or field.blank:
            continue
        column, source = F.col(f"`{field.name}`"), types[field.name]
        kind = table.type_of(field, target)
        if table.requires(field, target):
            rules[f"{field.name} not null"] = column.isNull()
        if field.max_length is not None:
            rules[f"{field.name} length"] = F.length(column) > field.max_length
        if isinstance(source, T.StringType) and not isinstance(kind, T.StringType):
            read = "double" if isinstance(kind, T.NumericType) else kind
            rules[f"{field.name} type"] = column.isNotNull() & column.try_cast(read).isNull()
        if not isinstance(kind, T.NumericType):
            continue
        number = column.try_cast("double")
        if target == "relational" and field.positive:
            rules[f"{field.name} positive"] = number <= 0
        if isinstance(source, (T.StringType, T.FractionalType)) and not isinstance(source, T.DecimalType):
            rules[f"{field.name} nan"] = F.isnan(number)
        if isinstance(kind, T.DecimalType):
            limit = float(10 ** (kind.precision - kind.scale))
            rules[f"{field.name} overflow"] = ~F.isnan(number) & (F.abs(F.round(number, kind.scale)) >= limit)
    return rules


def violation_counts(rules: dict[str, Column]) -> list[Column]:
    """Counts of the rows that break each rule, named by its place."""
    return [F.count_if(F.coalesce(rule, F.lit(False))).alias(f"_v{i}") for i, rule in enumerate(rules.values())]


def constraint_report(
    df: DataFrame, table: Table, target: str = "relational"
) -> DataFrame:
    """Violations per rule: (table, rule, violations), zero included.

    One scan. Row rules are summed while rows are grouped by the unique key, so
    a uniqueness rule costs its own shuffle and the row rules ride along. The
    uniqueness count is the number of rows too many; keys with a null differ.
    """
    rules = table_rules(df, table, target)
    names = list(rules)
    counts = violation_counts(rules)
    if table.unique and all(c in df.columns for c in table.unique):
        complete = F.lit(True)
        for key in table.unique:
            complete = complete & F.col(key).isNotNull()
        grouped = df.groupBy(*table.unique).agg(*counts, F.count(F.lit(1)).alias("_n"))
        names.append(f"unique ({', '.join(table.unique)})")
        totals = grouped.agg(
            *[F.sum(f"_v{i}").alias(f"_v{i}") for i in range(len(counts))],
            F.sum(F.when(complete, F.col("_n") - 1)).alias(f"_v{len(counts)}"),
        )
    else:
        totals = df.agg(*counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(table.key).alias("table"),
                F.lit(name).alias("rule"),
                F.coalesce(F.col(f"_v{i}"), F.lit(0)).cast("bigint").alias("violations"),
            )
            for i, name in enumerate(names)
        ]
    )
    return totals.select(F.inline(rows))


def tag_violations(
    df: DataFrame, table: Table, target: str = "relational", column: str = "violations"
) -> DataFrame:
    """Each row with the names of the row rules it breaks (empty when valid)."""
    flags = [
        F.when(rule, F.lit(name)) for name, rule in table_rules(df, table, target).items()
    ]
    return df.withColumn(column, F.array_compact(F.array(*flags)))


def split_valid(
    df: DataFrame, table: Table, target: str = "relational"
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their violations)."""
    tagged = tag_violations(df, table, target)
    valid = tagged.where(F.size("violations") == 0).drop("violations")
    return valid, tagged.where(F.size("violations") > 0)


def unique_batch(
    batch: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> DataFrame:
    """One row per key of an upsert batch.

    Two rows with one key are an error, as they are for a single SQL upsert
    statement. With ``on_duplicate="last"`` the row greatest in ``order_by``
    wins. Partial aggregation keeps one candidate per key and map task, so a
    key that fills a third of the batch never meets in one place.

    Rows whose key holds a null equal no other row; they all stay.
    """
    others = [c for c in batch.columns if c not in keys]
    incomplete = F.lit(False)
    for key in keys:
        incomplete = incomplete | F.col(key).isNull()
    row = F.struct(*[F.col(c) for c in others])
    if on_duplicate == "last":
        if order_by is None:
            raise ValueError("on_duplicate='last' needs order_by")
        chosen = F.max_by(row, F.col(order_by))
    elif on_duplicate == "error":
        chosen = F.when(F.count(F.lit(1)) == 1, F.any_value(row)).otherwise(
            F.raise_error(F.lit(f"duplicate key {list(keys)} in one upsert batch"))
        )
    else:
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    alone = F.when(incomplete, F.monotonically_increasing_id())
    return (
        batch.withColumn("_alone", alone)
        .groupBy(*keys, "_alone")
        .agg(chosen.alias("_row"))
        .select(*keys, "_row.*")
        .select(*batch.columns)
    )
