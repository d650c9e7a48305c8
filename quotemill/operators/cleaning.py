"""Cleaning of the feeds, and the audit of what cleaning removes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.naming import columns_of, normalize_columns, require_columns
from quotemill.functions.parsing import (
    map_values,
    nan_to_null,
    parse_day,
    parse_month,
    parse_number,
    strict_cast,
)
from quotemill.schemas import (
    DEFAULT_PRICE_FLOOR,
    DEFAULT_START_DATE,
    PRODUCT_NAMES,
    STAGING_FUEL,
    STATION_REQUIRED,
)

# Station columns published as numbers, except those this library derives.
NUMBER_COLUMNS = [
    f.name
    for f in STAGING_FUEL.fields
    if f.warehouse == "double" and f.name != "market_share_pct"
]


# Holds the text of a number that cannot be read, until rows have been compared.
_UNREAD = "_unread_"


def clean_oil(df: DataFrame) -> DataFrame:
    """Typed oil quotes; a value that cannot be read fails the job."""
    require_columns(df, ["date", "brent_price"])
    return nan_to_null(
        df.withColumns(
            {
                "date": strict_cast("date", T.DateType(), "date"),
                "brent_price": strict_cast("brent_price", T.DoubleType(), "brent_price"),
            }
        )
    )


def clean_fx(df: DataFrame) -> DataFrame:
    """Exchange quotes with typed days; a text that is no day gives null."""
    require_columns(df, ["date"])
    kind = df.schema["date"].dataType
    day = parse_day("date") if isinstance(kind, T.StringType) else F.col("date").cast("date")
    typed = df.withColumn("date", day)
    for name in ("value_sell", "value_buy"):
        if name in df.columns and isinstance(df.schema[name].dataType, T.StringType):
            typed = typed.withColumn(name, parse_number(name))
    return nan_to_null(typed)


def typed_stations(raw: DataFrame, keep_unread: bool = False) -> DataFrame:
    """Station rows with normalized names, the month and all numbers as values.

    Texts that cannot be read become null. With ``keep_unread`` those of the
    numbers are kept in columns of their own: rows are compared by the value of
    a number that can be read (1 and 1.0 are no difference) and by the text of
    one that cannot. An unreadable month or price makes its row fall out or
    counts as null, so their texts are not compared.
    """
    df = require_columns(normalize_columns(raw), STATION_REQUIRED)

    def text(name: str) -> bool:
        return isinstance(df.schema[name].dataType, T.StringType)

    month = parse_month("periodo") if text("periodo") else F.col("periodo").cast("date")
    typed = {"periodo": month}
    for name in NUMBER_COLUMNS:
        if name in df.columns:
            typed[name] = parse_number(name) if text(name) else F.col(name).cast("double")
            if keep_unread and text(name) and name not in ("periodo", "precio_surtidor"):
                typed[_UNREAD + name] = F.when(typed[name].isNull(), F.col(name))
    return nan_to_null(df.withColumns(typed))


def _without_unread(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(_UNREAD)])


def from_month(start: str | Column) -> Column:
    """Rows of the start date or later; a null month fails."""
    return F.col("periodo") >= (F.lit(start).cast("date") if isinstance(start, str) else start)


def price_at_least(floor: float = DEFAULT_PRICE_FLOOR) -> Column:
    return F.col("precio_surtidor") >= F.lit(float(floor))


def clean_stations(
    raw: DataFrame,
    start: str | Column = DEFAULT_START_DATE,
    floor: float = DEFAULT_PRICE_FLOOR,
    products: Mapping[str, str | None] = PRODUCT_NAMES,
) -> DataFrame:
    """Readable station rows from the start date on, with published product names.

    Repeated rows are removed while the product still has its raw spelling, so
    two spellings of one product both stay. That is the only shuffle; every
    filter, the product's included, acts before it.
    """
    kept = typed_stations(raw, keep_unread=True).where(
        from_month(start) & F.col("precio_surtidor").isNotNull() & price_at_least(floor)
    )
    mapped = map_values("producto", products)
    return (
        _without_unread(kept.dropDuplicates())
        .withColumn("producto", mapped)
        .where(F.col("producto").isNotNull())
    )


# Stages in the order in which rows fall out.
AUDIT_STAGES = ("start date", "null price", "price floor", "repeated rows", "unmapped product")


def cleaning_audit(
    raw: DataFrame,
    start: str | Column = DEFAULT_START_DATE,
    floor: float = DEFAULT_PRICE_FLOOR,
    products: Mapping[str, str | None] = PRODUCT_NAMES,
) -> DataFrame:
    """What `clean_stations` removes: one row per stage.

    Columns: position, stage, rows_in, rows_out, removed, and of the rows that
    come out first_month, last_month and the number of distinct products.

    One scan and one wide shuffle. Rows that fall out before the distinct step
    lose their content and collapse to one row per stage on the map side.
    """
    df = typed_stations(raw, keep_unread=True)
    early = F.coalesce(~from_month(start), F.lit(True))
    stage = (
        F.when(early, 1)
        .when(F.col("precio_surtidor").isNull(), 2)
        .when(~price_at_least(floor), 3)
        .otherwise(4)
    )
    staged = df.withColumn("_stage", stage)
    carried = [
        c if c in ("_stage", "periodo", "producto") else F.when(F.col("_stage") == 4, F.col(c)).alias(c)
        for c in staged.columns
    ]
    distinct = staged.select(*carried).groupBy(*staged.columns).agg(
        F.count(F.lit(1)).alias("_n")
    )
    # Small from here on: one row per stage, month and raw product.
    groups = distinct.groupBy("_stage", "periodo", "producto").agg(
        F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_d")
    )
    groups = groups.withColumn("_mapped", map_values("producto", products))
    passed = [
        (F.col("_stage") > 1, "_n", "producto"),
        (F.col("_stage") > 2, "_n", "producto"),
        (F.col("_stage") > 3, "_n", "producto"),
        (F.col("_stage") > 3, "_d", "producto"),
        ((F.col("_stage") > 3) & F.col("_mapped").isNotNull(), "_d", "_mapped"),
    ]
    measures = [F.sum("_n").alias("_out0")]
    for i, (condition, count, product) in enumerate(passed, start=1):
        measures += [
            F.sum(F.when(condition, F.col(count))).alias(f"_out{i}"),
            F.min(F.when(condition, F.col("periodo"))).alias(f"_first{i}"),
            F.max(F.when(condition, F.col("periodo"))).alias(f"_last{i}"),
            F.count_distinct(F.when(condition, F.col(product))).alias(f"_products{i}"),
        ]

    def rows(i: int) -> Column:
        return F.coalesce(F.col(f"_out{i}"), F.lit(0)).cast("bigint")

    return groups.agg(*measures).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(name).alias("stage"),
                        rows(i - 1).alias("rows_in"),
                        rows(i).alias("rows_out"),
                        (rows(i - 1) - rows(i)).alias("removed"),
                        F.col(f"_first{i}").alias("first_month"),
                        F.col(f"_last{i}").alias("last_month"),
                        F.col(f"_products{i}").alias("products"),
                    )
                    for i, name in enumerate(AUDIT_STAGES, start=1)
                ]
            )
        )
    )


def accumulation_audit(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows existing, new, combined, removed as repeats, and left."""
    tagged = existing.withColumn("_new", F.lit(0)).unionByName(
        new.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    columns = columns_of(tagged, [c for c in tagged.columns if c != "_new"])
    return (
        tagged.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_new").alias("_added"))
        .agg(
            F.coalesce(F.sum(F.col("_n") - F.col("_added")), F.lit(0)).alias("rows_existing"),
            F.coalesce(F.sum("_added"), F.lit(0)).alias("rows_new"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_combined"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("removed"),
            F.count(F.lit(1)).alias("rows_left"),
        )
    )


def product_mapping(
    df: DataFrame, products: Mapping[str, str | None] = PRODUCT_NAMES
) -> DataFrame:
    """Raw product spellings with rows and published name (null: unmapped)."""
    return (
        df.groupBy("producto")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("mapped", map_values("producto", products))
    )


def product_mapping_totals(
    df: DataFrame, products: Mapping[str, str | None] = PRODUCT_NAMES
) -> DataFrame:
    """Distinct products before and after mapping, and rows left unmapped."""
    return product_mapping(df, products).agg(
        F.count_distinct("producto").alias("products_before"),
        F.count_distinct("mapped").alias("products_after"),
        F.coalesce(F.sum(F.when(F.col("mapped").isNull(), F.col("rows"))), F.lit(0))
        .cast("bigint")
        .alias("rows_unmapped"),
    )
