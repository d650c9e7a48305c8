"""Exact grouped median by descent through the bits of the values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bits of a value's code that one level of the descent decides: 65,536 classes.
LEVEL_BITS = 16
# Fixed values of IEEE 754 doubles: mantissa bits, exponent bias, least and infinite value.
_MANTISSA = 52
_BIAS = 1023
_LEAST = 5e-324
_INFINITE = 0x7FF0000000000000
# Code of null, below that of every double, and in a class of its own on every level.
NULL_CODE = -(2**63)


def known(keys: Sequence[str]) -> Column:
    """Whether no key is null."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def with_code(df: DataFrame, value: str, alias: str) -> DataFrame:
    """Add the order-preserving 64-bit code of a double column; null has `NULL_CODE`.

    The code is the bit pattern of the magnitude with the value's sign. Exponent
    and mantissa are taken apart by arithmetic that is exact: only the logarithm
    is not, and it is corrected by comparing with the power of two. NaN must
    have been made null. The column is never null for the optimizer. Interim
    columns keep the optimizer from repeating the logarithm and the powers.
    """
    size, guess, scale = (F.col(f"{alias}{part}") for part in ("_size", "_guess", "_scale"))
    one = F.lit(1).cast("bigint")
    shift = (size / scale >= 2).cast("int") - (size < scale).cast("int")
    normal = (guess + _BIAS).cast("bigint") * (one * (1 << _MANTISSA)) + (
        (size / scale - 1) * float(1 << _MANTISSA)
    ).cast("bigint")
    code = (
        F.when(size == 0, one * 0)
        .when(size == float("inf"), F.lit(_INFINITE))
        .when(guess < 1 - _BIAS, (size / F.lit(_LEAST)).cast("bigint"))
        .otherwise(normal)
    )
    guessed = F.floor(F.least(F.greatest(F.log2(F.abs(value)), F.lit(-1074.0)), F.lit(1023.0))).cast("double")
    power = F.pow(F.lit(2.0), guess).alias(f"{alias}_scale")
    return (
        df.select("*", F.abs(value).alias(f"{alias}_size"), guessed.alias(f"{alias}_guess"))
        .select("*", power)
        .withColumn(f"{alias}_guess", guess + shift)
        .withColumn(f"{alias}_scale", F.pow(F.lit(2.0), guess))
        .withColumn(alias, F.coalesce(F.when(F.col(value) < 0, -code).otherwise(code), F.lit(NULL_CODE)))
        .drop(f"{alias}_size", f"{alias}_guess", f"{alias}_scale")
    )


def _hits(rows: DataFrame, within: Sequence[str], *keep: str) -> DataFrame:
    """Classes _k that hold a middle rank (_r1 or _r2, within their parent), with ranks within the class."""
    order = Window.partitionBy(*within).orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("_b", F.sum("_c").over(order) - F.col("_c"))
    ranks = []
    for rank in ("_r1", "_r2"):
        local = F.col(rank) - F.col("_b")
        ranks.append(F.when(local.between(1, F.col("_c")), local).alias(rank))
    return placed.select("_g", "_k", *keep, *ranks).where("_r1 is not null or _r2 is not null")


def _inside(classes: DataFrame, targets: DataFrame, parent: str, *keep: str) -> DataFrame:
    """The classes whose ``parent`` is a target class, with the ranks within that."""
    targets = targets.select(F.col("_g").alias("_tg"), F.col("_k").alias("_tk"), "_r1", "_r2")
    same = (F.col("_g") == F.col("_tg")) & (F.col(parent) == F.col("_tk"))
    return classes.join(targets, same).select("_g", parent, "_c", "_r1", "_r2", *keep)


def grouped_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    alias: str,
    *,
    sums: Mapping[str, str] | None = None,
    spread: Mapping[str, str] | None = None,
    approx: bool = False,
) -> DataFrame:
    """Exact median per group, with sums and mean/min/max alongside.

    Rows with a null key are dropped. Null values do not count for the median,
    which is null for a group without values; sums over nothing give 0.0.

    ``sums`` maps output names to columns; ``spread`` maps any of "mean", "min",
    "max" to output names. With ``approx`` the median is a `percentile_approx`.

    How a hot group is spread: rows are first counted per (keys, value), which
    combines on the map side and hashes a group over all tasks. The counts are
    dealt by the leading 32 bits of the values' codes, for prices a millionth of
    their size, and added up per leading 32 and 16 bits. Then the descent: of the
    at most 65,536 classes of 16 bits those with the middle ranks are kept, of the
    at most 65,536 finer classes in each of these again, and after four levels the
    values themselves. So whatever the number of rows or of distinct values of a
    group, no window has more than 65,536 rows of one key, and joins are keyed by
    a class, which spreads the group. `F.median` would instead gather every
    distinct value of a group in one task's memory.

    The source is read once. The dealt counts are used for the classes, for the
    values and for the totals, and all three take the same columns of them, so
    that their shuffle is reused; that is why the count is made to depend on the
    others. The keys are one struct, which is never null, so that no join adds a
    filter to one of the uses.
    """
    sums = dict(sums or {})
    spread = dict(spread or {})
    carried = [f"_s{i}" for i in range(len(sums))]
    rows = df.where(known(keys)).select(
        *keys,
        F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")).alias("_x"),
        *[F.col(c).cast("double").alias(s) for s, c in zip(carried, sums.values(), strict=True)],
    )
    if approx:
        return rows.groupBy(*keys).agg(
            F.percentile_approx("_x", 0.5, 10000).alias(alias),
            *[F.coalesce(F.sum(s), F.lit(0.0)).alias(name) for s, name in zip(carried, sums, strict=True)],
            *[getattr(F, stat)("_x").alias(name) for stat, name in spread.items()],
        )

    counted = rows.groupBy(*keys, "_x").agg(F.count("_x").alias("_c"), *[F.sum(s).alias(s) for s in carried])
    coded = with_code(counted.select(F.struct(*keys).alias("_g"), "_x", "_c", *carried), "_x", "_v")
    dealt = coded.withColumn("_k2", F.shiftright("_v", 2 * LEVEL_BITS)).repartition("_g", "_k2")
    count = F.col("_c") + F.pmod(F.hash("_x", "_v", *carried), F.lit(1))
    dealt = dealt.select("_g", "_k2", "_v", "_x", count.alias("_c"), *carried)

    second = dealt.groupBy("_g", F.col("_k2").alias("_k")).agg(F.sum("_c").alias("_c"))
    first = second.groupBy("_g", F.shiftright("_k", LEVEL_BITS).alias("_k")).agg(F.sum("_c").alias("_c"))
    n = F.sum("_c").over(Window.partitionBy("_g"))
    middle = first.select("*", F.floor((n + 1) / 2).alias("_r1"), F.floor((n + 2) / 2).alias("_r2"))
    targets = _hits(middle, ["_g"])
    second = second.select("*", F.shiftright("_k", LEVEL_BITS).alias("_k1"))
    targets = _hits(_inside(second, targets, "_k1", "_k"), ["_g", "_k1"])

    # What is left is a few classes of 32 bits, in place. Their values are packed by the
    # next 16 bits, at most 65,536 to a pack, and the packs with a middle rank unpacked.
    opened = _inside(dealt, targets, "_k2", "_x", "_v")
    packs = opened.groupBy(
        "_g", "_k2", "_r1", "_r2", F.shiftright("_v", LEVEL_BITS).alias("_k")
    ).agg(F.sum("_c").alias("_c"), F.collect_list(F.struct("_x", "_c")).alias("_pack"))
    packs = _hits(packs, ["_g", "_k2"], "_k2", "_pack")
    unpacked = packs.select("_g", "_k2", F.col("_k").alias("_k3"), "_r1", "_r2", F.inline("_pack").alias("_k", "_c"))
    middle = _hits(unpacked, ["_g", "_k2", "_k3"])

    # Half a median from each rank; an odd count has both ranks at one value.
    ranks = F.col("_r1").isNotNull().cast("int") + F.col("_r2").isNotNull().cast("int")
    halves = middle.select("_g", (F.col("_k") * (ranks / 2)).alias("_half"))
    everything = dealt.drop("_k2", "_v").unionByName(halves, allowMissingColumns=True)
    total = F.sum(F.col("_x") * F.col("_c"))
    stats = {"mean": F.try_divide(total, F.sum("_c")), "min": F.min("_x"), "max": F.max("_x")}
    outputs = [alias, *sums, *spread.values()]
    return (
        everything.groupBy("_g")
        .agg(
            F.when(F.sum("_c") > 0, F.sum("_half")).alias(alias),
            *[F.coalesce(F.sum(s), F.lit(0.0)).alias(name) for s, name in zip(carried, sums, strict=True)],
            *[stats[stat].alias(name) for stat, name in spread.items()],
        )
        .select("_g.*", *outputs)
    )
