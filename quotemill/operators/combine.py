"""Union, incremental accumulation and keyed upserts as DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.naming import columns_of, require_columns
from quotemill.operators.quality import unique_batch


def concat_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All rows of all batches, columns matched by name, missing ones null."""
    if not batches:
        raise ValueError("no batches given")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct; null equals null. Copies combine before the shuffle."""
    return df.dropDuplicates()


def accumulate(
    existing: DataFrame | None,
    batches: Sequence[DataFrame],
    dedup_first: bool = False,
) -> DataFrame | None:
    """Existing rows and new batches together, without repeated rows.

    Without new batches the existing result stays as it is. The first run keeps
    repeats unless ``dedup_first``.
    """
    if not batches:
        return existing
    new = concat_batches(batches)
    if existing is None:
        return distinct_rows(new) if dedup_first else new
    return distinct_rows(concat_batches([existing, new]))


def with_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add _d1 and _d2, 128 bits of digest of the columns; where nulls are counts."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])
    values = [F.col(f"`{c}`") for c in columns]
    return df.select("*", F.xxhash64(nulls, *values).alias("_d1"), F.xxhash64(*reversed(values), nulls).alias("_d2"))


def unseen_rows(existing: DataFrame, batches: Sequence[DataFrame]) -> DataFrame:
    """The rows that `accumulate` would add to an existing result without repeats.

    Appending them gives the same table as rewriting it. Both sides are keyed by a
    128-bit digest of all columns: the existing rows that share a digest with the
    batch are found by a semi join on its two numbers, and only these hits are
    compared column by column, null equal to null, as digests could collide. A small
    batch leaves the large side in place; a large one moves it by two numbers, not
    by whole rows as keys. The batch is read once, as its distinct step is reused.
    """
    new = distinct_rows(concat_batches(batches))
    require_columns(existing, new.columns)
    columns = new.columns
    batch = with_digest(new, columns)
    keys = batch.select(F.col("_d1").alias("_n1"), F.col("_d2").alias("_n2"))
    stored = with_digest(existing.select(*[F.col(f"`{c}`") for c in columns]), columns)
    hits = stored.join(keys, (F.col("_d1") == F.col("_n1")) & (F.col("_d2") == F.col("_n2")), "left_semi")
    hits = hits.select(*[F.col(f"`{c}`").alias(f"_h{i}") for i, c in enumerate(columns)], F.col("_d1").alias("_h"), F.col("_d2").alias("_hh"))
    same = (F.col("_d1") == F.col("_h")) & (F.col("_d2") == F.col("_hh"))
    for i, c in enumerate(columns):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_h{i}"))
    return batch.join(hits, same, "left_anti").select(*[F.col(f"`{c}`") for c in columns])


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> DataFrame:
    """Target rows, those with a key in the batch replaced, new keys added.

    Replaced rows are removed by an anti join and the batch is appended, so the
    target is neither sorted nor grouped: with a batch below the broadcast
    threshold its rows do not move at all, and a larger one is shuffled by key.
    Keys with a null equal nothing: such rows are kept and added, never replaced.
    """
    require_columns(batch, list(keys))
    new = unique_batch(batch, keys, on_duplicate, order_by).select(*target.columns)
    return target.join(new.select(*keys), list(keys), "left_anti").select(
        *target.columns
    ).unionByName(new)


def upsert_columns(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> DataFrame:
    """Upsert of the columns the batch has; other columns keep their values.

    A key that is new gets null in the columns the batch lacks. The target is the
    left side of a left join and rows of new keys are appended, so that a batch
    below the broadcast threshold leaves the target's rows in place.
    """
    require_columns(batch, list(keys))
    provided = [c for c in batch.columns if c in target.columns and c not in keys]
    ordering = [order_by] if order_by and order_by not in [*keys, *provided] else []
    new = unique_batch(
        batch.select(*keys, *provided, *ordering), keys, on_duplicate, order_by
    ).withColumn("_hit", F.lit(True))
    t, b = target.alias("t"), new.alias("b")
    on = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys]
    merged = t.join(b, on, "left")
    added = b.join(target.select(*keys), list(keys), "left_anti")

    def pick(name: str):
        if name in provided:
            return F.when(F.col("b._hit"), F.col(f"b.{name}")).otherwise(F.col(f"t.{name}"))
        return F.col(f"t.{name}")

    held = [*keys, *provided]
    return merged.select(*[pick(c).alias(c) for c in target.columns]).unionByName(
        added.select(*[F.col(c) for c in target.columns if c in held]), allowMissingColumns=True
    )
