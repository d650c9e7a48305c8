"""Interleaving of source blocks to target weights by Pfair scheduling.

Method. The rows of a source are cut into blocks in a shuffled order. Block i of
a source with share w of the slots is released at slot floor(i / w) and due
before slot ceil((i + 1) / w); in each slot, of the released blocks, the one
with the earliest deadline goes out. With integer weights of sum A this meets
every deadline, so a source is never a whole block away from its share, and the
schedule repeats every A slots. When a source is used up, the others start anew
with their shares of what is left, until all rows are placed.

At scale. Only one period per phase is scheduled one by one, whose length the
weights bound; the slot of any block follows from it by arithmetic. Rows get
their number within a source by counts of hash buckets, never by one sort of a source.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.store import Store

BLOCK_ROWS = 64
DEFAULT_WEIGHT = 1
# Target weights of the sources in the query and the pipeline; those not named have DEFAULT_WEIGHT.
TARGET_WEIGHTS = {"src0": 4, "src1": 2, "src2": 2}
#: Sources and the sum of their weights, at most: the schedule of one period is made by the driver.
MOST_SLOTS = 100_000
_BUCKET_ROWS = 2000


def period(weights: Mapping[int, int]) -> list[int]:
    """The source of each slot of one period; ``weights`` are positive integers."""
    total = sum(weights.values())
    waiting = [(0, source) for source in weights]  # release, source
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []  # deadline, source
    sent = dict.fromkeys(weights, 0)
    out = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, source = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(sent[source] + 1) * total // weights[source]), source))
        _, source = heapq.heappop(ready)
        out.append(source)
        sent[source] += 1
        if sent[source] < weights[source]:
            heapq.heappush(waiting, (sent[source] * total // weights[source], source))
    return out


def phases(weights: Mapping[int, int], blocks: Mapping[int, int]) -> list[tuple]:
    """(source, first block, blocks, first slot, period length, slots of the source in it) of each phase."""
    left = {s: n for s, n in blocks.items() if n}
    done = dict.fromkeys(blocks, 0)
    start, out = 0, []
    while left:
        share = {s: weights[s] for s in left}
        order = period(share)
        slots: dict[int, list[int]] = {s: [] for s in left}
        for slot, source in enumerate(order):
            slots[source].append(slot)
        total = len(order)
        # The phase ends with the first slot that uses up a source.
        ends = [(n - 1) // share[s] * total + slots[s][(n - 1) % share[s]] + 1 for s, n in left.items()]
        length = min(ends)
        for source in list(left):
            n = length // total * share[source] + sum(x < length % total for x in slots[source])
            if n:
                out.append((source, done[source], n, start, total, slots[source]))
            done[source] += n
            left[source] -= n
            if not left[source]:
                del left[source]
        start += length
    return out


def interleave(
    df: DataFrame,
    weights: Mapping[str | None, int] | None = None,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``df`` with block (number within its source), slot and position, the place in the mixture.

    ``weights`` gives the target weight of a source as a positive integer; one
    not named has DEFAULT_WEIGHT. A null source is a source. No row is dropped
    or repeated: while all sources last, each holds its share of every beginning
    of the mixture within one block, and likewise the remaining ones after that.
    Rows are ordered by a hash of the id within a source; repeated and null ids
    are placed one by one. Equal rows may swap places. The last block of a
    source may be short, so positions ascend without being dense. Columns named
    block, slot or position in ``df`` are replaced.
    """
    weights = dict(weights or {})
    if any(int(w) != w or w < 1 for w in weights.values()):
        raise ValueError("weights are positive integers")
    spark = df.sparkSession
    store = Store(spark, "mixture")
    df = df.drop("block", "slot", "position")
    columns = df.columns
    source = F.col(source_col).cast("string")
    # A source key that is never null, for joins.
    keyed = df.withColumn("__mix_s", F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    counts = keyed.groupBy("__mix_s").agg(F.count("*").alias("n")).orderBy("__mix_s").limit(MOST_SLOTS + 1).collect()
    given = {"" if s is None else f"={s}": int(w) for s, w in weights.items()}
    weight = {k: given.get(r["__mix_s"], DEFAULT_WEIGHT) for k, r in enumerate(counts)}
    if sum(weight.values()) > MOST_SLOTS:
        raise ValueError(f"the weights of all sources sum to more than {MOST_SLOTS}")
    blocks = {k: -(-r["n"] // block_rows) for k, r in enumerate(counts)}
    plan = [(counts[s]["__mix_s"], *rest) for s, *rest in phases(weight, blocks)]
    plan_df = spark.createDataFrame(
        plan, "__mix_ps string, __mix_first long, __mix_n long, __mix_start long, __mix_period long, __mix_slots array<long>"
    )
    sizes = spark.createDataFrame(
        [(r["__mix_s"], -(-r["n"] // _BUCKET_ROWS)) for r in counts], "__mix_bs string, __mix_buckets long"
    )
    # Both tables have at most MOST_SLOTS entries.
    mark = F.xxhash64(id_col)
    dealt = keyed.join(F.broadcast(sizes), F.col("__mix_s") == F.col("__mix_bs")).withColumns(
        {"__mix_h": mark, "__mix_bucket": F.pmod(F.xxhash64(mark, F.lit(1)), "__mix_buckets")}
    )
    whole = F.xxhash64(*[F.col(c) for c in columns])
    local = Window.partitionBy("__mix_s", "__mix_bucket").orderBy("__mix_h", id_col, whole)
    per_bucket = store.put(dealt.groupBy("__mix_s", "__mix_bucket").agg(F.count("*").alias("__mix_c")), "buckets")
    # Numbers of earlier buckets of the source, added up in two steps: within a thousand, and over thousands.
    per_bucket = per_bucket.withColumn("__mix_k", F.floor(F.col("__mix_bucket") / 1000))
    thousands = per_bucket.groupBy("__mix_s", "__mix_k").agg(F.sum("__mix_c").alias("__mix_tc"))
    before = Window.orderBy("__mix_k").rowsBetween(Window.unboundedPreceding, -1)
    thousands = thousands.withColumn(
        "__mix_base", F.coalesce(F.sum("__mix_tc").over(before.partitionBy("__mix_s")), F.lit(0))
    ).select(F.col("__mix_s").alias("__mix_ts"), F.col("__mix_k").alias("__mix_tk"), "__mix_base")
    within = Window.partitionBy("__mix_s", "__mix_k").orderBy("__mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("__mix_o", F.coalesce(F.sum("__mix_c").over(within), F.lit(0)))
    offsets = offsets.join(thousands, (F.col("__mix_s") == F.col("__mix_ts")) & (F.col("__mix_k") == F.col("__mix_tk"))).select(
        F.col("__mix_s").alias("__mix_os"), F.col("__mix_bucket").alias("__mix_ob"), (F.col("__mix_o") + F.col("__mix_base")).alias("__mix_offset")
    )
    numbered = dealt.withColumn("__mix_row", F.row_number().over(local) - 1)
    numbered = numbered.join(
        offsets, (F.col("__mix_s") == F.col("__mix_os")) & (F.col("__mix_bucket") == F.col("__mix_ob"))
    ).withColumn("__mix_row", F.col("__mix_row") + F.col("__mix_offset"))
    placed = numbered.withColumn("block", F.floor(F.col("__mix_row") / block_rows)).join(
        F.broadcast(plan_df),
        (F.col("__mix_s") == F.col("__mix_ps"))
        & (F.col("block") >= F.col("__mix_first"))
        & (F.col("block") < F.col("__mix_first") + F.col("__mix_n")),
    )
    own = F.size("__mix_slots")
    place = F.col("block") - F.col("__mix_first")
    slot = F.col("__mix_start") + F.floor(place / own) * F.col("__mix_period") + F.element_at(
        "__mix_slots", (place % own + 1).cast("int")
    )
    return placed.withColumn("slot", slot).select(
        *columns, "block", "slot", (F.col("slot") * block_rows + F.col("__mix_row") % block_rows).alias("position")
    )
