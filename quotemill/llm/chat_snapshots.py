"""Chat logs: collapse of cumulative snapshots, and rendering of what remains.

Method. A log often holds a conversation several times, each time with more
turns. Rolling hashes identify every beginning of a conversation; one whose
whole hash is that of a proper beginning of another one goes (anti-join), and of
equal ones the smallest id stays. The maximal conversations are rendered.

At scale. Turns are cut into blocks of SPAN positions; the hash of a beginning
is that of the blocks before and of the turns so far in its own. So a very
long conversation is hashed by many tasks, and only one row per block goes into
the chain over its blocks. It is rendered into one row per block as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.store import Store

SPAN = 256


def _digest(*parts: Column | str) -> Column:
    """SHA-256 of parts whose lengths and nulls are part of what is hashed."""
    shown = []
    for part in parts:
        text = (F.col(part) if isinstance(part, str) else part).cast("string")
        shown.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*shown), 256)


def positions(turns: DataFrame) -> DataFrame:
    """Turns with ``pos``, their number within the conversation from 0, in order of turn, role and text.

    Buckets of turn numbers are counted first and numbered by what stands
    before them, so that no task orders all turns of a conversation.
    """
    turns = turns.withColumn("_bucket", F.floor(F.col("turn") / SPAN))
    own = Window.partitionBy("conv_id", "_bucket").orderBy("turn", "role", "text")
    counts = turns.groupBy("conv_id", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("conv_id").alias("_c"),
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    numbered = turns.withColumn("_row", F.row_number().over(own) - 1)
    same = (F.col("conv_id") == F.col("_c")) & F.col("_bucket").eqNullSafe(F.col("_b"))
    return numbered.join(starts, same).select(
        "conv_id", "turn", "role", "text", (F.col("_start") + F.col("_row")).alias("pos")
    )


def collapse(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, pos) of the turns of maximal conversations.

    A turn is compared by role and text; turn numbers give the order only. Exact
    repeats of a row count once; turns with one number and different content
    follow each other by role and text, a null number comes first. Rows with a
    null conv_id belong to no conversation and go. A null role or text differs
    from an empty one.
    """
    store = Store(conversations.sparkSession, "snapshots")
    turns = conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null").distinct()
    rows = store.put(
        positions(turns).withColumns({"block": F.floor(F.col("pos") / SPAN), "_h": _digest("role", "text")}), "turns"
    )
    cells = rows.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("pos", "_h"))).alias("_turns")
    )
    # Hashes of the beginnings of a block of at most SPAN turns, each made from the one before.
    rolled = F.aggregate(
        "_turns",
        F.array(F.lit("")).cast("array<string>"),
        lambda done, t: F.array_append(done, F.sha2(F.concat(F.element_at(done, -1), t["_h"]), 256)),
    )
    cells = store.put(cells.select("conv_id", "block", F.slice(rolled, 2, SPAN).alias("_within")), "blocks")
    # The blocks before, one row per SPAN turns: an exclusive or of hashes that hold the block's number.
    over = Window.partitionBy("conv_id").orderBy("block")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    told = [F.bit_xor(F.xxhash64("block", F.element_at("_within", -1), F.lit(k))).over(earlier) for k in (1, 2)]
    last = F.max("block").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    chained = cells.withColumns({"_before": F.concat_ws(",", *[x.cast("string") for x in told]), "_last": last})
    begun = chained.select(
        "conv_id", "block", "_last", "_before", F.size("_within").alias("_size"), F.posexplode("_within").alias("_i", "_w")
    )
    begun = store.put(
        begun.select(
            "conv_id",
            F.sha2(F.concat("_before", "_w"), 256).alias("prefix"),
            ((F.col("block") == F.col("_last")) & (F.col("_i") == F.col("_size") - 1)).alias("_whole"),
        ),
        "prefixes",
    )
    proper = begun.where("not _whole").select("prefix").distinct()
    whole = begun.where("_whole").groupBy("prefix").agg(F.min("conv_id").alias("conv_id"))
    kept = whole.join(proper, "prefix", "left_anti").select(F.col("conv_id").alias("_kept"))
    return rows.join(kept, F.col("conv_id") == F.col("_kept"), "left_semi").drop("_h")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, segment, n_turns, rendered): conversations as chat text, SPAN turns to a row.

    Each turn is ``<|im_start|>role\\ntext<|im_end|>\\n``; a null role is written as
    "user" and a null text as nothing.
    """
    line = F.concat(
        F.lit("<|im_start|>"), F.coalesce("role", F.lit("user")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n")
    )
    parts = turns.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))).alias("_p"))
    return parts.select(
        "conv_id",
        F.col("block").alias("segment"),
        F.size("_p").cast("long").alias("n_turns"),
        F.array_join(F.transform("_p", lambda p: p["line"]), "").alias("rendered"),
    )


ORACLE = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)),
h AS (
  SELECT conv_id, pos, string_agg(coalesce(length(role) || ':' || role, '-') || coalesce(length(text) || ':' || text, '-'), '')
           OVER (PARTITION BY conv_id ORDER BY pos) AS prefix,
         max(pos) OVER (PARTITION BY conv_id) AS top FROM t),
kept AS (
  SELECT min(conv_id) AS conv_id FROM h WHERE pos = top
    AND prefix NOT IN (SELECT prefix FROM h WHERE pos < top) GROUP BY prefix)
SELECT conv_id, pos // 256 AS segment, count(*) AS n_turns,
  string_agg('<|im_start|>' || coalesce(role, 'user') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
FROM t SEMI JOIN kept USING (conv_id) GROUP BY conv_id, pos // 256
"""
