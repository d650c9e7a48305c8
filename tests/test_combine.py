import pytest
from conftest import rows
from pyspark.sql import functions as F

from quotemill.operators import combine as U
from quotemill.operators import listing as L
from quotemill.operators import quality as V


def kv(spark, *data):
    return spark.createDataFrame(data, "k string, v string, n int")


def test_batches_align_by_name(spark):
    a = spark.createDataFrame([(1, 2)], ["a", "b"])
    b = spark.createDataFrame([(3, 4)], ["b", "c"])
    assert rows(U.concat_batches([a, b]), "a", "b", "c") == [(None, 3, 4), (1, 2, None)]
    with pytest.raises(ValueError):
        U.concat_batches([])


def test_distinct_treats_nulls_as_equal(spark):
    df = kv(spark, (None, None, None), (None, None, None), ("a", None, 1))
    assert U.distinct_rows(df).count() == 2


def test_accumulate(spark):
    first = kv(spark, ("a", "x", 1), ("a", "x", 1))
    second = kv(spark, ("a", "x", 1), ("b", "y", 2))
    assert U.accumulate(None, []) is None
    assert U.accumulate(first, []) is first
    assert U.accumulate(None, [first]).count() == 2
    assert U.accumulate(None, [first], dedup_first=True).count() == 1
    assert rows(U.accumulate(first, [second])) == [("a", "x", 1), ("b", "y", 2)]


def test_unseen_rows_complete_the_accumulated_result(spark):
    old = kv(spark, ("a", None, 1), ("b", "y", 2))
    new = [kv(spark, ("a", None, 1), ("c", None, None)), kv(spark, ("c", None, None))]
    unseen = U.unseen_rows(old, new)
    assert rows(unseen) == [("c", None, None)]
    assert rows(old.unionByName(unseen)) == rows(U.accumulate(old, new))


def test_upsert(spark):
    target = kv(spark, ("k1", "a", 1), ("k2", "b", 1), (None, "z", 1))
    batch = kv(spark, ("k2", "c", 2), ("k3", "d", 2), (None, "y", 2))
    merged = U.upsert(target, batch, ["k"])
    assert sorted(rows(merged), key=str) == sorted(
        [("k1", "a", 1), ("k2", "c", 2), ("k3", "d", 2), (None, "z", 1), (None, "y", 2)], key=str
    )
    assert rows(U.upsert(merged.where("k is not null"), batch, ["k"])).count(("k2", "c", 2)) == 1


def test_duplicate_keys_in_one_batch(spark):
    target = kv(spark, ("k1", "a", 1))
    batch = kv(spark, ("k1", "b", 2), ("k1", "c", 3))
    with pytest.raises(Exception, match="duplicate key"):
        U.upsert(target, batch, ["k"]).collect()
    last = U.upsert(target, batch, ["k"], on_duplicate="last", order_by="n")
    assert rows(last) == [("k1", "c", 3)]
    with pytest.raises(ValueError):
        U.upsert(target, batch, ["k"], on_duplicate="last")
    with pytest.raises(ValueError):
        U.upsert(target, batch, ["k"], on_duplicate="first")


def test_small_batch_leaves_the_target_in_place(spark):
    target = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"), F.lit(1).alias("n"))
    merged = U.upsert(target, kv(spark, ("5", "w", 2)), ["k"])
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_column_subset_upsert_keeps_other_columns(spark):
    target = kv(spark, ("k1", "a", 1), ("k2", "b", 2))
    batch = kv(spark, ("k2", None, 9), ("k3", "d", 9)).select("k", "v")
    assert rows(U.upsert_columns(target, batch, ["k"]), "k", "v", "n") == [
        ("k1", "a", 1),
        ("k2", None, 2),
        ("k3", "d", None),
    ]


def test_unique_batch_against_brute_force(spark):
    data = [(f"k{i % 7}", f"v{i}", (i * 37) % 101) for i in range(100)] + [
        ("k0", f"h{i}", 1000 + i) for i in range(50)
    ]
    expected = {}
    for k, v, n in data:
        if k not in expected or n > expected[k][1]:
            expected[k] = (v, n)
    got = V.unique_batch(kv(spark, *data).repartition(6), ["k"], "last", "n")
    assert {k: (v, n) for k, v, n in rows(got)} == expected


def test_listings(spark):
    df = kv(spark, ("a", "x", 1), ("b", "x", 2), ("c", "y", 3))
    assert [r["k"] for r in L.latest(df, 2, ["n"]).collect()] == ["c", "b"]
    assert [r["k"] for r in L.earliest(df, 2, ["n"]).collect()] == ["a", "b"]
    assert [r["k"] for r in L.latest_first(df, 2, ["v"], ["n"]).collect()] == ["c", "a"]
    assert rows(L.matching(df, v="x", n=2), "k") == [("b",)]
    assert [r["n"] for r in L.ordered(df, "v", "n").collect()] == [1, 2, 3]
    plan = L.latest(df, 2, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_small_column_batch_leaves_the_target_in_place(spark):
    target = spark.range(1000).selectExpr("id AS k", "id AS v", "id AS n")
    batch = spark.createDataFrame([(1, 5), (2000, 6)], "k long, v long")
    merged = U.upsert_columns(target, batch, ["k"])
    assert rows(merged.where("k in (1, 2, 2000)"), "k", "v", "n") == [(1, 5, 1), (2, 2, 2), (2000, 6, None)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan


def test_unseen_rows_have_no_wide_key(spark, tmp_path):
    """The existing side is keyed by two numbers; the batch's distinct step is shared."""
    schema = "a string, b string, c double"
    spark.createDataFrame([("x", None, 1.0), (None, "x", 1.0), ("z", "z", None)], schema).write.parquet(str(tmp_path / "e"))
    data = [(None, "x", 1.0), ("x", None, 1.0), ("x", None, None), ("x", None, None), ("y", "y", 0.0), (None, None, None)]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "b"))
    added = U.unseen_rows(spark.read.parquet(str(tmp_path / "e")), [spark.read.parquet(str(tmp_path / "b"))])
    assert rows(added) == rows(spark.createDataFrame([("x", None, None), ("y", "y", 0.0), (None, None, None)], schema))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        added = U.unseen_rows(spark.read.parquet(str(tmp_path / "e")), [spark.read.parquet(str(tmp_path / "b"))])
        assert added.count() == 3
        added.collect()
        plan = added._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert all("struct" not in line for line in exchanges)
    assert plan.count("FileScan") == 2
