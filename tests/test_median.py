"""The descent through the bits of the values: codes, bounds and odd values."""

import math
import random
import statistics
import struct

from pyspark.sql import functions as F

from quotemill.operators import median as M


def bits(x):
    code = struct.unpack("q", struct.pack("d", abs(x)))[0]
    return -code if x < 0 else code


def test_codes_are_the_bits(spark):
    """Around every power of two, subnormal ones too, and random bit patterns."""
    rng = random.Random(1)
    values = [math.ldexp(m, e) for e in range(-1074, 1024) for m in (1.0, 1 + 2**-52, 1.5, 2 - 2**-52) if e < 1023 or m < 2]
    values = [v for v in values if math.isfinite(v)] + [struct.unpack("d", rng.randbytes(8))[0] for _ in range(5000)]
    values = [v for v in values if v == v] + [0.0, math.inf]
    values += [-v for v in values]
    df = M.with_code(spark.createDataFrame([(v,) for v in [*values, None]], "x double"), "x", "k")
    assert df.columns == ["x", "k"]
    for row in df.collect():
        assert row.k == (M.NULL_CODE if row.x is None else bits(row.x))


def test_two_million_values_in_a_narrow_range(spark):
    """One group within 1000..1001, a third of the rows one value: no class has more than 65,536 parts."""
    n = 2_000_001
    x = F.when(F.col("id") % 3 == 0, F.lit(1000.25)).otherwise(F.lit(1000.0) + F.col("id") / n)
    df = spark.range(n).select(F.lit("hot").alias("g"), x.alias("x"))
    values = sorted(1000.25 if k % 3 == 0 else 1000.0 + k / n for k in range(n))
    assert M.grouped_median(df, ["g"], "x", "m").first().m == values[n // 2]
    coded = M.with_code(df.select("x").distinct(), "x", "k")
    assert coded.count() > 1_300_000
    for level in (48, 32, 16, 0):
        parts = coded.select(F.shiftright("k", level).alias("part")).distinct()
        most = parts.groupBy(F.shiftright("part", M.LEVEL_BITS)).count().agg(F.max("count")).first()[0]
        assert most <= 1 << M.LEVEL_BITS


def test_neighbours_in_the_last_bits(spark):
    """Values that differ in the last 16 or 32 bits only, repeated and signed."""
    rng = random.Random(2)
    rows = []
    for group in range(30):
        base = rng.choice([1.0, -1.0, 3e-320, -2e300, 0.0])
        step = math.ulp(base)
        size = rng.choice([1, 2, 3, 50, 400])
        reach = rng.choice([3, 1 << 15, 1 << 17, 1 << 34])
        rows += [(f"g{group}", base + step * rng.randrange(reach)) for _ in range(size)]
    got = {r.g: r.m for r in M.grouped_median(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", "m").collect()}
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(x)
    for g, values in groups.items():
        low, high = statistics.median_low(values), statistics.median_high(values)
        assert got[g] == low / 2 + high / 2 or got[g] == (low + high) / 2


def test_struct_of_keys_and_no_rows(spark):
    df = spark.createDataFrame([("a", None, 1.0), (None, 1, 2.0)], "g string, h int, x double")
    assert M.grouped_median(df, ["g", "h"], "x", "m").collect() == []
    assert M.grouped_median(df, ["g"], "x", "m", spread={"min": "lo"}).collect() == [("a", 1.0, 1.0)]
