import math

import pytest
from conftest import day
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions import parsing as P
from quotemill.functions.naming import (
    normal_name,
    normalize_columns,
    rename_columns,
    require_columns,
    select_available,
)
from quotemill.schemas import PRODUCT_NAMES


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression("x")).collect()]


def test_months(spark):
    good = ["2025/1", "2025/01", "2025/12"]
    assert apply(spark, good, P.parse_month) == [
        day("2025-01-01"),
        day("2025-01-01"),
        day("2025-12-01"),
    ]
    bad = ["2025/13", "25/01", "2025/01/05", "2025-01", " 2025/01", "12025/01", "x", "", None]
    assert apply(spark, bad, P.parse_month) == [None] * len(bad)


def test_days(spark):
    assert apply(spark, ["2025-01-05", "2025-1-5"], P.parse_day) == [day("2025-01-05")] * 2
    bad = ["2025/01/05", "2025-02-30", "2025-01", "", None]
    assert apply(spark, bad, P.parse_day) == [None] * len(bad)


def test_numbers(spark):
    good = ["1", "1.5", " 2 ", "1e3", "1.", "+.5", "-2.5E-1"]
    assert apply(spark, good, P.parse_number) == [1.0, 1.5, 2.0, 1000.0, 1.0, 0.5, -0.25]
    assert apply(spark, ["inf", "-Infinity"], P.parse_number) == [math.inf, -math.inf]
    bad = ["1,5", "abc", "", "0x10", "1_000", "1d", "5f", "nan", None]
    assert apply(spark, bad, P.parse_number) == [None] * len(bad)


def test_null_spellings(spark):
    df = spark.createDataFrame(
        [(v,) for v in ["NA", "n/a", "None", "", "null", "N/D", "-", "na"]], "x string"
    )
    kept = [r[0] for r in P.null_tokens(df).where("x is not null").collect()]
    assert sorted(kept) == ["-", "N/D", "na"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert P.nan_to_null(df).agg(F.avg("x")).first()[0] == 1.0


def test_strict_cast_fails_whatever_the_ansi_mode(spark):
    df = spark.createDataFrame([("12.5",), (None,)], "x string")
    cast = P.strict_cast("x", T.DoubleType(), "x")
    assert [r[0] for r in df.select(cast).collect()] == [12.5, None]
    broken = spark.createDataFrame([("12,5",)], "x string").select(cast)
    for mode in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", mode)
        try:
            with pytest.raises(Exception, match="cannot read '12,5'"):
                broken.collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_product_names(spark):
    values = [
        "NAFTA (Premium) de MÁS de 95 RON",
        "Nafta (Común) hasta 92 ron",
        "gnc",
        " gnc",
        "N/D",
        "otro",
        None,
    ]
    assert apply(spark, values, lambda c: P.map_values(c, PRODUCT_NAMES)) == [
        "NAFTA GRADO 3",
        "NAFTA GRADO 1",
        "GNC",
        None,
        None,
        None,
        None,
    ]


def test_rounding_follows_numpy(spark):
    values = [0.125, 2.675, 1.015, 1.005, -0.125]
    rounded = apply(spark, values, P.round_half_even, "double")
    assert rounded == [0.12, 2.68, 1.01, 1.0, -0.12]


def test_zero_division_is_null(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(P.percent_of("a", "b")).collect()] == [None, None, 25.0]


def test_column_names(spark):
    names = ["Período", "Nº Inscripción", "No.Movimientos", "Precio Surtidor"]
    expected = ["periodo", "no_inscripcion", "no_movimientos", "precio_surtidor"]
    assert [normal_name(n) for n in names] == expected
    df = spark.createDataFrame([("1", "2", "3", "4")], names)
    assert normalize_columns(df).columns == expected
    with pytest.raises(ValueError, match="collide"):
        normalize_columns(spark.createDataFrame([("1", "2")], ["a b", "A.B"]))


def test_column_checks(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    assert require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(df, ["a", "c"])
    assert select_available(df, ["b", "c"]).columns == ["b"]
    assert rename_columns(df, {"a": "x", "z": "y"}).columns == ["x", "b"]
