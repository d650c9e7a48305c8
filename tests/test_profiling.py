import pytest
from conftest import day, rows

from quotemill.operators import profiling as R
from quotemill.operators import quality as V
from quotemill.schemas import ANALYTICS_FX, STAGING_FUEL, STAGING_FX


def sample(spark):
    return spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", None), (None, None), (None, None)], "s string, n int"
    )


def test_value_counts(spark):
    assert [tuple(r) for r in R.value_counts(sample(spark), "s").collect()] == [("a", 2), ("b", 1)]


def test_null_counts_and_profile(spark):
    assert rows(R.null_counts(sample(spark))) == [("n", 3), ("s", 2)]
    assert rows(R.column_profile(sample(spark))) == [
        (0, "s", "string", 3, 5),
        (1, "n", "int", 2, 5),
    ]


def test_duplicates(spark):
    assert rows(R.duplicate_count(sample(spark))) == [(2,)]
    assert rows(R.duplicate_count(sample(spark), ["n"])) == [(3,)]
    assert rows(R.duplicate_count(sample(spark).limit(0))) == [(0,)]


def test_distinct_values_and_mean(spark):
    assert [r["s"] for r in R.distinct_values(sample(spark), "s").collect()] == ["a", "b"]
    assert rows(R.series_mean(sample(spark), "n")) == [(1.0,)]


def test_feed_summary(spark):
    df = spark.createDataFrame(
        [
            (day("2025-01-01"), 1.0, "A", "x"),
            (day("2025-03-01"), None, "A", "y"),
            (None, 4.0, None, "x"),
        ],
        "d date, p double, producto string, provincia string",
    )
    row = R.feed_summary(df, "f", date="d", price="p", distinct=["producto", "provincia"]).first()
    assert row.asDict() == {
        "feed": "f",
        "rows": 3,
        "first_day": day("2025-01-01"),
        "last_day": day("2025-03-01"),
        "mean_price": 2.5,
        "products": 1,
        "provinces": 2,
    }
    plain = R.feed_summary(df.limit(0), "e")
    assert plain.first()["rows"] == 0
    total = R.grand_total(R.feed_summary(df, "f").unionByName(plain))
    assert rows(total) == [(3,)]


def test_batches(spark):
    counts = R.rows_per_batch(sample(spark).where("s is not null"), "s")
    assert rows(R.with_grand_total(counts)) == [("TOTAL", 3, 2), ("a", 2, 2), ("b", 1, 2)]


def checked(spark):
    return spark.createDataFrame(
        [
            (day("2025-01-01"), "Blue", 1.0, 1.0),
            (day("2025-01-01"), "Blue", 1.0, 0.0),
            (day("2025-01-01"), None, None, -1.0),
            (None, "Blue", 1e8, 99999999.996),
            (None, "x" * 21, 99999999.99, None),
        ],
        "date date, source string, value_buy double, value_sell double",
    )


def test_constraint_report(spark):
    report = dict(rows(V.constraint_report(checked(spark), STAGING_FX), "rule", "violations"))
    assert report == {
        "date not null": 2,
        "source not null": 1,
        "source length": 1,
        "value_buy nan": 0,
        "value_buy overflow": 1,
        "value_sell not null": 1,
        "value_sell positive": 2,
        "value_sell nan": 0,
        "value_sell overflow": 1,
        "unique (date, source)": 1,
    }
    warehouse = dict(
        rows(V.constraint_report(checked(spark), STAGING_FX, "warehouse"), "rule", "violations")
    )
    assert "value_sell positive" not in warehouse and "value_buy overflow" not in warehouse


def test_a_province_may_be_null_in_the_warehouse(spark):
    df = spark.createDataFrame([(None, 1.0)], "provincia string, precio_surtidor double")
    assert rows(V.constraint_report(df, STAGING_FUEL).where("violations > 0"), "rule") == [
        ("provincia not null",)
    ]
    assert V.constraint_report(df, STAGING_FUEL, "warehouse").where("violations > 0").count() == 0


def test_split(spark):
    valid, rejected = V.split_valid(checked(spark), STAGING_FX)
    assert valid.count() == 1 and rejected.count() == 4
    assert ["value_sell positive"] in [r["violations"] for r in rejected.collect()]


def test_empty_months_are_reported(spark):
    df = spark.createDataFrame(
        [(day("2025-01-31"), None, 1.0)], "date date, usd_ars_oficial double, usd_ars_blue double"
    )
    assert rows(V.constraint_report(df, ANALYTICS_FX).where("violations > 0"), "rule") == [
        ("usd_ars_oficial not null",)
    ]


def test_required_rows(spark):
    df = sample(spark)
    assert V.require_rows(df, "x") is df
    with pytest.raises(ValueError, match="nothing"):
        V.require_rows(df.limit(0), "nothing here")
