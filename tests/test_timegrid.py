from conftest import day, rows

from quotemill.operators import timegrid as G


def quotes(spark, *pairs):
    return spark.createDataFrame([(day(d) if d else None, v) for d, v in pairs], "date date, v double")


def test_one_month(spark):
    days = ["2022-01-01", "2022-01-02", "2022-01-03", "2022-01-04", "2022-01-05"]
    df = quotes(spark, *zip(days, [80.0, 85.0, 90.0, 75.0, 70.0]))
    assert rows(G.monthly_mean(df, "v", "mean")) == [(day("2022-01-31"), 80.0)]


def test_empty_months_are_kept(spark):
    df = quotes(
        spark,
        ("2025-01-05", 1.0),
        ("2025-01-06", None),
        ("2025-03-02", 5.0),
        ("2025-04-01", None),
        (None, 9.0),
    )
    assert rows(G.monthly_mean(df, "v", "mean")) == [
        (day("2025-01-31"), 1.0),
        (day("2025-02-28"), None),
        (day("2025-03-31"), 5.0),
        (day("2025-04-30"), None),
    ]


def test_each_series_has_its_own_grid(spark):
    df = spark.createDataFrame(
        [
            ("a", day("2024-12-31"), 1.0),
            ("a", day("2025-02-01"), 3.0),
            ("b", day("2025-05-05"), 7.0),
        ],
        "s string, date date, v double",
    )
    assert rows(G.monthly_mean(df, "v", "mean", series=["s"])) == [
        ("a", day("2024-12-31"), 1.0),
        ("a", day("2025-01-31"), None),
        ("a", day("2025-02-28"), 3.0),
        ("b", day("2025-05-31"), 7.0),
    ]


def test_missing_business_days(spark):
    # Thursday, Friday, the Tuesday after, and that Wednesday twice
    df = quotes(
        spark,
        ("2025-01-02", 1.0),
        ("2025-01-03", 1.0),
        ("2025-01-07", 1.0),
        ("2025-01-08", 1.0),
        ("2025-01-08", 2.0),
    )
    missing = G.missing_business_days(df)
    assert rows(missing) == [(day("2025-01-06"),)]
    assert rows(G.weekday_histogram(missing)) == [("Monday", 1)]
    report = G.business_day_coverage(df).first().asDict()
    assert report == {
        "first_day": day("2025-01-02"),
        "last_day": day("2025-01-08"),
        "rows": 5,
        "observed_days": 4,
        "missing_days": 1,
        "expected_days": 5,
    }


def test_gaps(spark):
    assert rows(G.gap_distribution(quotes(spark, ("2025-01-01", 1.0), ("2025-01-04", 1.0)))) == [
        (3, 1)
    ]
    df = quotes(spark, *[(d, 1.0) for d in ["2025-01-01"] * 3 + ["2025-01-02", "2025-01-03", None]])
    assert rows(G.gap_distribution(df)) == [(0, 2), (1, 2)]


def test_single_day_has_no_gap(spark):
    df = quotes(spark, ("2025-01-01", 1.0))
    assert rows(G.gap_distribution(df)) == []
    assert rows(G.missing_business_days(df)) == []
