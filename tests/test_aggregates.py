import math
import random
import statistics

import pytest
from conftest import day, rows

from quotemill.operators import aggregates as A
from quotemill.operators import shares as S


def stations(spark, data):
    return spark.createDataFrame(
        [(day(p) if p else None, *rest) for p, *rest in data],
        "periodo date, provincia string, bandera string, producto string, "
        "precio_surtidor double, volumen bigint",
    )


def test_median_and_volume(spark):
    df = stations(
        spark,
        [
            ("2022-01-01", "Buenos Aires", "YPF", "NAFTA GRADO 2", 100.0, 1000),
            ("2022-01-01", "Buenos Aires", "YPF", "NAFTA GRADO 2", 120.0, 2000),
            ("2022-01-01", "Córdoba", "Shell", "GASOIL GRADO 3", 110.0, 1500),
        ],
    )
    assert rows(A.product_month(df)) == [
        (day("2022-01-01"), "GASOIL GRADO 3", 110.0, 1500.0),
        (day("2022-01-01"), "NAFTA GRADO 2", 110.0, 3000.0),
    ]
    four = A.product_month(df, keys=("periodo", "provincia", "bandera", "producto"))
    assert four.count() == 2


def test_nulls_in_groups(spark):
    df = stations(
        spark,
        [
            ("2022-01-01", "x", "y", "A", None, None),
            ("2022-01-01", "x", "y", "A", None, None),
            ("2022-01-01", "x", "y", "B", float("nan"), 5),
            ("2022-01-01", "x", "y", "B", 7.0, None),
            ("2022-01-01", "x", "y", None, 1.0, 1),
            (None, "x", "y", "A", 1.0, 1),
        ],
    )
    assert rows(A.product_month(df)) == [
        (day("2022-01-01"), "A", None, 0.0),
        (day("2022-01-01"), "B", 7.0, 5.0),
    ]


@pytest.mark.parametrize("grain", [0.01, 0.5, None])
def test_median_against_brute_force(spark, grain):
    rng = random.Random(7)
    data = []
    for group in range(40):
        size = rng.choice([1, 2, 3, 4, 10, 11, 200])
        for _ in range(size):
            x = rng.choice([1, 1, 1, -1]) * rng.lognormvariate(3, 2)
            x = x if grain is None else round(x / grain) * grain
            data.append((f"g{group}", rng.choice([x, x, 0.0, None]), rng.random()))
    # one hot group: a third of all rows, most of them with one value
    hot = len(data) // 2
    data += [("hot", rng.choice([5.0, 5.0, rng.random() * 10]), 1.0) for _ in range(hot)]
    df = spark.createDataFrame(data, "g string, x double, v double").repartition(5)
    result = A.grouped_median(
        df,
        ["g"],
        "x",
        "median",
        sums={"total": "v"},
        spread={"mean": "mean", "min": "lo", "max": "hi"},
    ).collect()
    groups = {}
    for g, x, v in data:
        groups.setdefault(g, ([], []))[1].append(v)
        if x is not None:
            groups[g][0].append(x)
    assert {r["g"] for r in result} == set(groups)
    for r in result:
        values, volumes = groups[r["g"]]
        assert r["median"] == (statistics.median(values) if values else None)
        assert math.isclose(r["total"], sum(volumes))
        assert r["lo"] == (min(values) if values else None)
        assert r["hi"] == (max(values) if values else None)
        if values:
            assert math.isclose(r["mean"], statistics.fmean(values), rel_tol=1e-9, abs_tol=1e-9)


def test_extreme_values_stay_in_order(spark):
    values = [-math.inf, -1e308, -5e-324, 0.0, 5e-324, 1e-300, 1e308, 1.7e308, math.inf]
    for n in range(1, len(values) + 1, 2):
        df = spark.createDataFrame([("a", v) for v in values[:n]], "g string, x double")
        assert A.grouped_median(df, ["g"], "x", "m").first()["m"] == values[n // 2]


def test_median_reads_its_source_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([("a", 1.0, 2.0)], "g string, x double, v double").write.parquet(path)
    result = A.grouped_median(
        spark.read.parquet(path), ["g"], "x", "m", sums={"total": "v"}
    )
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final


def test_approximate_median(spark):
    df = spark.createDataFrame([("a", float(x)) for x in range(1, 102)], "g string, x double")
    assert A.grouped_median(df, ["g"], "x", "m", approx=True).first()["m"] == 51.0


def fx(spark, data):
    return spark.createDataFrame(
        [(day(d) if d else None, s, v) for d, s, v in data], "date date, source string, value_sell double"
    )


def test_rates_and_gap(spark):
    df = fx(
        spark,
        [
            ("2022-01-01", "Oficial", 100.0),
            ("2022-01-02", "Blue", 180.0),
            ("2022-01-03", "Oficial", 102.0),
            ("2022-01-04", "Blue", 184.0),
        ],
    )
    row = A.monthly_rates(df).first()
    assert (row["date"], row["usd_ars_oficial"], row["usd_ars_blue"]) == (
        day("2022-01-31"),
        101.0,
        182.0,
    )
    assert math.isclose(row["brecha_cambiaria_pct"], (182 - 101) / 101 * 100)


def test_month_is_a_mean_of_daily_means(spark):
    df = fx(
        spark,
        [
            ("2025-01-01", "Oficial", 100.0),
            ("2025-01-01", "Oficial", 200.0),
            ("2025-01-02", "Oficial", 300.0),
        ],
    )
    assert A.monthly_rates(df).first()["usd_ars_oficial"] == 225.0


def test_days_without_value_do_not_extend_the_grid(spark):
    df = fx(
        spark,
        [
            ("2025-01-01", "Oficial", 1.0),
            ("2025-03-01", "Blue", None),
            (None, "Blue", 4.0),
            ("2025-04-01", None, 4.0),
        ],
    )
    assert rows(A.monthly_rates(df)) == [(day("2025-01-31"), 1.0, None, None)]


def test_months_between_quotes_are_kept(spark):
    df = fx(spark, [("2025-01-01", "Oficial", 1.0), ("2025-03-01", "Blue", 2.0)])
    assert rows(A.monthly_rates(df), "date", "usd_ars_oficial", "usd_ars_blue") == [
        (day("2025-01-31"), 1.0, None),
        (day("2025-02-28"), None, None),
        (day("2025-03-31"), None, 2.0),
    ]


def share_rows(spark, data):
    return spark.createDataFrame(
        [(day(p) if p else None, b, v) for p, b, v in data], "periodo date, bandera string, volumen bigint"
    )


def test_market_share(spark):
    df = share_rows(
        spark,
        [("2024-01-01", "YPF", 1000), ("2024-01-01", "Shell", 500), ("2024-01-01", "Axion", 500)],
    )
    shares = {r["bandera"]: r["market_share_pct"] for r in S.market_share_rows(df).collect()}
    assert shares == {"YPF": 50.0, "Shell": 25.0, "Axion": 25.0}
    by_brand = {r["bandera"]: r["market_share_pct"] for r in S.market_share_by_brand(df).collect()}
    assert by_brand == shares


def test_share_is_per_row_or_per_brand(spark):
    df = share_rows(
        spark, [("2024-01-01", "YPF", 1), ("2024-01-01", "YPF", 2), ("2024-01-01", "Shell", 1)]
    )
    assert rows(S.market_share_rows(df), "bandera", "market_share_pct") == [
        ("Shell", 25.0),
        ("YPF", 25.0),
        ("YPF", 50.0),
    ]
    assert rows(S.market_share_by_brand(df), "bandera", "market_share_pct") == [
        ("Shell", 25.0),
        ("YPF", 75.0),
    ]


def test_share_without_period_or_volume(spark):
    df = share_rows(
        spark,
        [(None, "a", 5), ("2024-01-01", "a", 0), ("2024-02-01", "a", None), ("2024-02-01", "b", 4)],
    )
    assert rows(S.market_share_rows(df)) == [
        (None, "a", 5, None),
        (day("2024-01-01"), "a", 0, None),
        (day("2024-02-01"), "a", None, None),
        (day("2024-02-01"), "b", 4, 100.0),
    ]
    with pytest.raises(ValueError, match="missing columns"):
        S.market_share_rows(df.drop("bandera"))


def test_share_totals_are_broadcast_only_where_the_type_bounds_them(spark):
    df = share_rows(spark, [("2024-01-01", "a", 1)])
    dated = S.market_share_rows(df)
    named = S.market_share_rows(df, group_by=["bandera"])

    def hinted(result):
        return "strategy=broadcast" in result._jdf.queryExecution().optimizedPlan().toString()

    assert hinted(dated)
    assert not hinted(named)
    assert rows(named, "bandera", "market_share_pct") == [("a", 100.0)]


def test_weighted_mean(spark):
    df = stations(
        spark,
        [
            ("2022-01-01", "P", "b", "A", 10.0, 1),
            ("2022-01-01", "P", "b", "A", 20.0, 3),
            ("2022-01-01", "P", "b", "A", None, 9),
            ("2022-01-01", "P", "b", "Z", 20.0, 0),
        ],
    )
    assert rows(A.weighted_mean_price(df), "producto", "precio_ponderado", "volumen_total") == [
        ("A", 17.5, 13.0),
        ("Z", None, 0.0),
    ]


def test_monthly_spread_skips_empty_months(spark):
    df = spark.createDataFrame(
        [(day("2025-01-01"), 1.0), (day("2025-01-02"), 2.005), (day("2025-03-01"), 4.0)],
        "date date, p double",
    )
    assert rows(A.monthly_spread(df, "p", "p")) == [
        (2025, 1, 1.5, 1.0, 2.0, 1.5),
        (2025, 3, 4.0, 4.0, 4.0, 4.0),
    ]


def test_fact_joins_feeds_on_the_month(spark):
    station = spark.createDataFrame(
        [(day("2025-01-01"), "A", 200.0, 1.0), (day("2025-02-01"), "A", 300.0, 1.0)],
        "periodo date, producto string, precio_surtidor_mediana double, volumen_total double",
    )
    oil = spark.createDataFrame(
        [(day("2025-01-31"), 80.0), (day("2025-02-28"), 90.0)], "date date, avg_brent_price double"
    )
    rates = spark.createDataFrame(
        [(day("2025-01-31"), 100.0, 110.0, 10.0)],
        "date date, usd_ars_oficial double, usd_ars_blue double, brecha_cambiaria_pct double",
    )
    fact = A.monthly_fact(station, oil, rates)
    assert rows(fact, "periodo", "avg_brent_price", "precio_usd") == [
        (day("2025-01-01"), 80.0, 2.0),
        (day("2025-02-01"), 90.0, None),
    ]
    assert math.isclose(A.fact_correlations(fact).first()["corr_oil"], 1.0)


def test_exchange_sources_match_whatever_their_case(spark):
    df = spark.createDataFrame(
        [("2025-01-01", "OFICIAL", 100.0), ("2025-01-02", "oficial", 200.0), ("2025-01-01", "BLUE", 300.0)],
        "date string, source string, value_sell double",
    ).selectExpr("to_date(date) AS date", "source", "value_sell")
    got = A.monthly_rates(df).first()
    assert (got["usd_ars_oficial"], got["usd_ars_blue"], got["brecha_cambiaria_pct"]) == (150.0, 300.0, 100.0)


def test_sources_outside_the_list_are_counted(spark):
    df = fx(spark, [("2022-01-01", "Oficial", 1.0), ("2022-01-01", "MEP", 2.0), ("2022-01-02", "mep", None), (None, None, 3.0)])
    assert rows(A.unlisted_sources(df)) == [(None, 1, 1), ("mep", 2, 1)]
    assert A.discover_sources(df) == ["mep", "oficial"]
    assert rows(A.daily_rates(df, A.discover_sources(df))) == [(day("2022-01-01"), 2.0, 1.0)]
    with pytest.raises(ValueError, match="more than 1 sources"):
        A.discover_sources(df, most=1)
