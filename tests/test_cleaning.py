import pytest
from conftest import day, rows

from quotemill.operators import cleaning as C

HEADER = ["Período", "Nº Inscripción", "Producto", "Precio Surtidor", "Volumen"]


def landed(spark, *data):
    return spark.createDataFrame(data, ", ".join(f"`{h}` string" for h in HEADER))


def test_chain(spark):
    raw = landed(
        spark,
        ("2025/01", "1", "GNC", "10.5", "3"),
        ("2025/01", "1", "GNC", "10.5", "3"),  # repeated
        ("2025/1", "2", "Nafta (premium) de más de 95 RON", "1.0", "x"),
        ("2024/12", "3", "gnc", "10", "1"),  # before the start
        ("2025-01", "4", "gnc", "10", "1"),  # no month
        ("2025/02", "5", "gnc", "0.99", "1"),  # below the floor
        ("2025/02", "6", "gnc", "0", "1"),
        ("2025/02", "7", "gnc", "s/d", "1"),  # no price
        ("2025/02", "8", " gnc", "10", "1"),  # unmapped
        ("2025/02", "9", "N/D", "10", "1"),
        ("2025/02", "10", None, "10", "1"),
        (None, None, None, None, None),
    )
    cleaned = C.clean_stations(raw)
    assert cleaned.columns == [
        "periodo",
        "no_inscripcion",
        "producto",
        "precio_surtidor",
        "volumen",
    ]
    assert rows(cleaned) == [
        (day("2025-01-01"), "1", "GNC", 10.5, 3.0),
        (day("2025-01-01"), "2", "NAFTA GRADO 3", 1.0, None),
    ]
    audit = C.cleaning_audit(raw)
    got = [
        (r["stage"], r["rows_in"], r["rows_out"], r["removed"], r["products"])
        for r in audit.orderBy("position").collect()
    ]
    assert got == [
        ("start date", 12, 9, 3, 5),
        ("null price", 9, 8, 1, 5),
        ("price floor", 8, 6, 2, 4),
        ("repeated rows", 6, 5, 1, 4),
        ("unmapped product", 5, 2, 3, 2),
    ]
    last = audit.where("position = 5").first()
    assert (last["first_month"], last["last_month"]) == (day("2025-01-01"), day("2025-01-01"))


def test_two_spellings_of_one_product_both_stay(spark):
    raw = landed(
        spark,
        ("2025/01", "1", "GNC", "10", "3"),
        ("2025/01", "1", "gnc", "10", "3"),
    )
    assert C.clean_stations(raw).count() == 2


def test_nothing_left_is_an_empty_result(spark):
    raw = landed(spark, ("2020/01", "1", "GNC", "10", "3"))
    assert C.clean_stations(raw).count() == 0
    assert [r["rows_out"] for r in C.cleaning_audit(raw).orderBy("position").collect()] == [0] * 5


def test_required_columns(spark):
    with pytest.raises(ValueError, match="precio_surtidor"):
        C.clean_stations(spark.createDataFrame([("2025/01", "x")], ["Periodo", "Producto"]))


def test_distinct_is_the_only_shuffle_and_filters_precede_it(spark):
    plan = (
        C.clean_stations(landed(spark, ("2025/01", "1", "GNC", "10", "3")))
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert plan.count("Exchange") == 1
    # nothing but the mapping itself is left above the distinct step
    assert "Filter" not in plan.split("Exchange")[0]


def test_oil_is_typed_strictly(spark):
    raw = spark.createDataFrame([("2025-01-02", "70.5"), (None, "NaN")], "date string, brent_price string")
    assert rows(C.clean_oil(raw)) == [(None, None), (day("2025-01-02"), 70.5)]
    broken = spark.createDataFrame([("2025-01-02", "7o")], "date string, brent_price string")
    with pytest.raises(Exception, match="brent_price"):
        C.clean_oil(broken).collect()


def test_fx_days_are_parsed_leniently(spark):
    raw = spark.createDataFrame(
        [("2025-01-02", "Blue", "1.5"), ("02/01/2025", "Blue", "x")],
        "date string, source string, value_sell string",
    )
    assert rows(C.clean_fx(raw)) == [(None, "Blue", None), (day("2025-01-02"), "Blue", 1.5)]


def test_product_report(spark):
    df = spark.createDataFrame([("GNC",), ("gnc",), ("N/D",), (None,), ("?",)], "producto string")
    assert rows(C.product_mapping_totals(df)) == [(4, 1, 3)]


def test_accumulation_audit(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "i int, s string")
    new = spark.createDataFrame([(2, "b"), (3, None), (3, None)], "i int, s string")
    assert rows(C.accumulation_audit(old, new)) == [(3, 3, 6, 3, 3)]


def test_numbers_are_compared_as_numbers(spark):
    raw = spark.createDataFrame(
        [("2025/01", "GNC", "10", "1"), ("2025/01", "GNC", "10.0", "1.00")],
        "periodo string, producto string, precio_surtidor string, iva string",
    )
    assert rows(C.clean_stations(raw)) == [(day("2025-01-01"), "GNC", 10.0, 1.0)]


def test_unreadable_numbers_are_told_apart_by_their_text(spark):
    raw = landed(
        spark,
        ("2025/01", "1", "GNC", "10", "s/d"),
        ("2025/01", "1", "GNC", "10", "n/c"),  # another text
        ("2025/01", "1", "GNC", "10", "s/d"),  # repeated
        ("2025/01", "2", "GNC", "10", "3"),
        ("2025/01", "2", "GNC", "10.0", "3.0"),  # repeated: equal numbers
    )
    cleaned = C.clean_stations(raw)
    assert [r["no_inscripcion"] for r in cleaned.collect()].count("1") == 2
    assert cleaned.count() == 3
    assert not [c for c in cleaned.columns if c.startswith("_")]
    audit = {r["stage"]: r["removed"] for r in C.cleaning_audit(raw).collect()}
    assert audit["repeated rows"] == 2
