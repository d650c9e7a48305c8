import gzip
import json

import pytest
from conftest import day, rows

from quotemill.functions.naming import normalize_columns
from quotemill.operators.profiling import file_counts
from quotemill.schemas import FX_SCHEMA
from quotemill.sources import feeds, files


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_cells_are_text_and_null_spellings_null(spark, tmp_path):
    path = put(tmp_path / "a.csv", "a,b,c\n01,NA,N/D\n,n/a,-\n")
    df = files.read_csv_text(spark, path)
    assert set(df.dtypes) == {("a", "string"), ("b", "string"), ("c", "string")}
    assert rows(df) == [(None, None, "-"), ("01", None, "N/D")]


def test_csv_with_given_columns(spark, tmp_path):
    path = put(tmp_path / "a.csv", "a,b\n1,2\n")
    assert rows(files.read_csv_text(spark, path, columns=["a", "b"])) == [("1", "2")]


def test_discovery_by_pattern_and_name(spark, tmp_path):
    put(tmp_path / "precios_PUBLIC_1.csv", "a\n1\n")
    put(tmp_path / "precios_interno.csv", "a\n2\n")
    put(tmp_path / "otros_public.csv", "a\n3\n")
    df = files.read_csv_text(
        spark, str(tmp_path), pattern=files.PRICE_FILE_PATTERN, name_contains="public"
    )
    assert rows(df) == [("1",)]


def test_columns_of_another_order_are_not_read_by_position(spark, tmp_path):
    put(tmp_path / "x" / "1.csv", "a,b\n1,2\n")
    put(tmp_path / "x" / "2.csv", "b,a\n3,4\n")
    with pytest.raises(Exception, match="CSV header"):
        files.read_csv_text(spark, str(tmp_path / "x")).collect()
    put(tmp_path / "y" / "1.csv", "a,b\n1,2\n")
    put(tmp_path / "z" / "2.csv", "b,c\n3,4\n")
    both = files.read_csv_layouts(spark, [str(tmp_path / "y"), str(tmp_path / "z")])
    assert rows(both, "a", "b", "c") == [(None, "3", "4"), ("1", "2", None)]


def test_unreadable_file_is_skipped_and_reported(spark, tmp_path):
    put(tmp_path / "good.csv", "a\n1\n2\n")
    whole = gzip.compress(b"a\n" + b"3\n" * 50000)
    (tmp_path / "bad.csv.gz").write_bytes(b"\x1f\x8b" + b"\x00" * 40)
    (tmp_path / "also.csv.gz").write_bytes(whole)
    df = files.read_csv_text(spark, str(tmp_path), columns=["a"], skip_unreadable=True)
    assert df.count() == 50002
    lost = [r["file"] for r in files.files_without_rows(df).collect()]
    assert len(lost) == 1 and lost[0].endswith("bad.csv.gz")


def test_file_counts(spark, tmp_path):
    put(tmp_path / "1.csv", "a,b\n1,2\n3,4\n")
    put(tmp_path / "2.csv", "a,b\n5,6\n")
    df = files.read_csv_text(spark, str(tmp_path))
    assert rows(file_counts(df)) == [("1.csv", 2, 2), ("2.csv", 1, 2)]
    assert files.with_file_name(df).where("a = '5'").first()["file_name"] == "2.csv"


def test_json_arrays_and_lines(spark, tmp_path):
    records = [
        {"date": "2025-01-02", "source": "Blue", "value_sell": 2.5, "value_buy": 2.0},
        {"date": "2025-01-01", "source": "Oficial", "value_sell": 1.5, "value_buy": None},
    ]
    array = put(tmp_path / "a.json", json.dumps(records, indent=1))
    lines = put(tmp_path / "l.json", "\n".join(json.dumps(r) for r in records))
    expected = [
        ("2025-01-01", "Oficial", 1.5, None),
        ("2025-01-02", "Blue", 2.5, 2.0),
    ]
    assert rows(files.read_json_records(spark, array, FX_SCHEMA)) == expected
    assert rows(files.read_json_records(spark, lines, FX_SCHEMA, json_lines=True)) == expected


def test_parquet_scan_prunes_and_nulls_nan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, float("nan")), (2, 1.0)], "a int, x double").write.parquet(path)
    df = files.read_parquet(spark, path, ["x"])
    assert rows(df) == [(None,), (1.0,)]
    assert "ReadSchema: struct<x:double>" in df._jdf.queryExecution().executedPlan().toString()


def test_oil_window_excludes_its_end(spark, tmp_path):
    path = put(
        tmp_path / "oil.csv",
        "Date,Open,Close\n2024-12-31,1,1\n2025-01-01,2,70.5\n2025-01-02,3,NA\n2025-01-03,4,72\n",
    )
    df = feeds.load_oil(spark, path, "2025-01-01", "2025-01-03")
    assert rows(df) == [(day("2025-01-01"), 70.5), (day("2025-01-02"), None)]


def test_empty_or_unreadable_feed(spark, tmp_path):
    path = put(tmp_path / "oil.csv", "Date,Close\n2020-01-01,1\n")
    with pytest.raises(ValueError, match="no oil quotes"):
        feeds.load_oil(spark, path)
    with pytest.raises(ValueError, match="cannot be read"):
        feeds.load_oil(spark, str(tmp_path / "nowhere.csv"))
    with pytest.raises(ValueError, match="cannot be read"):
        feeds.load_fx(spark, str(tmp_path / "nowhere.json"))
    with pytest.raises(ValueError, match="no records"):
        feeds.load_fx(spark, put(tmp_path / "fx.json", "[]"))
    with pytest.raises(FileNotFoundError):
        feeds.load_station_prices(spark, str(tmp_path / "nowhere"))


def test_fx_range_is_inclusive_and_sources_ignore_case(spark):
    raw = spark.createDataFrame(
        [
            ("2025-01-01", "Oficial"),
            ("2025-01-31", "BLUE"),
            ("2025-02-01", "Blue"),
            ("2025-01-05", "Otro"),
            ("2025-01-05", None),
        ],
        "date string, source string",
    )
    kept = feeds.fx_quotes(raw, "2025-01-01", "2025-01-31")
    assert rows(kept) == [(day("2025-01-01"), "Oficial"), (day("2025-01-31"), "BLUE")]
    assert feeds.fx_quotes(raw, "2025-01-01", "2025-01-31", sources=[]).count() == 4


def test_all_feeds_and_their_summary(spark, tmp_path):
    oil = put(tmp_path / "oil.csv", "Date,Close\n2025-01-01,70\n2025-01-02,80\n")
    fx = put(tmp_path / "fx.json", json.dumps([{"date": "2025-01-02", "source": "Blue", "value_sell": 5.0}]))
    put(
        tmp_path / "st" / "precios_1.csv",
        "Período,Producto,Provincia,Precio Surtidor\n2025/01,GNC,A,1\n2025/01,gnc,A,2\n2025/01,NA,B,2\n",
    )
    loaded = feeds.load_all(spark, oil, str(tmp_path / "st"), fx, end="2025-06-01")
    assert normalize_columns(loaded.stations).columns[0] == "periodo"
    summary = {r["feed"]: r.asDict() for r in loaded.summary().collect()}
    assert summary["oil"]["rows"] == 2 and summary["oil"]["mean_price"] == 75.0
    assert summary["fx"]["first_day"] == day("2025-01-02")
    assert (summary["stations"]["rows"], summary["stations"]["products"]) == (3, 2)
    assert summary["stations"]["provinces"] == 2


def test_surplus_cells_fail_and_short_rows_are_padded(spark, tmp_path):
    short = put(tmp_path / "short.csv", 'a,b\n1\n"x, ""y""",2\n')
    assert rows(files.read_csv_text(spark, short)) == [("1", None), ('x, "y"', "2")]
    path = put(tmp_path / "long.csv", "a,b\n1,2\n3,4,5,6\n")
    for df in (files.read_csv_text(spark, path), files.read_csv_text(spark, path).select("a")):
        with pytest.raises(Exception, match="more cells than its header: 3,4,5,6"):
            df.collect()


@pytest.mark.parametrize(
    "text, json_lines",
    [
        ('[{"date": "2025-01-01", "source": "Blue", "value_sell": 1.0}, {"date": ', False),
        ("<html><body>busy</body></html>", False),
        ('{"date": "2025-01-01", "source": "Blue", "value_sell": 1.0}\n{"date": \n', True),
        ('{"date": "2025-01-01", "source": "Blue", "value_sell": "x"}\n', True),
    ],
)
def test_damaged_exchange_feed(spark, tmp_path, text, json_lines):
    path = put(tmp_path / "fx.json", text)
    with pytest.raises(ValueError, match="cannot be read"):
        feeds.load_fx(spark, path, json_lines=json_lines)


def test_folder_of_differing_headers(spark, tmp_path):
    """An added column, another order, and a foreign file that is listed first."""
    put(tmp_path / "a_foreign_precios.csv", "this is,no,price,file\n1,2,3,4,5,6\n")
    put(tmp_path / "precios_public_1.csv", "a,b\n1,2\n")
    put(tmp_path / "precios_PUBLIC_2.csv", "b,a,c\n4,3,5\n")
    put(tmp_path / "precios_public_3.csv", 'a,"b"\n6,\n')
    got, report = files.read_csv_folder(spark, str(tmp_path), pattern="*.csv", name_contains="public")
    assert rows(got, "a", "b", "c") == [("1", "2", None), ("3", "4", "5"), ("6", None, None)]
    assert sorted(r.file.rsplit("/", 1)[1] for r in report.collect()) == [
        "precios_PUBLIC_2.csv", "precios_public_1.csv", "precios_public_3.csv"
    ]
    one = files.read_csv_text(spark, str(tmp_path), pattern="*.csv", name_contains="PUBLIC_2")
    assert one.columns == ["b", "a", "c"]
    with pytest.raises(FileNotFoundError, match="nowhere"):
        files.read_csv_text(spark, str(tmp_path), name_contains="nowhere")


def test_bad_files_are_left_out_whole(spark, tmp_path):
    """Half a gzip file, a surplus cell late in a file, text that is not UTF-8, an empty file."""
    whole = gzip.compress("\n".join(["a,b", *[f"{k},{k * 7919 % 1000003}" for k in range(60_000)]]).encode())
    (tmp_path / "half.csv.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "whole.csv.gz").write_bytes(whole)
    (tmp_path / "zeros.csv.gz").write_bytes(b"\x1f\x8b" + b"\x00" * 40)
    put(tmp_path / "good.csv", 'a,b\n1,"x, ""y"""\n2\n')
    put(tmp_path / "surplus.csv", "a,b\n" + "1,2\n" * 20_000 + "1,2,3\n")
    (tmp_path / "latin.csv").write_bytes("a,b\ncaf\xe9,1\n".encode("latin-1"))
    put(tmp_path / "empty.csv", "\n \n")
    put(tmp_path / "nothing.csv", "")
    got, report = files.read_csv_folder(spark, str(tmp_path), skip_unreadable=True)
    assert got.count() == 60_002
    state = {r.file.rsplit("/", 1)[1]: r for r in report.collect()}
    assert {name for name, r in state.items() if r.error is None} == {"whole.csv.gz", "good.csv"}
    assert (state["whole.csv.gz"].rows, state["good.csv"].rows) == (60_000, 2)
    assert state["empty.csv"].error == "empty"
    assert len(state) == 7
    with pytest.raises(ValueError, match="zeros.csv.gz"):
        files.read_csv_folder(spark, str(tmp_path))


def test_report_without_reading_whole_files(spark, tmp_path):
    put(tmp_path / "1.csv", "a,b\n1,2\n")
    (row,) = files.check_files(spark, str(tmp_path)).collect()
    assert (row.header, row.rows, row.error) == (["a", "b"], None, None)


def test_station_folder_with_an_added_column(spark, tmp_path):
    put(tmp_path / "precios_1.csv", "Período,Producto\n2025/01,GNC\n")
    put(tmp_path / "precios_2.csv", "Período,Producto,Provincia\n2025/02,GNC,A\n")
    (tmp_path / "precios_3.csv").write_bytes(b"Per\xedodo,Producto\n\xff,GNC\n")
    loaded, report = feeds.load_station_files(spark, str(tmp_path), skip_unreadable=True)
    assert rows(loaded) == [("2025/01", "GNC", None), ("2025/02", "GNC", "A")]
    assert report.where("error is not null").count() == 1


def test_surplus_cells_are_told_apart_by_the_parser(spark, tmp_path):
    """Empty surplus cells, commas in quotes, and a very long short row."""
    put(tmp_path / "1.csv", 'a,b,c\n"x,y"\n' + "z" * 200_000 + "\n")
    assert files.read_csv_text(spark, str(tmp_path)).count() == 2
    for text in ("1,2,3,\n", '1,2,3,""\n', "1,2,3,4,5\n", ",,,\n"):
        path = put(tmp_path / "bad" / "2.csv", "a,b,c\n" + text)
        with pytest.raises(Exception, match="more cells than its header"):
            files.read_csv_text(spark, path).collect()


def test_staged_parquet_lets_filters_reach_the_scan(spark, tmp_path):
    from quotemill.sinks.files import write_parquet

    path = str(tmp_path / "staged")
    data = [(1, float("nan"), 2.0), (2, 1.5, None), (3, 9.0, float("nan")), (4, None, 1.0)]
    write_parquet(spark.createDataFrame(data, "a int, x double, y float"), path)
    df = files.read_parquet(spark, path, staged=True)
    assert rows(df) == [(1, None, 2.0), (2, 1.5, None), (3, 9.0, None), (4, None, 1.0)]
    plan = df.where("x > 2")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,2.0)" in plan.split("PushedFilters")[1]
    assert rows(df.where("x > 2"), "a") == [(3,)]


def test_json_records_and_rejects(spark):
    from pyspark.sql import types as T

    texts = ['{"a": 1, "b": "x"}', '{"a": "no"}', "[1]", '[{"a": 1}]', "", "  ", None, "{}", '{"a": 1', "nonsense", '{"b": null, "c": 3}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    good, bad = files.parse_json_records(df, "t", schema)
    assert rows(good) == [(0, 1, "x"), (6, None, None), (7, None, None), (10, None, None)]
    assert [r[0] for r in rows(bad)] == [1, 2, 3, 4, 5, 8, 9]
    assert bad.columns == ["id", "t"]
