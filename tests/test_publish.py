import json
from decimal import Decimal

import pytest
from conftest import day, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.plans import pipelines
from quotemill.schemas import (
    ANALYTICS_FUEL,
    ANALYTICS_FX,
    STAGING_FUEL,
    STAGING_FX,
    STAGING_OIL,
    TABLES,
)
from quotemill.session import ensure_checkpoint_dir
from quotemill.sinks import files, tables
from quotemill.sources import feeds
from quotemill.sources.files import read_csv_text


@pytest.fixture
def database(spark):
    name = "pub"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def oil(spark, *data):
    return spark.createDataFrame([(day(d), p) for d, p in data], "date date, brent_price double")


def test_parquet_sink(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("a", 2), ("b", 1), ("a", 1)], "k string, n int")
    assert files.write_parquet(df, path, partition_by=["k"], sort_by=["n"], cluster=True) == 3
    assert rows(spark.read.parquet(path), "k", "n") == [("a", 1), ("a", 2), ("b", 1)]
    names = sorted(p.name for p in (tmp_path / "p").iterdir() if p.is_dir())
    assert names == ["k=a", "k=b"]
    assert all(".snappy." in f.name for f in (tmp_path / "p" / "k=a").glob("*.parquet"))
    assert files.write_parquet(df.limit(1), path) == 1
    assert spark.read.parquet(path).count() == 1


def test_csv_sink(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([("a", None), ("b", 1)], "k string, n int")
    assert files.write_csv(df, path) == 2
    assert files.write_csv(df.where("k = 'b'"), path) == 1
    assert rows(spark.read.option("header", True).csv(path)) == [("b", "1")]


def test_conform_selects_orders_and_types(spark):
    df = spark.createDataFrame(
        [("x", "31/12/99", 2.675, "P", "2025-01-01 10:00:00", 7)],
        "producto string, fecha_de_baja string, precio_surtidor double, provincia string, "
        "periodo string, interno int",
    ).withColumn("periodo", F.col("periodo").cast("timestamp"))
    relational = tables.conform(df, STAGING_FUEL)
    assert relational.columns == ["periodo", "provincia", "producto", "precio_surtidor"]
    assert rows(relational) == [(day("2025-01-01"), "P", "x", Decimal("2.68"))]
    warehouse = tables.conform(df, STAGING_FUEL, "warehouse")
    assert rows(warehouse) == [(day("2025-01-01"), None, "P", "x", 2.675)]
    assert dict(warehouse.dtypes)["fecha_de_baja"] == "date"
    other = tables.conform(df, None)
    assert other.columns == df.columns and dict(other.dtypes)["periodo"] == "date"


def test_tables_are_created_as_registered(spark, database):
    tables.create_tables(spark, database)
    assert {r["tableName"] for r in tables.list_tables(spark, database).collect()} == set(TABLES)
    described = tables.list_columns(spark, database, STAGING_FX).collect()
    assert ("value_sell", "decimal(10,2)") in [(r["col_name"], r["data_type"]) for r in described]
    tables.create_tables(spark, database, "warehouse")
    wide = spark.table(f"{database}.staging_fuel_prices")
    assert len(wide.columns) == 28 and wide.columns[-1] == "periodo"
    assert database in [r["namespace"] for r in tables.list_databases(spark).collect()]
    with pytest.raises(ValueError, match="does not exist"):
        tables.create_tables(spark, "no_such_database")


def test_version_rows_are_appended(spark, database):
    tables.record_version(spark, database)
    tables.record_version(spark, database, "1.1")
    assert rows(spark.table(f"{database}.db_info"), "version") == [("1.0",), ("1.1",)]


def test_refresh_and_upsert(spark, database):
    tables.create_tables(spark, database)
    name = f"{database}.staging_brent_price"

    def load(*data, **options):
        return tables.load_table(oil(spark, *data), database, STAGING_OIL, **options)

    def stored():
        return rows(spark.table(name), "date", "brent_price")

    assert load(("2025-01-01", 1.0), ("2025-01-02", 2.0)) == 2
    first = spark.table(name).agg(F.min("load_timestamp")).first()[0]
    assert first is not None
    # replaced
    assert load(("2025-01-02", 2.0), ("2025-01-03", 3.0)) == 2
    assert stored() == [
        (day("2025-01-02"), Decimal("2.00")),
        (day("2025-01-03"), Decimal("3.00")),
    ]
    # upserted, twice with the same outcome
    for _ in range(2):
        assert load(("2025-01-03", 4.0), ("2025-01-04", 5.0), truncate=False) == 2
        assert stored() == [
            (day("2025-01-02"), Decimal("2.00")),
            (day("2025-01-03"), Decimal("4.00")),
            (day("2025-01-04"), Decimal("5.00")),
        ]
    assert spark.table(name).where("date = '2025-01-03'").first()["load_timestamp"] > first
    # nothing to load: nothing changes
    assert tables.load_table(oil(spark).limit(0), database, STAGING_OIL) == 0
    assert len(stored()) == 3
    assert {r["tableName"] for r in tables.list_tables(spark, database).collect()} == set(TABLES)


def test_upsert_without_the_gap_column_keeps_the_gap(spark, database):
    tables.create_tables(spark, database)
    monthly = spark.createDataFrame(
        [(day("2025-01-31"), 100.0, 110.0, 10.0), (day("2025-02-28"), 100.0, 120.0, 20.0)],
        "date date, usd_ars_oficial double, usd_ars_blue double, brecha_cambiaria_pct double",
    )
    tables.load_table(monthly, database, ANALYTICS_FX)
    update = spark.createDataFrame(
        [(day("2025-02-28"), 101.0, 121.0), (day("2025-03-31"), 1.0, 2.0)],
        "date date, usd_ars_oficial double, usd_ars_blue double",
    )
    tables.load_table(update, database, ANALYTICS_FX, truncate=False)
    stored = rows(
        spark.table(f"{database}.analytics_usd_ars_rates_monthly"),
        "date",
        "usd_ars_oficial",
        "brecha_cambiaria_pct",
    )
    assert stored == [
        (day("2025-01-31"), Decimal("100.00"), Decimal("10.00")),
        (day("2025-02-28"), Decimal("101.00"), Decimal("20.00")),
        (day("2025-03-31"), Decimal("1.00"), None),
    ]


def test_broken_constraints_stop_the_load(spark, database):
    tables.create_tables(spark, database)
    with pytest.raises(ValueError, match="brent_price positive"):
        tables.load_table(oil(spark, ("2025-01-01", 0.0)), database, STAGING_OIL)
    with pytest.raises(ValueError, match="unique"):
        tables.load_table(
            oil(spark, ("2025-01-01", 1.0), ("2025-01-01", 2.0)), database, STAGING_OIL
        )
    assert spark.table(f"{database}.staging_brent_price").count() == 0
    skipped = tables.load_table(
        oil(spark, ("2025-01-01", 0.0)), database, STAGING_OIL, validate=False
    )
    assert skipped == 1


def fuel(spark, *data):
    return spark.createDataFrame(
        [(day(p), "A", product, price) for p, product, price in data],
        "periodo date, provincia string, producto string, precio_surtidor double",
    )


def test_partition_refresh_touches_only_its_months(spark, database):
    tables.create_tables(spark, database)
    name = f"{database}.staging_fuel_prices"
    tables.load_table(
        fuel(spark, ("2025-01-01", "GNC", 1.0), ("2025-02-01", "GNC", 2.0)), database, STAGING_FUEL
    )
    doubled = (
        spark.table(name)
        .where("periodo = '2025-02-01'")
        .withColumn("precio_surtidor", F.col("precio_surtidor") * 2)
    )
    assert tables.refresh_partitions(doubled, database, STAGING_FUEL) == 1
    assert rows(spark.table(name), "periodo", "precio_surtidor") == [
        (day("2025-01-01"), Decimal("1.00")),
        (day("2025-02-01"), Decimal("4.00")),
    ]
    assert ensure_checkpoint_dir(spark)


def test_refresh_of_a_partitioned_table_drops_old_months(spark, database):
    tables.create_tables(spark, database)

    def load(*data):
        tables.load_table(fuel(spark, *data), database, STAGING_FUEL)
        return rows(spark.table(f"{database}.staging_fuel_prices"), "periodo", "producto")

    load(("2025-01-01", "GNC", 1.0), ("2025-02-01", "GNC", 2.0))
    assert load(("2025-02-01", "KEROSENE", 2.0), ("2025-03-01", "GNC", 3.0)) == [
        (day("2025-02-01"), "KEROSENE"),
        (day("2025-03-01"), "GNC"),
    ]


def test_refresh_keeps_rows_without_month_and_drops_them_when_gone(spark, database):
    tables.create_tables(spark, database)

    def load(*months):
        data = spark.createDataFrame(
            [(m and day(m), "A", "GNC", 1.0) for m in months],
            "periodo date, provincia string, producto string, precio_surtidor double",
        )
        tables.load_table(data, database, STAGING_FUEL, validate=False)
        return {r["periodo"] for r in spark.table(f"{database}.staging_fuel_prices").collect()}

    for _ in range(2):
        assert load("2025-01-01", None) == {day("2025-01-01"), None}
    assert load("2025-01-01") == {day("2025-01-01")}


def test_append_to_a_table_without_key(spark, database):
    tables.create_tables(spark, database)
    one = fuel(spark, ("2025-01-01", "GNC", 1.0))
    assert tables.load_table(one, database, STAGING_FUEL) == 1
    assert tables.load_table(one, database, STAGING_FUEL, truncate=False) == 1
    assert spark.table(f"{database}.staging_fuel_prices").count() == 2


def test_whole_run_to_two_targets(spark, database, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS wh CASCADE")
    spark.sql("CREATE DATABASE wh")
    (tmp_path / "oil.csv").write_text("Date,Close\n2025-01-02,70\n2025-01-03,80\n")
    (tmp_path / "precios_public.csv").write_text(
        "Período,Bandera,Provincia,Producto,Precio Surtidor,Volumen,Fecha De Baja\n"
        "2025/01,YPF,A,GNC,10,30,x\n2025/01,YPF,A,GNC,10,30,x\n2025/1,Shell,B,gnc,20,10,\n"
        "2025/02,Shell,B,N/D,20,10,\n",
        encoding="utf-8",
    )
    (tmp_path / "fx.json").write_text(
        json.dumps(
            [
                {"date": "2025-01-02", "source": "Oficial", "value_sell": 100.0, "value_buy": 99.0},
                {"date": "2025-01-02", "source": "Blue", "value_sell": 120.0, "value_buy": 119.0},
            ]
        )
    )
    loaded = feeds.load_all(
        spark, str(tmp_path / "oil.csv"), str(tmp_path), str(tmp_path / "fx.json"), end="2025-06-01"
    )
    out = str(tmp_path / "processed")
    staged = (
        pipelines.run_oil(loaded.oil, out),
        pipelines.run_stations(loaded.stations, out),
        pipelines.run_fx(loaded.fx, out),
    )
    for target in (database, "wh"):
        tables.create_tables(spark, target, "warehouse" if target == "wh" else "relational")
    oil_part, fuel_part, fx_part = pipelines.staged_files(spark, out)
    assert rows(fuel_part.monthly) == rows(staged[1].monthly)
    counts = pipelines.publish(
        oil_part, fuel_part, fx_part, {database: "relational", "wh": "warehouse"}
    )
    expected = {
        "staging_brent_price": 2,
        "staging_fuel_prices": 2,
        "staging_usd_ars_rates": 2,
        "analytics_brent_prices_monthly": 1,
        "analytics_fuel_prices_monthly": 1,
        "analytics_usd_ars_rates_monthly": 1,
    }
    assert counts == {database: expected, "wh": expected}
    assert rows(
        spark.table(f"{database}.analytics_fuel_prices_monthly"),
        "periodo",
        "producto",
        "precio_surtidor_mediana",
        "volumen_total",
    ) == [(day("2025-01-01"), "GNC", Decimal("15.00"), Decimal("40.00"))]
    assert rows(spark.table("wh.staging_fuel_prices"), "bandera", "market_share_pct", "fecha_de_baja") == [
        ("Shell", 25.0, None),
        ("YPF", 75.0, None),
    ]
    gap = spark.table("wh.analytics_usd_ars_rates_monthly").first()["brecha_cambiaria_pct"]
    assert gap == 20.0
    spark.sql("DROP DATABASE wh CASCADE")


def test_pipelines_without_files(spark):
    raw = spark.createDataFrame(
        [("2025/01", "YPF", "GNC", "10", "5")],
        "periodo string, bandera string, producto string, precio_surtidor string, volumen string",
    )
    staged = pipelines.run_stations(raw, "unused", save_staging=False)
    assert rows(staged.monthly) == [(day("2025-01-01"), "GNC", 10.0, 5.0)]
    assert staged.cleaned.first()["market_share_pct"] == 100.0


def test_unknown_tables_are_refused(spark, database):
    with pytest.raises(ValueError, match="unknown tables"):
        tables.publish_all({"nope": oil(spark)}, {database: "relational"})


def test_registry_types(spark):
    assert STAGING_FX.type_of(STAGING_FX.fields[2], "relational") == T.DecimalType(10, 2)
    assert STAGING_FX.type_of(STAGING_FX.fields[2], "warehouse") == T.DoubleType()
    assert ANALYTICS_FUEL.columns == [
        "periodo",
        "producto",
        "precio_surtidor_mediana",
        "volumen_total",
    ]
    frame = spark.createDataFrame([(1,)], ["producto"])
    assert tables.published_columns(frame, "analytics_fuel_prices_monthly", "warehouse") == [
        "producto"
    ]


def test_csv_keeps_blanks_and_quotes(spark, tmp_path):
    path = str(tmp_path / "q")
    data = [(' gnc', 'Estación "La Paz", ruta 3'), ("a\\b ", "x")]
    files.write_csv(spark.createDataFrame(data, "k string, v string"), path)
    assert rows(read_csv_text(spark, path)) == sorted(data)


def test_unregistered_table_takes_every_column(spark, database):
    df = spark.createDataFrame([(1, "2025-01-02 10:00:00")], "a int, t string").withColumn(
        "t", F.col("t").cast("timestamp")
    )
    assert tables.load_unregistered(df, database, "extra") == 1
    assert tables.load_unregistered(df, database, "extra", truncate=False) == 1
    assert tables.load_unregistered(df.limit(0), database, "extra") == 0
    assert rows(spark.table(f"{database}.extra")) == [(1, day("2025-01-02"))] * 2


def test_accumulated_table(spark, database):
    def batch(*data):
        return spark.createDataFrame(data, "a string, b int")

    def run(*batches):
        return tables.accumulate_table(spark, database, "landed", batches)

    def stored():
        return rows(spark.table(f"{database}.landed"), "a", "b")

    assert not run()
    assert run(batch(("x", 1), ("x", 1), ("y", None)))
    assert stored() == [("x", 1), ("x", 1), ("y", None)]  # first run keeps repeats
    assert run(batch(("x", 1), ("z", 3)))
    assert stored() == [("x", 1), ("y", None), ("z", 3)]
    files_before = set(spark.table(f"{database}.landed").inputFiles())
    for _ in range(2):
        assert run(batch(("y", None), ("w", 4), ("w", 4)), batch(("z", 3)))
        assert stored() == [("w", 4), ("x", 1), ("y", None), ("z", 3)]
    assert files_before <= set(spark.table(f"{database}.landed").inputFiles())  # appended
    # a further column: rewritten, older rows get null
    wide = spark.createDataFrame([("v", 5, "new")], "a string, b int, c string")
    assert run(wide)
    assert rows(spark.table(f"{database}.landed"), "a", "b", "c") == [
        ("v", 5, "new"),
        ("w", 4, None),
        ("x", 1, None),
        ("y", None, None),
        ("z", 3, None),
    ]
    assert not run()


def test_first_accumulation_may_drop_repeats(spark, database):
    df = spark.createDataFrame([("x", 1), ("x", 1)], "a string, b int")
    tables.accumulate_table(spark, database, "once", [df], dedup_first=True)
    assert spark.table(f"{database}.once").count() == 1


def test_lost_replacement_is_finished_by_the_next_load(spark, database):
    tables.create_tables(spark, database)
    tables.load_table(oil(spark, ("2025-01-01", 1.0)), database, STAGING_OIL)
    name = f"{database}.staging_brent_price"
    # as if the job had stopped after the drop
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__next")
    tables.load_table(oil(spark, ("2025-01-02", 2.0)), database, STAGING_OIL, truncate=False)
    assert rows(spark.table(name), "date") == [(day("2025-01-01"),), (day("2025-01-02"),)]


def test_failed_refresh_leaves_the_old_content(spark, database):
    tables.create_tables(spark, database)
    tables.load_table(oil(spark, ("2025-01-01", 1.0)), database, STAGING_OIL)
    broken = oil(spark, ("2025-01-02", 2.0)).withColumn(
        "brent_price", F.when(F.col("brent_price") > 0, F.raise_error(F.lit("boom")).cast("double"))
    )
    with pytest.raises(Exception, match="boom"):
        tables.load_table(broken, database, STAGING_OIL, validate=False)
    assert rows(spark.table(f"{database}.staging_brent_price"), "date") == [(day("2025-01-01"),)]


@pytest.mark.parametrize(
    "rows, columns, message",
    [
        ([(day("2025-01-31"),)], "date date", "required columns absent"),
        ([("garbage", 1.0)], "date string, brent_price double", "date type"),
        ([(day("2025-01-31"), 0.001)], "date date, brent_price double", "positive|not null"),
    ],
)
def test_what_would_be_published_is_checked(spark, database, rows, columns, message):
    df = spark.createDataFrame(rows, columns)
    with pytest.raises(ValueError, match=message):
        tables.load_table(df, database, STAGING_OIL)


def evaluated(spark, df):
    """The data behind a step that counts the rows it hands on, and the counter."""
    counter = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), counter


@pytest.mark.parametrize("truncate", [True, False])
def test_a_load_evaluates_its_input_once(spark, database, truncate):
    tables.create_tables(spark, database)
    days = [(f"2025-01-{d:02d}", float(d)) for d in range(1, 21)]
    for table, df in (
        (STAGING_OIL, oil(spark, *days)),
        (STAGING_FUEL, fuel(spark, *[(d, "GNC", p) for d, p in days])),
    ):
        df, counter = evaluated(spark, df)
        assert tables.load_table(df, database, table, truncate=truncate) == 20
        assert counter.value == 20
        assert spark.table(f"{database}.{table.key}").count() == 20


def test_all_broken_rules_are_named_and_nothing_is_left(spark, database):
    tables.create_tables(spark, database)
    tables.load_table(oil(spark, ("2025-01-01", 1.0)), database, STAGING_OIL)
    folder = spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").first()[1]
    before = sorted(folders(folder))
    bad = spark.createDataFrame(
        [("2025-01-02", "0.001"), ("2025-01-02", "nan"), ("no day", "x"), (None, "1e12")], "date string, brent_price string"
    )
    with pytest.raises(ValueError) as error:
        tables.load_table(bad, database, STAGING_OIL)
    for rule in ("date not null", "date type", "brent_price type", "brent_price nan", "brent_price overflow",
                 "brent_price positive", "unique (date)"):
        assert rule in str(error.value)
    assert sorted(folders(folder)) == before
    assert rows(spark.table(f"{database}.staging_brent_price"), "date") == [(day("2025-01-01"),)]


def folders(location):
    from pathlib import Path

    return [p.name for p in Path(location.removeprefix("file:")).iterdir()]


def test_nan_is_not_published_into_the_warehouse(spark, database):
    tables.create_tables(spark, database, "warehouse")
    nan = oil(spark, ("2025-01-01", float("nan")))
    with pytest.raises(ValueError, match="brent_price nan"):
        tables.load_table(nan, database, STAGING_OIL, target="warehouse")
    tables.load_table(nan, database, STAGING_OIL, target="warehouse", validate=False)
    assert rows(spark.table(f"{database}.staging_brent_price"), "brent_price") == [(None,)]


@pytest.mark.parametrize("step", ["write", "pointer", "clean"])
def test_a_failure_at_any_step_leaves_old_or_new_content(spark, database, monkeypatch, step):
    """A refresh of a partitioned table with a stale month and a row without a month."""
    tables.create_tables(spark, database)

    def load(*months, **options):
        data = [(m and day(m), "A", "GNC", 1.0) for m in months]
        df = spark.createDataFrame(data, "periodo date, provincia string, producto string, precio_surtidor double")
        return tables.load_table(df, database, STAGING_FUEL, validate=False, **options)

    def stored():
        return {r["periodo"] for r in spark.table(f"{database}.staging_fuel_prices").collect()}

    def fail(*args):
        raise RuntimeError("lost")

    load("2025-01-01", "2025-02-01", None)
    old, new = {day("2025-01-01"), day("2025-02-01"), None}, {day("2025-02-01"), day("2025-03-01")}
    assert stored() == old
    name = {"write": "_write", "pointer": "point_to", "clean": "_delete_folder"}[step]
    with monkeypatch.context() as patch:
        patch.setattr(tables, name, fail)
        with pytest.raises(RuntimeError, match="lost"):
            load("2025-02-01", "2025-03-01")
    assert stored() == (new if step == "clean" else old)
    load("2025-02-01", "2025-03-01")
    assert stored() == new


def test_upsert_leaves_other_partitions_alone(spark, database):
    """Files of days that the batch does not touch keep their names and times."""
    from pathlib import Path

    field = STAGING_FX.fields
    quotes = type(STAGING_FX)("staging", "quotes", field, unique=("date", "source"), partition_by=("date",))
    tables.create_table(spark, database, quotes)

    def load(*data, truncate=False, columns="date date, source string, value_buy double, value_sell double"):
        df = spark.createDataFrame([(d and day(d), *rest) for d, *rest in data], columns)
        return tables.load_table(df, database, quotes, truncate=truncate, validate=False)

    def stored():
        return rows(spark.table(f"{database}.staging_quotes"), "date", "source", "value_buy", "value_sell")

    def files_of():
        paths = [Path(f.removeprefix("file:")) for f in spark.table(f"{database}.staging_quotes").inputFiles()]
        return {(str(p), p.stat().st_mtime_ns) for p in paths}

    load(("2025-01-01", "a", 1.0, 2.0), ("2025-01-02", "a", 1.0, 2.0), ("2025-01-03", "a", 1.0, 2.0), (None, "a", 1.0, 2.0), truncate=True)
    before = files_of()
    assert load(("2025-01-02", "a", 5.0, 6.0), ("2025-01-02", "b", 7.0, 8.0), ("2025-01-04", "a", 9.0, 9.0)) == 3
    assert len(before & files_of()) == 3
    one, two = Decimal("1.00"), Decimal("2.00")
    assert stored() == [
        (None, "a", one, two),
        (day("2025-01-01"), "a", one, two),
        (day("2025-01-02"), "a", Decimal("5.00"), Decimal("6.00")),
        (day("2025-01-02"), "b", Decimal("7.00"), Decimal("8.00")),
        (day("2025-01-03"), "a", one, two),
        (day("2025-01-04"), "a", Decimal("9.00"), Decimal("9.00")),
    ]
    # A column that the batch lacks keeps its value.
    load(("2025-01-01", "a", 3.0), columns="date date, source string, value_sell double")
    assert (day("2025-01-01"), "a", one, Decimal("3.00")) in stored()
    assert len(before & files_of()) == 2
