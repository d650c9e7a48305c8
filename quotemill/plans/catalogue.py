"""The query catalogue: each operator over the whole test tables, with its SQL twin.

The SQL is what an independent engine must answer. Sums and means of doubles are
rounded on both sides by one rule, because the order of addition changes their
last digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions import parsing as P
from quotemill.operators import aggregates as A
from quotemill.operators import cleaning as C
from quotemill.operators import combine as U
from quotemill.operators import listing as L
from quotemill.operators import profiling as R
from quotemill.operators import quality as V
from quotemill.operators import shares as S
from quotemill.operators import timegrid as G
from quotemill.plans import pipelines
from quotemill.plans.feeds_from_tables import (
    FX_SQL,
    OIL_SQL,
    RAW_STATIONS_SQL,
    STATIONS_SQL,
    fx,
    landed_fx,
    oil,
    raw_stations,
    stations,
    table,
)
from quotemill.schemas import STAGING_FUEL, STAGING_FX, STAGING_OIL
from quotemill.sinks.tables import conform
from quotemill.sources.feeds import fx_quotes, oil_quotes
from quotemill.sources.files import parse_json_records

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

START = "1996-01-01"


def query(sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


def r(column: str | Column, digits: int = 4) -> Column:
    """Half-to-even rounding of a value freed of the noise of double addition."""
    value = F.col(column) if isinstance(column, str) else column
    return P.round_half_even(F.round(value, digits + 4), digits)


def q(expression: str, digits: int = 4) -> str:
    """SQL twin of `r`."""
    return f"round_even(round({expression}, {digits + 4}) * 1e{digits}, 0) / 1e{digits}"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r(c) for c in columns})


# --- monthly means and statistics ------------------------------------------------

_OIL_MONTHLY = f"""
{OIL_SQL},
oil_months AS (
  SELECT last_day(date) AS date, avg(brent_price) AS avg_brent_price FROM oil GROUP BY 1),
oil_grid AS (
  SELECT last_day(CAST(unnest(generate_series(
           (SELECT date_trunc('month', min(date)) FROM oil),
           (SELECT date_trunc('month', max(date)) FROM oil), INTERVAL 1 MONTH)) AS DATE)) AS date),
oil_monthly AS (
  SELECT date, avg_brent_price FROM oil_grid LEFT JOIN oil_months USING (date))
"""


@query(
    f"WITH {_OIL_MONTHLY} SELECT date, {q("avg_brent_price")} AS avg_brent_price FROM oil_monthly"
)
def monthly_mean_filled(spark: SparkSession, sf: str) -> DataFrame:
    monthly = pipelines.oil_pipeline(oil(spark, sf)).monthly
    return rounded(monthly, "avg_brent_price")


@query(
    f"""WITH {OIL_SQL}
SELECT last_day(date) AS date, {q("avg(brent_price)")} AS oil_mean,
       {q("min(brent_price)")} AS oil_min, {q("max(brent_price)")} AS oil_max,
       {q("stddev_samp(brent_price)")} AS oil_stddev
FROM oil GROUP BY 1"""
)
def monthly_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = A.monthly_stats(oil(spark, sf), "brent_price", "oil")
    return rounded(stats, "oil_mean", "oil_min", "oil_max", "oil_stddev")


@query(
    f"""WITH {OIL_SQL}
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       {q("avg(brent_price)", 2)} AS oil_mean,
       {q("min(brent_price)", 2)} AS oil_min,
       {q("max(brent_price)", 2)} AS oil_max,
       {q("median(brent_price)", 2)} AS oil_median
FROM oil GROUP BY 1, 2"""
)
def monthly_stats_rounded(spark: SparkSession, sf: str) -> DataFrame:
    stats = A.monthly_spread(oil(spark, sf), "brent_price", "oil", digits=None)
    return stats.withColumns(
        {c: r(c, 2) for c in ("oil_mean", "oil_min", "oil_max", "oil_median")}
    )


# --- station prices --------------------------------------------------------------


@query(
    f"""WITH {STATIONS_SQL}
SELECT periodo, producto, {q("median(precio_surtidor)")} AS precio_surtidor_mediana,
       {q("coalesce(sum(volumen), 0)")} AS volumen_total
FROM stations GROUP BY 1, 2"""
)
def fuel_month_product(spark: SparkSession, sf: str) -> DataFrame:
    rows = stations(spark, sf, "periodo", "producto", "precio_surtidor", "volumen")
    return rounded(A.product_month(rows), "precio_surtidor_mediana", "volumen_total")


@query(
    f"""WITH {STATIONS_SQL}
SELECT periodo, provincia, bandera, producto,
       {q("median(precio_surtidor)")} AS precio_surtidor_mediana,
       {q("coalesce(sum(volumen), 0)")} AS volumen_total
FROM stations GROUP BY 1, 2, 3, 4"""
)
def fuel_four_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.product_month(
        stations(spark, sf), keys=("periodo", "provincia", "bandera", "producto")
    )
    return rounded(rows, "precio_surtidor_mediana", "volumen_total")


@query(
    f"""WITH {STATIONS_SQL}
SELECT periodo, provincia, bandera, producto, precio_surtidor, volumen,
       {q("volumen / nullif(sum(volumen) OVER (PARTITION BY periodo), 0) * 100", 6)}
         AS market_share_pct
FROM stations"""
)
def market_share_rows(spark: SparkSession, sf: str) -> DataFrame:
    shares = S.market_share_rows(stations(spark, sf))
    return shares.withColumn("market_share_pct", r("market_share_pct", 6))


@query(
    f"""WITH {STATIONS_SQL}
SELECT periodo, bandera, {q("sum(volumen)")} AS volumen_total,
       {q("sum(volumen) / nullif(sum(sum(volumen)) OVER (PARTITION BY periodo), 0) * 100", 6)}
         AS market_share_pct
FROM stations GROUP BY 1, 2"""
)
def market_share_by_brand(spark: SparkSession, sf: str) -> DataFrame:
    shares = S.market_share_by_brand(stations(spark, sf, "periodo", "bandera", "volumen"))
    return rounded(shares, "volumen_total").withColumn(
        "market_share_pct", r("market_share_pct", 6)
    )


@query(
    f"""WITH {STATIONS_SQL}
SELECT periodo, provincia, producto,
       {q("sum(precio_surtidor * volumen) / nullif(sum(volumen), 0)")} AS precio_ponderado,
       {q("coalesce(sum(volumen), 0)")} AS volumen_total
FROM stations GROUP BY 1, 2, 3"""
)
def weighted_mean_price(spark: SparkSession, sf: str) -> DataFrame:
    rows = stations(spark, sf, "periodo", "provincia", "producto", "precio_surtidor", "volumen")
    return rounded(A.weighted_mean_price(rows), "precio_ponderado", "volumen_total")


# --- exchange rates --------------------------------------------------------------

_FX_MONTHLY = f"""
{FX_SQL},
fx_daily AS (
  SELECT date,
         avg(CASE WHEN source = 'Oficial' THEN value_sell END) AS usd_ars_oficial,
         avg(CASE WHEN source = 'Blue' THEN value_sell END) AS usd_ars_blue
  FROM fx WHERE source IN ('Oficial', 'Blue') GROUP BY 1),
fx_months AS (
  SELECT last_day(date) AS date, avg(usd_ars_oficial) AS usd_ars_oficial,
         avg(usd_ars_blue) AS usd_ars_blue
  FROM fx_daily GROUP BY 1),
fx_grid AS (
  SELECT last_day(CAST(unnest(generate_series(
           (SELECT date_trunc('month', min(date)) FROM fx_daily),
           (SELECT date_trunc('month', max(date)) FROM fx_daily), INTERVAL 1 MONTH)) AS DATE))
         AS date),
fx_monthly AS (
  SELECT date, usd_ars_oficial, usd_ars_blue,
         (usd_ars_blue - usd_ars_oficial) / nullif(usd_ars_oficial, 0) * 100
           AS brecha_cambiaria_pct
  FROM fx_grid LEFT JOIN fx_months USING (date))
"""


@query(
    f"""WITH {FX_SQL}
SELECT lower(source) AS source, count(*) AS rows, count(value_sell) AS quotes
FROM fx WHERE lower(source) NOT IN ('oficial', 'blue') GROUP BY 1"""
)
def fx_unlisted(spark: SparkSession, sf: str) -> DataFrame:
    return A.unlisted_sources(fx(spark, sf))


@query(
    f"""WITH {FX_SQL}
SELECT date, {", ".join(f"{q(f"avg(value_sell) FILTER (source = '{s}')")} AS usd_ars_{s.lower()}" for s in ("Blue", "Oficial", "Otro"))}
FROM fx WHERE value_sell IS NOT NULL GROUP BY 1"""
)
def fx_open_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rates of whatever sources the feed holds."""
    quotes = fx(spark, sf)
    rates = A.daily_rates(quotes, A.discover_sources(quotes))
    return rounded(rates, *[c for c in rates.columns if c != "date"])


@query(
    f"""WITH {_FX_MONTHLY}
SELECT date, {q("usd_ars_oficial")} AS usd_ars_oficial, {q("usd_ars_blue")} AS usd_ars_blue
FROM fx_daily"""
)
def fx_daily_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.daily_rates(fx(spark, sf)), "usd_ars_oficial", "usd_ars_blue")


@query(
    f"""WITH {_FX_MONTHLY}
SELECT date, {q("usd_ars_oficial")} AS usd_ars_oficial, {q("usd_ars_blue")} AS usd_ars_blue,
       {q("brecha_cambiaria_pct")} AS brecha_cambiaria_pct
FROM fx_monthly"""
)
def fx_monthly_gap(spark: SparkSession, sf: str) -> DataFrame:
    monthly = pipelines.fx_pipeline(fx(spark, sf)).monthly
    return rounded(monthly, "usd_ars_oficial", "usd_ars_blue", "brecha_cambiaria_pct")


@query(
    f"""WITH {_FX_MONTHLY}
SELECT date, {q("usd_ars_blue")} AS usd_ars_blue, {q("usd_ars_oficial")} AS usd_ars_oficial,
       {q("brecha_cambiaria_pct")} AS brecha_cambiaria_pct
FROM fx_monthly ORDER BY date DESC LIMIT 12"""
)
def latest_gaps(spark: SparkSession, sf: str) -> DataFrame:
    monthly = L.latest(A.monthly_rates(fx(spark, sf)), 12, ["date"])
    return rounded(monthly, "usd_ars_oficial", "usd_ars_blue", "brecha_cambiaria_pct")


@query(
    f"""WITH {FX_SQL}
SELECT date, source, {q("value_sell")} AS value_sell, {q("value_buy")} AS value_buy
FROM fx
WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
  AND lower(source) IN ('oficial', 'blue')"""
)
def source_filter(spark: SparkSession, sf: str) -> DataFrame:
    quotes = fx_quotes(landed_fx(spark, sf), START, "2000-12-31", ["OFICIAL", "blue"])
    return rounded(quotes, "value_sell", "value_buy")


@query(
    """SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS brent_price FROM orders
WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '2000-12-31'"""
)
def oil_window(spark: SparkSession, sf: str) -> DataFrame:
    vendor = table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("Date"), F.col("o_totalprice").alias("Close")
    )
    return oil_quotes(vendor, START, "2000-12-31")


@query(
    f"""WITH {FX_SQL}
SELECT source, CAST(count(*) AS BIGINT) AS quotes FROM fx GROUP BY 1"""
)
def rows_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return R.value_counts(fx(spark, sf), "source", "quotes")


# --- cleaning --------------------------------------------------------------------

_CLEAN = f"""
{RAW_STATIONS_SQL},
kept AS (
  SELECT DISTINCT * FROM typed
  WHERE periodo >= DATE '{START}' AND precio_surtidor >= 1.0),
clean AS (
  SELECT * EXCLUDE (producto),
         CASE lower(producto)
           WHEN 'nafta (super) entre 92 y 95 ron' THEN 'NAFTA GRADO 2'
           WHEN 'nafta (premium) de más de 95 ron' THEN 'NAFTA GRADO 3'
           WHEN 'gas oil grado 2' THEN 'GASOIL GRADO 2'
           WHEN 'gnc' THEN 'GNC' END AS producto
  FROM kept)
"""


@query(
    f"""WITH {_CLEAN}
SELECT periodo, operador, no_inscripcion, bandera, provincia, producto, precio_surtidor, volumen,
       no_movimientos
FROM clean WHERE producto IS NOT NULL"""
)
def fuel_clean(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_stations(raw_stations(spark, sf), START)


@query(
    f"""WITH {_CLEAN}
SELECT periodo, producto, {q("median(precio_surtidor)")} AS precio_surtidor_mediana,
       {q("coalesce(sum(volumen), 0)")} AS volumen_total
FROM clean WHERE producto IS NOT NULL GROUP BY 1, 2"""
)
def fuel_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    monthly = pipelines.station_pipeline(raw_stations(spark, sf), START).monthly
    return rounded(monthly, "precio_surtidor_mediana", "volumen_total")


@query(
    f"""WITH {_CLEAN}
SELECT periodo, operador, no_inscripcion, bandera, provincia, producto, precio_surtidor, volumen,
       no_movimientos,
       {q("volumen / nullif(sum(volumen) OVER (PARTITION BY periodo), 0) * 100", 6)}
         AS market_share_pct
FROM clean WHERE producto IS NOT NULL"""
)
def fuel_staging(spark: SparkSession, sf: str) -> DataFrame:
    staged = pipelines.station_pipeline(raw_stations(spark, sf), START).cleaned
    return staged.withColumn("market_share_pct", r("market_share_pct", 6))


@query(
    f"""WITH {_CLEAN},
stages AS (
  SELECT 0 AS position, CAST(count(*) AS BIGINT) AS n, NULL AS first_month, NULL AS last_month,
         NULL AS products FROM typed
  UNION ALL
  SELECT 1, count(*), min(periodo), max(periodo), count(DISTINCT producto) FROM typed
  WHERE periodo >= DATE '{START}'
  UNION ALL
  SELECT 2, count(*), min(periodo), max(periodo), count(DISTINCT producto) FROM typed
  WHERE periodo >= DATE '{START}' AND precio_surtidor IS NOT NULL
  UNION ALL
  SELECT 3, count(*), min(periodo), max(periodo), count(DISTINCT producto) FROM typed
  WHERE periodo >= DATE '{START}' AND precio_surtidor >= 1.0
  UNION ALL
  SELECT 4, count(*), min(periodo), max(periodo), count(DISTINCT producto) FROM kept
  UNION ALL
  SELECT 5, count(*), min(periodo), max(periodo), count(DISTINCT producto) FROM clean
  WHERE producto IS NOT NULL)
SELECT b.position,
       CASE b.position WHEN 1 THEN 'start date' WHEN 2 THEN 'null price' WHEN 3 THEN 'price floor'
            WHEN 4 THEN 'repeated rows' ELSE 'unmapped product' END AS stage,
       a.n AS rows_in, b.n AS rows_out, a.n - b.n AS removed,
       b.first_month, b.last_month, b.products
FROM stages a JOIN stages b ON b.position = a.position + 1"""
)
def cleaning_audit(spark: SparkSession, sf: str) -> DataFrame:
    return C.cleaning_audit(raw_stations(spark, sf), START)


@query(
    f"""WITH {RAW_STATIONS_SQL}
SELECT periodo_texto AS texto, CAST(try_strptime(periodo_texto, '%Y/%m') AS DATE) AS periodo,
       CAST(count(*) AS BIGINT) AS n
FROM raw GROUP BY 1, 2"""
)
def parse_month_lenient(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_stations(spark, sf).withColumnRenamed("Período", "texto")
    counts = raw.groupBy("texto").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("texto", P.parse_month("texto").alias("periodo"), "n")


_DAY_TEXT = """
CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y/%m/%d')
     WHEN '2-HIGH' THEN CAST(year(o_orderdate) AS VARCHAR) || '-' ||
          CAST(month(o_orderdate) AS VARCHAR) || '-' || CAST(day(o_orderdate) AS VARCHAR)
     WHEN '5-LOW' THEN strftime(o_orderdate, '%Y-%m')
     ELSE strftime(o_orderdate, '%Y-%m-%d') END
"""


@query(
    f"""SELECT o_orderkey, {_DAY_TEXT} AS texto,
       CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '5-LOW' THEN NULL
            ELSE CAST(o_orderdate AS DATE) END AS date
FROM orders"""
)
def parse_day_lenient(spark: SparkSession, sf: str) -> DataFrame:
    day, kind = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(kind == "1-URGENT", F.date_format(day, "yyyy/MM/dd"))
        .when(kind == "2-HIGH", F.date_format(day, "yyyy-M-d"))
        .when(kind == "5-LOW", F.date_format(day, "yyyy-MM"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    rows = table(spark, sf, "orders").select("o_orderkey", text.alias("texto"))
    return rows.withColumn("date", P.parse_day("texto"))


_NUMBER_TEXT = """
CASE event_type WHEN 'click' THEN CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)
     WHEN 'view' THEN ' ' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ' '
     WHEN 'purchase' THEN replace(CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), '.', ',')
     WHEN 'signup' THEN CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || 'd'
     ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || 'e1' END
"""


@query(
    f"""SELECT event_id, {_NUMBER_TEXT} AS texto,
       CASE event_type WHEN 'purchase' THEN NULL WHEN 'signup' THEN NULL
            ELSE TRY_CAST(trim({_NUMBER_TEXT}) AS DOUBLE) END AS valor
FROM events"""
)
def parse_number_lenient(spark: SparkSession, sf: str) -> DataFrame:
    plain, kind = F.col("value").cast("decimal(12,2)").cast("string"), F.col("event_type")
    text = (
        F.when(kind == "click", plain)
        .when(kind == "view", F.concat(F.lit(" "), plain, F.lit(" ")))
        .when(kind == "purchase", F.replace(plain, F.lit("."), F.lit(",")))
        .when(kind == "signup", F.concat(plain, F.lit("d")))
        .otherwise(F.concat(plain, F.lit("e1")))
    )
    rows = table(spark, sf, "events").select("event_id", text.alias("texto"))
    return rows.withColumn("valor", P.parse_number("texto"))


_MAPPING = """
CASE lower(producto_texto) WHEN 'nafta (super) entre 92 y 95 ron' THEN 'NAFTA GRADO 2'
     WHEN 'nafta (premium) de más de 95 ron' THEN 'NAFTA GRADO 3'
     WHEN 'gas oil grado 2' THEN 'GASOIL GRADO 2' WHEN 'gnc' THEN 'GNC' END
"""


@query(
    f"""WITH {RAW_STATIONS_SQL}
SELECT producto_texto AS producto, CAST(count(*) AS BIGINT) AS rows, {_MAPPING} AS mapped
FROM raw GROUP BY 1, 3"""
)
def product_map(spark: SparkSession, sf: str) -> DataFrame:
    return C.product_mapping(C.normalize_columns(raw_stations(spark, sf)))


@query(
    f"""WITH {RAW_STATIONS_SQL}
SELECT count(DISTINCT producto_texto) AS products_before,
       count(DISTINCT {_MAPPING}) AS products_after,
       CAST(count(*) FILTER ({_MAPPING} IS NULL) AS BIGINT) AS rows_unmapped
FROM raw"""
)
def product_map_totals(spark: SparkSession, sf: str) -> DataFrame:
    return C.product_mapping_totals(C.normalize_columns(raw_stations(spark, sf)))


@query(
    f"""WITH {STATIONS_SQL}
SELECT periodo, producto, precio_surtidor, volumen FROM stations
WHERE periodo >= DATE '{START}' AND precio_surtidor >= 30000.0"""
)
def price_floor(spark: SparkSession, sf: str) -> DataFrame:
    rows = stations(spark, sf, "periodo", "producto", "precio_surtidor", "volumen")
    return rows.where(C.from_month(START) & C.price_at_least(30000.0)).dropna(
        subset=["periodo", "precio_surtidor"]
    )


@query(
    """SELECT event_id,
       CASE event_type WHEN 'purchase' THEN 'N/D' WHEN 'signup' THEN '-'
            WHEN 'click' THEN event_type END AS celda
FROM events"""
)
def null_tokens(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    cell = (
        F.when(kind == "view", "NA")
        .when(kind == "error", "n/a")
        .when(kind == "purchase", "N/D")
        .when(kind == "signup", "-")
        .otherwise(kind)
    )
    return P.null_tokens(table(spark, sf, "events").select("event_id", cell.alias("celda")))


# --- calendar --------------------------------------------------------------------

_DAYS = f"""
{FX_SQL},
days AS (SELECT DISTINCT source, date FROM fx),
bounds AS (SELECT source, min(date) AS lo, max(date) AS hi FROM days GROUP BY 1),
span AS (
  SELECT source, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
missing AS (
  SELECT source, date FROM span ANTI JOIN days USING (source, date) WHERE isodow(date) < 6)
"""


@query(f"WITH {_DAYS} SELECT source, date FROM missing")
def business_day_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return G.missing_business_days(fx(spark, sf), series=["source"])


@query(
    f"WITH {_DAYS} SELECT source, dayname(date) AS day_name, CAST(count(*) AS BIGINT) AS days "
    "FROM missing GROUP BY 1, 2"
)
def missing_weekdays(spark: SparkSession, sf: str) -> DataFrame:
    missing = G.missing_business_days(fx(spark, sf), series=["source"])
    return G.weekday_histogram(missing, series=["source"])


@query(f"WITH {_DAYS} SELECT source, date FROM missing ORDER BY date, source LIMIT 10")
def first_missing_days(spark: SparkSession, sf: str) -> DataFrame:
    missing = G.missing_business_days(fx(spark, sf), series=["source"])
    return L.earliest(missing, 10, ["date", "source"])


@query(
    f"""WITH {_DAYS}
SELECT source, lo AS first_day, hi AS last_day,
       (SELECT CAST(count(*) AS BIGINT) FROM fx WHERE fx.source = bounds.source) AS rows,
       (SELECT CAST(count(*) AS BIGINT) FROM days WHERE days.source = bounds.source)
         AS observed_days,
       (SELECT CAST(count(*) AS BIGINT) FROM missing WHERE missing.source = bounds.source)
         AS missing_days,
       (SELECT CAST(count(*) AS BIGINT) FROM span
        WHERE span.source = bounds.source AND isodow(date) < 6) AS expected_days
FROM bounds"""
)
def business_day_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return G.business_day_coverage(fx(spark, sf), series=["source"])


@query(
    f"""WITH {FX_SQL},
steps AS (
  SELECT source, date_diff('day', lag(date) OVER (PARTITION BY source ORDER BY date), date)
           AS gap_days
  FROM fx)
SELECT source, CAST(gap_days AS INTEGER) AS gap_days, CAST(count(*) AS BIGINT) AS occurrences
FROM steps WHERE gap_days IS NOT NULL GROUP BY 1, 2"""
)
def gap_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return G.gap_distribution(fx(spark, sf), series=["source"])


@query(
    """WITH steps AS (
  SELECT o_custkey, date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER (
           PARTITION BY o_custkey ORDER BY o_orderdate), CAST(o_orderdate AS DATE)) AS gap_days
  FROM orders)
SELECT o_custkey, CAST(gap_days AS INTEGER) AS gap_days, CAST(count(*) AS BIGINT) AS occurrences
FROM steps WHERE gap_days IS NOT NULL GROUP BY 1, 2"""
)
def gap_distribution_by_series(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("date")
    )
    return G.gap_distribution(rows, series=["o_custkey"])


@query(
    f"""WITH rows AS (
  SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         avg(l_extendedprice) AS mean_price
  FROM lineitem GROUP BY 1, 2),
bounds AS (SELECT l_suppkey, min(date) AS lo, max(date) AS hi FROM rows GROUP BY 1),
grid AS (
  SELECT l_suppkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS date
  FROM bounds)
SELECT l_suppkey, last_day(date) AS date, {q("mean_price")} AS mean_price
FROM grid LEFT JOIN rows USING (l_suppkey, date)"""
)
def monthly_mean_by_series(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey", F.col("l_shipdate").cast("date").alias("date"), "l_extendedprice"
    )
    monthly = G.monthly_mean(rows, "l_extendedprice", "mean_price", series=["l_suppkey"])
    return rounded(monthly, "mean_price")


# --- profiling -------------------------------------------------------------------


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY 1")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.value_counts(table(spark, sf, "events"), "event_type")


@query(
    f"""WITH {OIL_SQL}, {FX_SQL}, {STATIONS_SQL}
SELECT 'oil' AS feed, CAST(count(*) AS BIGINT) AS rows, min(date) AS first_day,
       max(date) AS last_day, {q("avg(brent_price)")} AS mean_price,
       CAST(NULL AS BIGINT) AS products, CAST(NULL AS BIGINT) AS provinces FROM oil
UNION ALL
SELECT 'stations', count(*), min(periodo), max(periodo), {q("avg(precio_surtidor)")},
       count(DISTINCT producto), count(DISTINCT provincia) FROM stations
UNION ALL
SELECT 'fx', count(*), min(date), max(date), {q("avg(value_sell)")}, NULL, NULL FROM fx"""
)
def feed_summary(spark: SparkSession, sf: str) -> DataFrame:
    station_rows = stations(spark, sf, "periodo", "provincia", "producto", "precio_surtidor")
    summary = (
        R.feed_summary(oil(spark, sf), "oil", date="date", price="brent_price")
        .unionByName(
            R.feed_summary(
                station_rows,
                "stations",
                date="periodo",
                price="precio_surtidor",
                distinct=["producto", "provincia"],
            )
        )
        .unionByName(R.feed_summary(fx(spark, sf), "fx", date="date", price="value_sell"))
    )
    return rounded(summary, "mean_price")


@query(
    """SELECT CAST((SELECT count(*) FROM orders) * 2 + (SELECT count(*) FROM lineitem) AS BIGINT)
       AS total_rows"""
)
def feed_total(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        R.feed_summary(oil(spark, sf), "oil"),
        R.feed_summary(stations(spark, sf, "periodo"), "stations"),
        R.feed_summary(fx(spark, sf), "fx"),
    ]
    return R.grand_total(U.concat_batches(parts))


@query(f"WITH {OIL_SQL} SELECT {q("avg(brent_price)")} AS mean FROM oil")
def series_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.series_mean(oil(spark, sf), "brent_price"), "mean")


_LABELLED = """
labelled AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""
_LABELLED_COLUMNS = {
    "doc_id": "bigint",
    "lang": "string",
    "source": "string",
    "n_chars": "bigint",
    "quality": "int",
    "toxic": "int",
}


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf, "labels"), "doc_id", "left")


@query(
    f"WITH {_LABELLED} "
    + " UNION ALL ".join(
        f'SELECT \'{c}\' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM labelled'
        for c in _LABELLED_COLUMNS
    )
)
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.null_counts(_labelled(spark, sf))


@query(
    f"WITH {_LABELLED} "
    + " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", '{kind}' AS type,
        CAST(count({c}) AS BIGINT) AS non_null, CAST(count(*) AS BIGINT) AS rows FROM labelled"""
        for i, (c, kind) in enumerate(_LABELLED_COLUMNS.items())
    )
)
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return R.column_profile(_labelled(spark, sf))


@query(
    f"""WITH {RAW_STATIONS_SQL}
SELECT CAST((SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))
       AS BIGINT) AS duplicates"""
)
def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return R.duplicate_count(raw_stations(spark, sf))


@query(
    f"""WITH {OIL_SQL}
SELECT CAST(count(*) - count(DISTINCT date) AS BIGINT) AS duplicates FROM oil"""
)
def duplicate_dates(spark: SparkSession, sf: str) -> DataFrame:
    return R.duplicate_count(oil(spark, sf), ["date"])


@query(f"WITH {RAW_STATIONS_SQL} SELECT DISTINCT producto_texto AS producto FROM raw ORDER BY 1")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return R.distinct_values(C.normalize_columns(raw_stations(spark, sf)), "producto")


@query(
    """WITH counts AS (
  SELECT strftime(ts, '%Y-%m-%d') AS batch, CAST(count(*) AS BIGINT) AS rows, 6 AS columns
  FROM events GROUP BY 1)
SELECT * FROM counts
UNION ALL SELECT 'TOTAL', CAST(sum(rows) AS BIGINT), max(columns) FROM counts"""
)
def rows_per_batch(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return R.with_grand_total(R.rows_per_batch(events, F.date_format("ts", "yyyy-MM-dd")))


# --- union, accumulation, upsert ---------------------------------------------------

_HALVES = """
older AS (SELECT event_id, user_id, event_type, value FROM events WHERE day(ts) <= 20),
newer AS (SELECT event_id, user_id, event_type, value FROM events WHERE day(ts) > 10)
"""


def _overlapping(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two landings that share some days and together hold the whole table."""
    events = table(spark, sf, "events")
    columns = ["event_id", "user_id", "event_type", "value"]
    day = F.dayofmonth("ts")
    return events.where(day <= 20).select(columns), events.where(day > 10).select(columns)


@query(f"WITH {_HALVES} SELECT * FROM older UNION SELECT * FROM newer")
def accumulate_distinct(spark: SparkSession, sf: str) -> DataFrame:
    older, newer = _overlapping(spark, sf)
    return U.accumulate(older, [newer])


@query(f"WITH {_HALVES} SELECT * FROM newer EXCEPT SELECT * FROM older")
def accumulate_unseen(spark: SparkSession, sf: str) -> DataFrame:
    older, newer = _overlapping(spark, sf)
    return U.unseen_rows(older, [newer])


@query(
    f"""WITH {_HALVES},
sizes AS (
  SELECT (SELECT count(*) FROM older) AS a, (SELECT count(*) FROM newer) AS b,
         (SELECT count(*) FROM (SELECT * FROM older UNION SELECT * FROM newer)) AS c)
SELECT CAST(a AS BIGINT) AS rows_existing, CAST(b AS BIGINT) AS rows_new,
       CAST(a + b AS BIGINT) AS rows_combined, CAST(a + b - c AS BIGINT) AS removed,
       CAST(c AS BIGINT) AS rows_left
FROM sizes"""
)
def accumulation_audit(spark: SparkSession, sf: str) -> DataFrame:
    return C.accumulation_audit(*_overlapping(spark, sf))


@query(
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL AS segment FROM customer
UNION ALL BY NAME SELECT s_suppkey AS id, s_acctbal AS balance, s_name AS name FROM supplier
UNION ALL BY NAME SELECT c_mktsegment AS segment, c_custkey AS id FROM customer"""
)
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    return U.concat_batches(
        [
            customer.selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance"),
            supplier.selectExpr("s_suppkey AS id", "s_acctbal AS balance", "s_name AS name"),
            customer.selectExpr("c_mktsegment AS segment", "c_custkey AS id"),
        ]
    )


_UPSERT = """
target AS (
  SELECT o_custkey AS id, CAST(count(*) AS BIGINT) AS orders, round(max(o_totalprice), 2) AS top
  FROM orders WHERE o_orderdate < DATE '1998-06-01' GROUP BY 1),
batch AS (
  SELECT o_custkey AS id, o_orderkey, 0 - o_orderkey AS orders, round(o_totalprice, 2) AS top
  FROM orders WHERE o_orderdate >= DATE '1998-06-01'),
winners AS (
  SELECT id, orders, top, o_orderkey FROM batch
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey DESC) = 1)
"""


def _upsert_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")
    top = F.round("o_totalprice", 2)
    cut = F.lit("1998-06-01").cast("timestamp_ntz")
    target = (
        orders.where(F.col("o_orderdate") < cut)
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(
            F.count(F.lit(1)).alias("orders"), F.round(F.max("o_totalprice"), 2).alias("top")
        )
    )
    batch = orders.where(F.col("o_orderdate") >= cut).select(
        F.col("o_custkey").alias("id"),
        "o_orderkey",
        (-F.col("o_orderkey")).alias("orders"),
        top.alias("top"),
    )
    return target, batch


@query(
    f"""WITH {_UPSERT}
SELECT * FROM target WHERE id NOT IN (SELECT id FROM winners)
UNION ALL SELECT id, orders, top FROM winners"""
)
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    target, batch = _upsert_sides(spark, sf)
    return U.upsert(target, batch, ["id"], on_duplicate="last", order_by="o_orderkey")


@query(
    f"""WITH {_UPSERT}
SELECT coalesce(t.id, w.id) AS id, t.orders AS orders,
       CASE WHEN w.id IS NULL THEN t.top ELSE w.top END AS top
FROM target t FULL JOIN winners w ON t.id = w.id"""
)
def upsert_column_subset(spark: SparkSession, sf: str) -> DataFrame:
    target, batch = _upsert_sides(spark, sf)
    return U.upsert_columns(
        target, batch.drop("orders"), ["id"], on_duplicate="last", order_by="o_orderkey"
    )


# --- publishing --------------------------------------------------------------------


@query(
    f"""WITH {STATIONS_SQL}
SELECT periodo, bandera, CAST(NULL AS DATE) AS fecha_de_baja, provincia, producto, volumen,
       precio_surtidor
FROM stations"""
)
def whitelist_projection(spark: SparkSession, sf: str) -> DataFrame:
    raw = stations(spark, sf).withColumns(
        {
            "periodo": F.col("periodo").cast("timestamp"),
            "fecha_de_baja": F.lit("31/12/99 s/d"),
            "interno": F.col("volumen") * 2,
        }
    )
    return conform(raw, STAGING_FUEL, "warehouse")


@query(
    f"""WITH {OIL_SQL}
SELECT date, CAST(brent_price AS DECIMAL(10,2)) AS brent_price FROM oil"""
)
def typed_publish(spark: SparkSession, sf: str) -> DataFrame:
    return conform(oil(spark, sf), STAGING_OIL)


_FX_CHECKED = """
checked AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN 'no day' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS date,
         CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN 'a source name far too long'
              ELSE event_type END AS source,
         CASE WHEN event_id % 89 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value * 1000000 END AS value_buy,
         value - 1 AS value_sell
  FROM events)
"""
# The rules in the order of the table's columns, as SQL conditions.
_FX_RULES = {
    "date not null": "date IS NULL",
    "date type": "date IS NOT NULL AND TRY_CAST(date AS DATE) IS NULL",
    "source not null": "source IS NULL",
    "source length": "length(source) > 20",
    "value_buy nan": "isnan(value_buy)",
    "value_buy overflow": "NOT isnan(value_buy) AND abs(round(value_buy, 2)) >= 1e8",
    "value_sell not null": "value_sell IS NULL",
    "value_sell positive": "value_sell <= 0",
    "value_sell nan": "isnan(value_sell)",
    "value_sell overflow": "NOT isnan(value_sell) AND abs(round(value_sell, 2)) >= 1e8",
}


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.when(F.col("event_id") % 97 == 0, "no day")
        .otherwise(F.col("ts").cast("date").cast("string"))
        .alias("date"),
        F.when(kind == "error", None)
        .when(kind == "signup", "a source name far too long")
        .otherwise(kind)
        .alias("source"),
        F.when(F.col("event_id") % 89 == 0, float("nan"))
        .otherwise(F.col("value") * 1000000)
        .alias("value_buy"),
        (F.col("value") - 1).alias("value_sell"),
    )


@query(
    f"""WITH {_FX_CHECKED}, rules AS (
  {" UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER ({c}) AS n FROM checked" for n, c in _FX_RULES.items())}
  UNION ALL SELECT 'unique (date, source)', count(*) - count(DISTINCT (date, source))
    FROM checked WHERE source IS NOT NULL)
SELECT 'staging_usd_ars_rates' AS "table", rule, CAST(n AS BIGINT) AS violations FROM rules"""
)
def constraint_report(spark: SparkSession, sf: str) -> DataFrame:
    return V.constraint_report(_checked(spark, sf), STAGING_FX)


@query(
    f"""WITH {_FX_CHECKED}
SELECT date, source, value_buy, value_sell,
       concat_ws('; ', {", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _FX_RULES.items())}) AS violations
FROM checked
WHERE {" OR ".join(f"coalesce({c}, false)" for c in _FX_RULES.values())}"""
)
def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = V.split_valid(_checked(spark, sf), STAGING_FX)
    return rejected.withColumn("violations", F.array_join("violations", "; "))


# --- JSON records -------------------------------------------------------------------

# Texts as they might land: cut off, of a wrong type, an array, blank, null, or whole.
_LANDED_JSON = """
landed AS (
  SELECT event_id, CASE event_id % 13 WHEN 1 THEN left(props, 5) WHEN 2 THEN '{"k": "many"}'
         WHEN 3 THEN '[' || props || ']' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN '{}'
         ELSE props END AS props
  FROM events),
readable AS (
  SELECT event_id, props, props IS NULL OR CASE WHEN json_valid(props) AND left(props, 1) = '{'
         THEN coalesce(json_type(props, '$.k') IN ('UBIGINT', 'BIGINT'), true) ELSE false END AS fits
  FROM landed)
"""


def _landed_json(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    props, kind = F.col("props"), F.col("event_id") % 13
    landed = table(spark, sf, "events").select(
        "event_id",
        F.when(kind == 1, F.substring(props, 1, 5))
        .when(kind == 2, '{"k": "many"}')
        .when(kind == 3, F.concat(F.lit("["), props, F.lit("]")))
        .when(kind == 4, "")
        .when(kind == 5, None)
        .when(kind == 6, "{}")
        .otherwise(props)
        .alias("props"),
    )
    return parse_json_records(landed, "props", T.StructType([T.StructField("k", T.LongType())]))


@query(
    f"""WITH {_LANDED_JSON}
SELECT event_id, CAST(json_extract(CASE WHEN fits THEN props END, '$.k') AS BIGINT) AS k FROM readable WHERE fits"""
)
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    return _landed_json(spark, sf)[0]


@query(f"WITH {_LANDED_JSON} SELECT event_id, props FROM readable WHERE NOT fits")
def json_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return _landed_json(spark, sf)[1]


# --- listings ----------------------------------------------------------------------


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS brent_price
FROM orders ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC LIMIT 10"""
)
def latest_n(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("brent_price"),
    )
    return L.latest(rows, 10, ["date", "o_orderkey"])


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS brent_price
FROM orders ORDER BY CAST(o_orderdate AS DATE), o_orderkey LIMIT 5"""
)
def earliest_n(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("brent_price"),
    )
    return L.earliest(rows, 5, ["date", "o_orderkey"])


@query(
    f"""WITH {STATIONS_SQL},
priced AS (
  SELECT periodo, provincia, producto,
         sum(precio_surtidor * volumen) / nullif(sum(volumen), 0) AS precio_ponderado
  FROM stations GROUP BY 1, 2, 3)
SELECT CAST(year(periodo) AS INTEGER) AS year, CAST(month(periodo) AS INTEGER) AS month,
       provincia, producto, {q("precio_ponderado")} AS precio_ponderado
FROM priced WHERE year(periodo) = 1998 AND provincia = 'NATION_3'
ORDER BY month DESC, producto LIMIT 20"""
)
def region_price_listing(spark: SparkSession, sf: str) -> DataFrame:
    rows = stations(spark, sf, "periodo", "provincia", "producto", "precio_surtidor", "volumen")
    dated = rows.withColumns({"year": F.year("periodo"), "month": F.month("periodo")})
    prices = A.weighted_mean_price(
        L.matching(dated, year=1998, provincia="NATION_3"),
        keys=("year", "month", "provincia", "producto"),
    ).drop("volumen_total")
    return rounded(
        L.latest_first(prices, 20, ["month"], ["producto"]), "precio_ponderado"
    )


# --- the three feeds together --------------------------------------------------------

_FACT = f"""
{STATIONS_SQL},
{_OIL_MONTHLY.strip()},
{_FX_MONTHLY.strip()},
station_months AS (
  SELECT periodo, producto, median(precio_surtidor) AS precio_surtidor_mediana,
         coalesce(sum(volumen), 0) AS volumen_total
  FROM stations GROUP BY 1, 2),
fact AS (
  SELECT s.*, o.avg_brent_price, f.usd_ars_oficial, f.usd_ars_blue, f.brecha_cambiaria_pct,
         s.precio_surtidor_mediana / nullif(f.usd_ars_oficial, 0) AS precio_usd
  FROM station_months s
  LEFT JOIN oil_monthly o ON o.date = last_day(s.periodo)
  LEFT JOIN fx_monthly f ON f.date = last_day(s.periodo))
"""


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    rows = stations(spark, sf, "periodo", "producto", "precio_surtidor", "volumen")
    return A.monthly_fact(
        A.product_month(rows),
        G.monthly_mean(oil(spark, sf), "brent_price", "avg_brent_price"),
        A.monthly_rates(fx(spark, sf)),
    )


@query(
    f"""WITH {_FACT}
SELECT periodo, producto, {q("precio_surtidor_mediana")} AS precio_surtidor_mediana,
       {q("volumen_total")} AS volumen_total, {q("avg_brent_price")} AS avg_brent_price,
       {q("usd_ars_oficial")} AS usd_ars_oficial, {q("usd_ars_blue")} AS usd_ars_blue,
       {q("brecha_cambiaria_pct")} AS brecha_cambiaria_pct, {q("precio_usd", 6)} AS precio_usd
FROM fact"""
)
def monthly_fact(spark: SparkSession, sf: str) -> DataFrame:
    fact = rounded(
        _fact(spark, sf),
        "precio_surtidor_mediana",
        "volumen_total",
        "avg_brent_price",
        "usd_ars_oficial",
        "usd_ars_blue",
        "brecha_cambiaria_pct",
    )
    return fact.withColumn("precio_usd", r("precio_usd", 6))


@query(
    f"""WITH {_FACT}
SELECT producto, CAST(count(*) AS BIGINT) AS months,
       {q("corr(precio_surtidor_mediana, avg_brent_price)", 6)} AS corr_oil,
       {q("corr(precio_surtidor_mediana, usd_ars_oficial)", 6)} AS corr_oficial,
       {q("corr(precio_surtidor_mediana, usd_ars_blue)", 6)} AS corr_blue
FROM fact GROUP BY 1"""
)
def monthly_fact_corr(spark: SparkSession, sf: str) -> DataFrame:
    correlations = A.fact_correlations(_fact(spark, sf))
    return correlations.withColumns(
        {c: r(c, 6) for c in ("corr_oil", "corr_oficial", "corr_blue")}
    )
