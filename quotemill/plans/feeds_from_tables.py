"""The feeds derived from the star-schema test tables.

The tables hold no price feeds, so each feed is computed from them: station
prices from line items with their part, supplier and nation, oil and exchange
quotes from orders. Every row of the source table takes part.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.functions.parsing import round_half_even


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def oil_date() -> Column:
    """Order day; February orders move on a month so that months are empty."""
    day = F.col("o_orderdate").cast("date")
    return F.when(F.month(day) == 2, F.add_months(day, 1)).otherwise(day)


def oil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        oil_date().alias("date"), F.col("o_totalprice").alias("brent_price")
    )


OIL_SQL = """
oil AS (
  SELECT CASE WHEN month(o_orderdate) = 2
              THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE)
              ELSE CAST(o_orderdate AS DATE) END AS date,
         o_totalprice AS brent_price
  FROM orders)
"""


def landed_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange quotes as landed: the day is still a timestamp."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("date"),
        F.when(status == "F", "Oficial").when(status == "O", "Blue").otherwise("Otro").alias(
            "source"
        ),
        F.col("o_totalprice").alias("value_sell"),
        (F.col("o_totalprice") * 0.98).alias("value_buy"),
    )


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_fx(spark, sf_dir).withColumn("date", F.col("date").cast("date"))


FX_SQL = """
fx AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CASE o_orderstatus WHEN 'F' THEN 'Oficial' WHEN 'O' THEN 'Blue' ELSE 'Otro' END AS source,
         o_totalprice AS value_sell,
         o_totalprice * CAST(0.98 AS DOUBLE) AS value_buy
  FROM orders)
"""

# Which dimension tables each station column needs.
_DIMENSION = {
    "producto": "part",
    "bandera": "part",
    "provincia": "nation",
    "operador": "supplier",
}


def _station_lines(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Line items joined with the dimensions that the columns need, no others.

    Each dimension joins the line items directly, as a plain scan whose size
    Spark knows from its files. So it broadcasts what is below the session's
    threshold and the line items stay in place; a part or supplier table beyond
    it is shuffled, and adaptive execution splits a part that holds many lines.
    (A joined pair of dimensions would have no known size and force a shuffle.)
    """
    needed = {_DIMENSION[c] for c in columns if c in _DIMENSION}
    rows = table(spark, sf_dir, "lineitem")
    if "part" in needed:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
        rows = rows.join(part, rows.l_partkey == part.p_partkey)
    if needed & {"nation", "supplier"}:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
        rows = rows.join(supplier, rows.l_suppkey == supplier.s_suppkey)
    if "nation" in needed:
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        rows = rows.join(nation, rows.s_nationkey == nation.n_nationkey)
    return rows


def list_price() -> Column:
    """Unit price in whole cents."""
    return round_half_even(F.col("l_extendedprice") / F.col("l_quantity"))


STATION_COLUMNS = ("periodo", "provincia", "bandera", "producto", "precio_surtidor", "volumen")


def stations(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Clean station rows with the given columns (all by default)."""
    wanted = list(columns or STATION_COLUMNS)
    source = {
        "periodo": F.trunc("l_shipdate", "MM"),
        "provincia": F.col("n_name") if "provincia" in wanted else None,
        "bandera": F.col("p_brand") if "bandera" in wanted else None,
        "producto": F.col("p_type") if "producto" in wanted else None,
        "precio_surtidor": list_price(),
        "volumen": F.col("l_quantity"),
    }
    return _station_lines(spark, sf_dir, wanted).select(*[source[c].alias(c) for c in wanted])


STATIONS_SQL = """
stations AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS periodo,
         n_name AS provincia, p_brand AS bandera, p_type AS producto,
         round_even(l_extendedprice / l_quantity * 100, 0) / 100 AS precio_surtidor,
         l_quantity AS volumen
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey)
"""

# Raw spelling per part type: four known products, the "no data" mark, and one
# with a leading space, which the dictionary does not know.
RAW_PRODUCTS = {
    "ECONOMY": "Nafta (Super) entre 92 y 95 RON",
    "STANDARD": "NAFTA (Premium) de MÁS de 95 RON",
    "LARGE": "Gas Oil Grado 2",
    "MEDIUM": "GNC",
    "PROMO": "N/D",
}
RAW_PRODUCT_DEFAULT = " gnc"


def raw_product() -> Column:
    column = F.col("p_type")
    spelled: Any = F
    for kind, spelling in RAW_PRODUCTS.items():
        spelled = spelled.when(column == kind, spelling)
    return spelled.otherwise(RAW_PRODUCT_DEFAULT)


def raw_month() -> Column:
    """Month text in three accepted spellings and two unreadable ones."""
    line, day = F.col("l_linenumber"), F.col("l_shipdate")
    year, month = F.year(day), F.month(day)
    two_digits = F.lpad(month.cast("string"), 2, "0")
    return (
        F.when(line == 1, F.concat_ws("/", year, month))
        .when((line == 2) & (F.col("l_returnflag") == "R"), "x")
        .when((line == 3) & (F.col("l_returnflag") == "R"), F.concat_ws("-", year, two_digits))
        .otherwise(F.concat_ws("/", year, two_digits))
    )


def raw_price() -> Column:
    """Price text; some zero, some unreadable, some missing, by tax class."""
    tax, line = F.col("l_tax"), F.col("l_linenumber")
    price = list_price().cast("string")
    return (
        F.when((line == 4) & (tax == 0.0), "0")
        .when((line == 4) & (tax == 0.01), "s/d")
        .when((line == 4) & (tax == 0.02), F.lit(None).cast("string"))
        .otherwise(price)
    )


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station prices as landed: text cells, raw headers, repeated rows.

    Every row that is the first line of its order occurs twice.
    """
    rows = _station_lines(spark, sf_dir, ["producto", "provincia", "operador"])
    copies = F.when(F.col("l_linenumber") == 1, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return rows.withColumn("_copy", F.explode(copies)).select(
        raw_month().alias("Período"),
        F.col("s_name").alias("Operador"),
        F.col("l_orderkey").cast("string").alias("Nº Inscripción"),
        F.col("p_brand").alias("Bandera"),
        F.col("n_name").alias("Provincia"),
        raw_product().alias("Producto"),
        raw_price().alias("Precio Surtidor"),
        F.col("l_quantity").cast("string").alias("Volumen"),
        F.col("l_linenumber").cast("string").alias("No.Movimientos"),
    )


_PRODUCT_CASE = " ".join(
    f"WHEN '{kind}' THEN '{spelling}'" for kind, spelling in RAW_PRODUCTS.items()
)

# The raw feed, then the same with values instead of texts.
RAW_STATIONS_SQL = f"""
landed AS (
  SELECT CASE WHEN l_linenumber = 1
              THEN CAST(year(l_shipdate) AS VARCHAR) || '/' || CAST(month(l_shipdate) AS VARCHAR)
              WHEN l_linenumber = 2 AND l_returnflag = 'R' THEN 'x'
              WHEN l_linenumber = 3 AND l_returnflag = 'R' THEN strftime(l_shipdate, '%Y-%m')
              ELSE strftime(l_shipdate, '%Y/%m') END AS periodo_texto,
         s_name AS operador,
         CAST(l_orderkey AS VARCHAR) AS no_inscripcion,
         p_brand AS bandera,
         n_name AS provincia,
         CASE p_type {_PRODUCT_CASE} ELSE '{RAW_PRODUCT_DEFAULT}' END AS producto_texto,
         CASE WHEN l_linenumber = 4 AND l_tax = 0.0 THEN '0'
              WHEN l_linenumber = 4 AND l_tax = 0.01 THEN 's/d'
              WHEN l_linenumber = 4 AND l_tax = 0.02 THEN NULL
              ELSE CAST(round_even(l_extendedprice / l_quantity * 100, 0) / 100 AS VARCHAR)
              END AS precio_texto,
         CAST(l_quantity AS VARCHAR) AS volumen_texto,
         CAST(l_linenumber AS VARCHAR) AS no_movimientos
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey),
raw AS (
  SELECT * FROM landed UNION ALL SELECT * FROM landed WHERE no_movimientos = '1'),
typed AS (
  SELECT * EXCLUDE (periodo_texto, producto_texto, precio_texto, volumen_texto),
         CAST(try_strptime(periodo_texto, '%Y/%m') AS DATE) AS periodo,
         producto_texto AS producto,
         TRY_CAST(precio_texto AS DOUBLE) AS precio_surtidor,
         TRY_CAST(volumen_texto AS DOUBLE) AS volumen
  FROM raw)
"""
