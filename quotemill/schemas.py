"""Fixed values of the data model: feeds, product dictionary, published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: feeds -----------------------------------------------------

OIL_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("brent_price", T.DoubleType())]
)

FX_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("value_sell", T.DoubleType()),
        T.StructField("value_buy", T.DoubleType()),
    ]
)

FX_SOURCES = ("Oficial", "Blue")

STATION_REQUIRED = ("periodo", "precio_surtidor", "producto")

STATION_AGG_COLUMNS = (
    "periodo",
    "provincia",
    "bandera",
    "producto",
    "precio_surtidor",
    "volumen",
)

DEFAULT_START_DATE = "2025-01-01"
DEFAULT_PRICE_FLOOR = 1.0

# --- Fixed values: names of the processed files, (cleaned rows, monthly table) ----

OIL_FILES = ("brent_price_cleaned", "brent_price_monthly")
STATION_FILES = ("fuel_price_cleaned", "fuel_price_aggregated")
FX_FILES = ("dollar_price_cleaned", "dollar_price_aggregated")

# --- Fixed values: raw product spelling (lower case) -> published product ------

PRODUCT_NAMES = {
    "nafta (super) entre 92 y 95 ron": "NAFTA GRADO 2",
    "nafta (premium) de más de 95 ron": "NAFTA GRADO 3",
    "nafta (común) hasta 92 ron": "NAFTA GRADO 1",
    "gas oil grado 2": "GASOIL GRADO 2",
    "gas oil grado 3": "GASOIL GRADO 3",
    "gnc": "GNC",
    "kerosene": "KEROSENE",
    "glpa": "GLPA",
    "n/d": None,
}


@dataclass(frozen=True)
class Field:
    """One published column in its two target flavours."""

    name: str
    relational: str | None  # None: the relational table lacks it
    warehouse: str
    required: bool | str = False  # True, or the one target that requires it
    max_length: int | None = None  # warehouse text length
    positive: bool = False
    blank: bool = False  # published as null, source content is unusable


@dataclass(frozen=True)
class Table:
    """A published table: columns, key, and physical layout."""

    layer: str
    name: str
    fields: tuple[Field, ...]
    unique: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.layer}_{self.name}"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def requires(self, field: Field, target: str) -> bool:
        return field.required is True or field.required == target

    def type_of(self, field: Field, target: str) -> T.DataType:
        ddl = field.warehouse if target == "warehouse" else field.relational or field.warehouse
        return T.DataType.fromDDL(ddl)


# --- Fixed values: published tables --------------------------------------------
# Field(name, relational type, warehouse type, ...)

STAGING_OIL = Table(
    "staging",
    "brent_price",
    (
        Field("date", "date", "date", required=True),
        Field("brent_price", "decimal(10,2)", "double", required=True, positive=True),
    ),
    unique=("date",),
    sort_by=("date",),
)

STAGING_FUEL = Table(
    "staging",
    "fuel_prices",
    (
        Field("periodo", "date", "date", required=True),
        Field("operador", None, "string", max_length=200),
        Field("nro_inscripcion", None, "string", max_length=50),
        Field("bandera", "string", "string", max_length=100),
        Field("fecha_de_baja", None, "date", blank=True),
        Field("cuit", None, "string", max_length=20),
        Field("tipo_negocio", None, "string", max_length=100),
        Field("direccion", None, "string", max_length=300),
        Field("localidad", None, "string", max_length=200),
        Field("provincia", "string", "string", required="relational", max_length=100),
        Field("producto", "string", "string", required=True, max_length=100),
        Field("canal_de_comercializacion", None, "string", max_length=100),
        Field("precio_sin_impuestos", None, "double"),
        Field("precio_con_impuestos", None, "double"),
        Field("volumen", "decimal(15,2)", "double"),
        Field("precio_surtidor", "decimal(10,2)", "double", required=True, positive=True),
        Field("no_movimientos", None, "string", max_length=50),
        Field("excentos", None, "double"),
        Field("impuesto_combustible_liquido", None, "double"),
        Field("impuesto_dioxido_carbono", None, "double"),
        Field("tasa_vial", None, "double"),
        Field("tasa_municipal", None, "double"),
        Field("ingresos_brutos", None, "double"),
        Field("iva", None, "double"),
        Field("fondo_fiduciario_gnc", None, "double"),
        Field("impuesto_combustible_liquidos", None, "double"),
        Field("market_share_pct", "decimal(10,4)", "double"),
    ),
    partition_by=("periodo",),
    sort_by=("producto",),
)

STAGING_FX = Table(
    "staging",
    "usd_ars_rates",
    (
        Field("date", "date", "date", required=True),
        Field("source", "string", "string", required=True, max_length=20),
        Field("value_buy", "decimal(10,2)", "double"),
        Field("value_sell", "decimal(10,2)", "double", required=True, positive=True),
    ),
    unique=("date", "source"),
    sort_by=("date", "source"),
)

ANALYTICS_OIL = Table(
    "analytics",
    "brent_prices_monthly",
    (
        Field("date", "date", "date", required=True),
        Field("avg_brent_price", "decimal(10,2)", "double", required=True, positive=True),
    ),
    unique=("date",),
    sort_by=("date",),
)

ANALYTICS_FUEL = Table(
    "analytics",
    "fuel_prices_monthly",
    (
        Field("periodo", "date", "date", required=True),
        Field("producto", "string", "string", required=True, max_length=100),
        Field(
            "precio_surtidor_mediana", "decimal(10,2)", "double", required=True, positive=True
        ),
        Field("volumen_total", "decimal(15,2)", "double"),
    ),
    unique=("periodo", "producto"),
    sort_by=("periodo", "producto"),
)

ANALYTICS_FX = Table(
    "analytics",
    "usd_ars_rates_monthly",
    (
        Field("date", "date", "date", required=True),
        Field("usd_ars_oficial", "decimal(10,2)", "double", required=True, positive=True),
        Field("usd_ars_blue", "decimal(10,2)", "double", required=True, positive=True),
        Field("brecha_cambiaria_pct", "decimal(10,2)", "double"),
    ),
    unique=("date",),
    sort_by=("date",),
)

TABLES = {
    t.key: t
    for t in (
        STAGING_OIL,
        STAGING_FUEL,
        STAGING_FX,
        ANALYTICS_OIL,
        ANALYTICS_FUEL,
        ANALYTICS_FX,
    )
}
