"""Parsing, null handling and number rules as plain column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text cells that a CSV scan reads as null (the public pandas
# default list). "N/D" and "-" are not among them and stay text.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Accepted spellings. A month is year/month with one or two
# digits for the month; numbers are what a float parser takes, without Java's
# `1d` and `5f` suffixes.
MONTH_FORMAT = "yyyy/M"
DAY_FORMAT = "yyyy-M-d"
NUMBER_PATTERN = (
    r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?inf(inity)?\s*$"
)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_month(column: Column | str) -> Column:
    """First day of a ``YYYY/MM`` month; null when the text is anything else."""
    return F.try_to_timestamp(_col(column), F.lit(MONTH_FORMAT)).cast("date")


def parse_day(column: Column | str) -> Column:
    """Date of a ``YYYY-MM-DD`` text; null when the text is anything else."""
    return F.try_to_timestamp(_col(column), F.lit(DAY_FORMAT)).cast("date")


def parse_number(column: Column | str) -> Column:
    """Double value of a text; null when it is not a number."""
    text = _col(column)
    return F.when(
        F.lower(text).rlike(NUMBER_PATTERN), text.try_cast(T.DoubleType())
    )


def strict_cast(column: Column | str, data_type: T.DataType, label: str) -> Column:
    """Cast that fails the job on a bad value, whatever the session's ANSI mode."""
    value = _col(column)
    failure = F.raise_error(
        F.concat(F.lit(f"{label}: cannot read '"), value.cast("string"), F.lit("'"))
    ).cast(data_type)
    return F.coalesce(
        value.try_cast(data_type), F.when(value.isNotNull(), failure)
    )


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Replace the null spellings by null in every text column."""
    return df.select(
        [
            F.when(~F.col(f"`{f.name}`").isin(*tokens), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating-point column."""
    return df.select(
        [
            F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def map_values(column: Column | str, mapping: Mapping[str, str | None]) -> Column:
    """Dictionary lookup by lower-cased text, exact and untrimmed.

    Texts outside the dictionary, and those it maps to None, give null.
    """
    key = F.lower(_col(column))
    pairs = [(k, v) for k, v in mapping.items() if v is not None]
    if not pairs:
        return F.lit(None).cast("string")
    lookup = F.create_map(*[F.lit(part) for pair in pairs for part in pair])
    return F.try_element_at(lookup, key)


def round_half_even(column: Column | str, digits: int = 2) -> Column:
    """Round as numpy does: scale, round half to even, scale back."""
    factor = float(10**digits)
    return F.rint(_col(column) * F.lit(factor)) / F.lit(factor)


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """part / whole x 100; null for a zero or null whole."""
    return F.try_divide(_col(part), _col(whole)) * F.lit(100.0)


def zero_sum(column: Column | str) -> Column:
    """Sum whose value over nothing but nulls is 0.0 instead of null."""
    return F.coalesce(F.sum(_col(column).cast("double")), F.lit(0.0))
