"""Column-name rules. They act on the schema only; no rows are read."""

from __future__ import annotations

import logging
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def columns_of(df: DataFrame, names: Sequence[str] | None = None) -> list[Column]:
    """Columns by their exact name, which may hold dots or spaces."""
    return [F.col(f"`{c}`") for c in (df.columns if names is None else names)]


def normal_name(name: str) -> str:
    """Lower case, spaces and dots to underscores, accents folded to ASCII."""
    plain = name.lower().translate(str.maketrans({" ": "_", ".": "_"}))
    folded = unicodedata.normalize("NFKD", plain)
    return "".join(ch for ch in folded if ch.isascii())


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column by `normal_name`; two equal results are an error."""
    names = [normal_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after normalization: {clashes}")
    return df.toDF(*names)


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The same DataFrame, or ValueError naming the columns it lacks."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {df.columns}")
    return df


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project to the wanted columns; absent ones are logged and left out."""
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        log.warning("columns not present, left out: %s", absent)
    return df.select(columns_of(df, [c for c in wanted if c in df.columns]))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names that are not present are ignored."""
    return df.withColumnsRenamed(dict(mapping))
