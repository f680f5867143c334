"""Choice and order of columns by name, position and type."""

from __future__ import annotations

from fnmatch import fnmatchcase

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_names as _clean


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*_clean(df.columns))


def matching(df: DataFrame, *patterns: str) -> list[str]:
    """Names that match a pattern (``*_class``, ``data_*``), in table order."""
    return [c for c in df.columns if any(fnmatchcase(c, p) for p in patterns)]


def keep_matching(df: DataFrame, *patterns: str) -> DataFrame:
    return df.select(matching(df, *patterns))


def drop_matching(df: DataFrame, *patterns: str) -> DataFrame:
    return df.drop(*matching(df, *patterns))


def name_range(names: list[str], first: str, last: str) -> list[str]:
    """The names from ``first`` to ``last`` by position, backwards if they stand so."""
    a, b = names.index(first), names.index(last)
    return names[a : b + 1] if a <= b else names[b : a + 1][::-1]


def column_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """All columns from ``first`` to ``last`` by position."""
    return df.select(name_range(df.columns, first, last))


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def relocate(df: DataFrame, *names: str, before: str | None = None, after: str | None = None) -> DataFrame:
    """Move columns to the front, or next to another one."""
    rest = [c for c in df.columns if c not in names]
    at = rest.index(before) if before else rest.index(after) + 1 if after else 0
    return df.select(*rest[:at], *names, *rest[at:])


def unpivot(df: DataFrame, metrics, name: str = "metrica", value: str = "valor") -> DataFrame:
    """One row per metric; NULL values stay."""
    ids = [c for c in df.columns if c not in metrics]
    return df.unpivot([F.col(c) for c in ids], list(metrics), name, value)
