"""Sets of group keys; a key belongs to its file, so every set holds both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import has_level, level_bit
from ..schema import CLASSIFIER, SOURCE_FILE
from .joins import null_safe_join


def finest_level_keys(df: DataFrame, key: str = "id_row_ced_2d") -> DataFrame:
    """Each key once, with the finest level present under it.

    That is the union of: keys with an A; with a B and no A; with a C and neither;
    the rest.  A minimum over the level letters says the same in one aggregation.
    Rows without classifier are left out.
    """
    df = df.filter(F.col(CLASSIFIER).isNotNull())
    finest = F.coalesce(F.min("ced_group"), F.lit("D"))
    return df.groupBy(SOURCE_FILE, key).agg(finest.alias("finest_level"))


def level_masks(df: DataFrame, *keys: str) -> DataFrame:
    """Each key of each file with ``levels``, one bit per level present; see ``functions.keys.has_level``."""
    return df.groupBy(SOURCE_FILE, *keys).agg(F.bit_or(level_bit()).alias("levels"))


def split_keys(df: DataFrame, key: str, level: str) -> DataFrame:
    """All keys with ``present``: whether they have the level.  Both halves from one aggregation."""
    return level_masks(df, key).select(SOURCE_FILE, key, has_level("levels", level).alias("present"))


def split_rows(df: DataFrame, key: str, level: str) -> DataFrame:
    """All rows with ``present``: whether their key has the level.  Both halves from one join."""
    return null_safe_join(df, split_keys(df, key, level), [SOURCE_FILE, key])


def keys_with_level(df: DataFrame, key: str, level: str) -> DataFrame:
    return df.filter(F.col("ced_group") == level).select(SOURCE_FILE, key).distinct()


def keys_without_level(df: DataFrame, key: str, level: str) -> DataFrame:
    """Set difference: all keys less those with the level."""
    return df.select(SOURCE_FILE, key).subtract(keys_with_level(df, key, level))


def used_keys(df: DataFrame) -> DataFrame:
    """All ids that take part in any netting step, each once.

    Two- and three-digit ids always do (with or without the child they are
    tested for), four-digit ids if they have an A.  Expects rows that have a
    classifier, so the presence of a level is never unknown.
    """
    ids = F.array(
        "id_row_ced_2d", "id_row_ced_3d",
        F.when(F.col("ced_group") == "A", F.col("id_row_ced_4d")).otherwise(F.col("id_row_ced_2d")),
    )
    return df.select(SOURCE_FILE, F.explode(ids).alias("id")).distinct()
