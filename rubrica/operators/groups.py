"""Grouped operators that a hot group cannot stall.

None of them puts the rows of a group into one task: totals are combined on the
map side, and where rows need the total of their group they are joined to it, a
join whose hot partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ROW_ORDER
from .joins import null_safe_join


#: A hash of the keys ahead of them: a sort by long names that begin alike is decided by a number.
#: Only where rows are not moved again, as rows in the order of their names compress better.
HASH = "__hash"


def group_hash(keys) -> Column:
    return F.xxhash64(*keys)


def keep_first(df: DataFrame, keys, order=(ROW_ORDER,)) -> DataFrame:
    """The first row of each key by ``order``, NULL keys being one key.

    A minimum over (order, rest of the row), so every map task sends one row per
    key.  The rest of the row breaks a tie the same way in every run.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *payload)).alias("__first")
    return df.groupBy(*keys).agg(first).select(*keys, "__first.*").select(*df.columns)


def presence_flags(df: DataFrame, keys, flags: dict[str, Column]) -> DataFrame:
    """Per key, whether any row meets each condition."""
    return df.groupBy(*keys).agg(*[F.bool_or(c).alias(n) for n, c in flags.items()])


def with_group_stats(df: DataFrame, keys, **stats: Column) -> DataFrame:
    """Every row with aggregates of its group."""
    per_group = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return null_safe_join(df, per_group, keys)


def with_group_kind(df: DataFrame, keys, name: str = "kind") -> DataFrame:
    """Every row with ``several`` or ``single``, by the number of rows of its group."""
    counted = with_group_stats(df, keys, __n=F.count("*"))
    return counted.withColumn(name, F.when(F.col("__n") > 1, "several").otherwise("single")).drop("__n")


def multi_row_groups(df: DataFrame, keys, single: bool = False) -> DataFrame:
    """Rows of groups with more than one row, or with exactly one."""
    marked = with_group_kind(df, keys, "__kind")
    return marked.filter(F.col("__kind") == ("single" if single else "several")).drop("__kind")
