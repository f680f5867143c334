"""Joins in which a NULL key matches a NULL key."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import KEEP, REMOVE
from ..sources.sinks import written

#: A lookup of at most this many rows and bytes of text is sent to every executor.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the table has at most ``max_rows`` rows and ``max_bytes`` bytes as JSON.

    The check reads ``max_rows + 1`` rows at most.  A larger table gets no
    hint: it is joined by shuffle, where AQE splits a hot key.
    """
    rows, held = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(_json_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and held <= max_bytes else df


def _json_bytes(df: DataFrame) -> Column:
    return F.octet_length(F.to_json(F.struct(*df.columns)))


@dataclass(frozen=True)
class Lookup:
    """A lookup evaluated once: its rows in the scratch folder, and what a check of them found.

    ``n_repeated`` counts the keys that it holds more than once; each of them multiplies
    the rows that are looked up.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    n_rows: int
    n_bytes: int
    n_repeated: int

    @property
    def small(self) -> bool:
        return self.n_rows <= BROADCAST_ROWS and self.n_bytes <= BROADCAST_BYTES

    def repeated(self) -> DataFrame:
        return repeated_keys(self.rows, *self.keys)


def prepare_lookup(dim: DataFrame, *keys: str) -> Lookup:
    """Write a lookup to the scratch folder and check it, so that its uses cost no job while plans are built."""
    rows = written(dim, "lookup")
    per_key = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(_json_bytes(rows)).alias("held"))
    n, held, repeated = per_key.agg(F.sum("n"), F.sum("held"), F.count_if(F.col("n") > 1)).first()
    return Lookup(rows, keys, n or 0, held or 0, repeated)


def rows_of(dim: DataFrame | Lookup) -> DataFrame:
    return dim.rows if isinstance(dim, Lookup) else dim


def hinted(dim: DataFrame | Lookup, df: DataFrame) -> DataFrame:
    """``df``, no larger than its lookup ``dim``, with a broadcast hint if that is small."""
    if isinstance(dim, Lookup):
        return F.broadcast(df) if dim.small else df
    return broadcast_if_small(df)


def null_safe(left: DataFrame, right: DataFrame, on: dict[str, str]) -> Column:
    return reduce(and_, [left[a].eqNullSafe(right[b]) for a, b in on.items()])


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on columns of the same name; the result has the keys of the left side once."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    joined = left.join(renamed, null_safe(left, renamed, {k: f"__{k}" for k in keys}), how)
    return joined.drop(*[f"__{k}" for k in keys])


def semi_join_keys(df: DataFrame, keys: DataFrame, on: dict[str, str] | None = None) -> DataFrame:
    """Rows whose key is in the key table."""
    return _key_join(df, keys, on, "left_semi")


def anti_join_keys(df: DataFrame, keys: DataFrame, on: dict[str, str] | None = None) -> DataFrame:
    """Rows whose key is not in the key table."""
    return _key_join(df, keys, on, "left_anti")


def _key_join(df, keys, on, how) -> DataFrame:
    on = on or {c: c for c in keys.columns}
    # New names, so that a key table made from ``df`` itself is told apart from it.
    keys = keys.withColumnsRenamed({b: f"__{b}" for b in on.values()})
    return df.join(keys, null_safe(df, keys, {a: f"__{b}" for a, b in on.items()}), how)


def lookup(df: DataFrame, dim: DataFrame | Lookup, on: dict[str, str]) -> DataFrame:
    """Left join to a lookup, dropping its key column.

    A key that the lookup holds twice doubles the row; a prepared lookup says how many there are.
    """
    rows = rows_of(dim).withColumnsRenamed({b: f"__{b}" for b in on.values()})
    joined = df.join(hinted(dim, rows), null_safe(df, rows, {a: f"__{b}" for a, b in on.items()}), "left")
    return joined.drop(*[f"__{b}" for b in on.values()])


def repeated_keys(dim: DataFrame, *keys: str) -> DataFrame:
    """Keys that a lookup holds more than once."""
    return dim.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


# -- units --------------------------------------------------------------------


def flag_units(df: DataFrame, units: DataFrame | Lookup) -> DataFrame:
    """Add the keep/remove flags for the unit and for a blank classifier."""
    codes = _codes(units).withColumn("__known", F.lit(True))
    joined = df.join(hinted(units, codes), F.col("ugb_id").eqNullSafe(F.col("__unit")), "left")
    return joined.withColumns({
        "mec_ugb_class": F.when(F.col("__known"), KEEP).otherwise(REMOVE),
        "ced_blank_class": F.when(F.col("ced").isNotNull(), KEEP).otherwise(REMOVE),
    }).drop("__unit", "__known")


def filter_valid(df: DataFrame, units: DataFrame | Lookup) -> DataFrame:
    """Rows of known units that have a classifier."""
    known = hinted(units, _codes(units))
    return df.filter(F.col("ced").isNotNull()).join(known, F.col("ugb_id").eqNullSafe(F.col("__unit")), "left_semi")


def _codes(units: DataFrame | Lookup) -> DataFrame:
    return rows_of(units).select(F.col("codigo_ugb").alias("__unit")).distinct()
