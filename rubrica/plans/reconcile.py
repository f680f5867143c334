"""Where the amounts of an extract go: kept, taken off parents, or lost to a rule of the netting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.hierarchy import prepare_extract
from ..operators.joins import Lookup
from ..schema import METRICS, PRODUCTION, SOURCE_FILE, Rules
from .net import CHOICE, _combine, _with_totals, candidates, placed_key

#: The parts of a raw total; with NULL as 0 they add up to it.
PARTS = ("net_total", "children", "siblings", "finer", "unlisted")


def reconcile_net(
    typed: DataFrame, units: DataFrame | Lookup, rules: Rules = PRODUCTION, metrics=METRICS
) -> DataFrame:
    """Per file, level and metric: rows and total before and after the netting, and the parts of the difference.

    * ``children``: taken off parents;
    * ``siblings``: of rows that share unit key, prefix and level with the one that stands for them;
    * ``finer``: the net value of rows whose key went to a row of a finer level, or earlier in the file;
    * ``unlisted``: of rows that no level lists, as a total without anything below it.

    One scan: all of it comes from the combined rows that the netting works on, which
    hold the sums of the raw rows.  ``metrics`` have to be columns of ``typed``.
    """
    rows = prepare_extract(typed, units, rules)
    found = candidates(_with_totals(_combine(rows, rules, metrics, []), rules, metrics), rules, metrics)
    listed = F.col("__priority").isNotNull()
    first = F.row_number().over(Window.partitionBy(*placed_key(rules)).orderBy(F.asc_nulls_last(CHOICE[0]), *CHOICE[1:])) == 1
    found = found.withColumns({"__listed": listed, "__kept": listed & first})

    zero = lambda c: F.coalesce(c, F.lit(0))
    listed, kept = F.col("__listed"), F.col("__kept")

    def sums(m: str) -> Column:
        net, own, whole = F.col(m), F.col(f"__own_{m}"), F.col(f"__sum_{m}")
        off = F.when(listed, zero(own) - zero(net)).otherwise(F.lit(0))
        return F.struct(
            F.lit(m).alias("metrica"), F.sum(whole).alias("raw_total"), F.sum(F.when(kept, net)).alias("net_total"),
            F.sum(off).alias("children"), F.sum(zero(whole) - zero(own)).alias("siblings"),
            F.sum(F.when(listed & ~kept, zero(net)).otherwise(F.lit(0))).alias("finer"),
            F.sum(F.when(listed, F.lit(0)).otherwise(zero(own))).alias("unlisted"))

    per_level = found.groupBy(SOURCE_FILE, "ced_group").agg(
        F.sum("__n").alias("raw_rows"), F.nullif(F.count_if(kept), F.lit(0)).alias("net_rows"),
        F.array(*map(sums, metrics)).alias("__metrics"))
    return per_level.select(SOURCE_FILE, "ced_group", "raw_rows", "net_rows", F.explode("__metrics").alias("m")).select(
        SOURCE_FILE, "ced_group", "m.metrica", "raw_rows", "net_rows", "m.raw_total", *[f"m.{p}" for p in PARTS])
