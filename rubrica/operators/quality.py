"""Checks on extracts and results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import prefix_group
from ..schema import METRICS, SOURCE_FILE


def report_inventory(processed: DataFrame) -> DataFrame:
    """Distinct reference date, extraction date and report type."""
    return processed.select("data_reporte", "data_extraido", "reporte_tipo").distinct()


def repeated_groups(df: DataFrame, digits: int = 4) -> DataFrame:
    """Groups that still hold several rows."""
    return df.groupBy(*prefix_group(digits)).agg(F.count("*").alias("n")).filter("n > 1")


def regex_slices(df: DataFrame) -> DataFrame:
    """Rows by the zeros that end their classifier, as the patterns slice them.

    The zero patterns ask for a digit from 1 to 9 before the zeros; a row that
    fits none has no slice.
    """
    ced = F.col("ced")
    slices = (
        F.when(~ced.rlike("00$"), "XX").when(ced.rlike("[1-9]00$"), "00")
        .when(ced.rlike("[1-9]000$"), "000").when(ced.rlike("[1-9]0000$"), "0000")
    )
    return df.withColumn("slice", slices)


def order_of_files(df: DataFrame, keys, within=()) -> DataFrame:
    """Per file of a table that was read from files: rows, first and last key, and whether it is in place.

    ``within`` names the folder columns; files of a folder follow each other by name.  A file
    is in place if no key is before its first, none behind its last, and its first is not
    before the last of the file ahead of it.  Nothing is sorted but one line per file.
    """
    keys, within = list(keys), list(within)
    # NULLs stand last, as ``ordered`` writes them.
    key = F.struct(*[x for c in keys for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(c))])
    place = F.struct("_metadata.file_block_start", "_metadata.row_index")
    rows = df.select(*within, F.col("_metadata.file_name").alias("file"), key.alias("key"), place.alias("place"))
    files = rows.groupBy(*within, "file").agg(
        F.count("*").alias("n"), F.min_by("key", "place").alias("first"), F.max_by("key", "place").alias("last"),
        F.min("key").alias("least"), F.max("key").alias("most"))
    before = F.lag("last").over(Window.partitionBy(*within).orderBy("file"))
    follows = F.coalesce(before <= F.col("first"), F.lit(True))
    inside = (F.col("first") == F.col("least")) & (F.col("last") == F.col("most"))
    shown = lambda edge: F.struct(*[F.col(f"{edge}.{c}") for c in keys]).alias(edge)
    return files.withColumn("in_order", inside & follows).select(*within, "file", "n", shown("first"), shown("last"), "in_order")


def level_totals(df: DataFrame, stage: str, metrics=METRICS) -> DataFrame:
    """Rows and metric totals per file and level."""
    return df.groupBy(SOURCE_FILE, "ced_group").agg(
        F.count("*").alias("n"), *[F.sum(m).alias(m) for m in metrics]
    ).select(F.lit(stage).alias("stage"), "*")


def reconcile_totals(before: DataFrame, after: DataFrame, metrics=METRICS) -> DataFrame:
    """Totals per file, level and metric of the raw and of the netted rows, side by side."""
    totals = [level_totals(before, "raw", metrics), level_totals(after, "net", metrics)]
    long = reduce(lambda a, b: a.unionByName(b), totals).unpivot(
        ["stage", SOURCE_FILE, "ced_group", "n"], list(metrics), "metrica", "valor"
    )
    raw, net = F.col("stage") == "raw", F.col("stage") == "net"
    return long.groupBy(SOURCE_FILE, "ced_group", "metrica").agg(
        F.sum(F.when(raw, F.col("n"))).alias("raw_rows"),
        F.sum(F.when(net, F.col("n"))).alias("net_rows"),
        F.sum(F.when(raw, F.col("valor"))).alias("raw_total"),
        F.sum(F.when(net, F.col("valor"))).alias("net_total"),
    )
