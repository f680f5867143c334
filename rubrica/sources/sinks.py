"""Sinks: CSV with NULL as an empty cell, and parquet."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ordered(df: DataFrame, partition_by=(), sort_by=()) -> DataFrame:
    """Rows in the order of the written files: ranges of the sort columns, NULLs last.

    Part files follow each other by name.  Folders come first in the order, so that
    the writer does not sort anew.
    """
    return df.orderBy(*[F.asc_nulls_last(c) for c in (*partition_by, *sort_by)]) if sort_by else df


def write_csv(df: DataFrame, path: str, partition_by=(), mode: str = "errorifexists", sort_by=()) -> None:
    """CSV that ``read_extracts`` reads back; cells with line breaks need its ``multi_line``."""
    ordered(df, partition_by, sort_by).write.mode(mode).partitionBy(*partition_by).csv(
        path, header=True, nullValue="", emptyValue="", escape='"'
    )


def write_parquet(df: DataFrame, path: str, partition_by=(), mode: str = "errorifexists", sort_by=()) -> None:
    """Parquet under any URI Spark can write to, an object store included."""
    ordered(df, partition_by, sort_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by, sort_by=()) -> None:
    """Write parquet; of what is there, only the partitions that ``df`` has rows for are replaced.

    ``df`` must not read from ``path``.
    """
    rows = ordered(df, partition_by, sort_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder that all executors share.

    It is the one the cluster names in ``spark.checkpoint.dir``.  A machine-local
    folder serves only a local master.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="rubrica-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` from a copy in the scratch folder; what they came from is not read again."""
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
