"""Lookup tables: units, classifier names, fund sources."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import tidy_text
from ..functions.text import clean_names, strip_decimal_zeros, title_case
from ..operators.columns import column_range
from ..operators.joins import Lookup, prepare_lookup, repeated_keys, rows_of
from .extracts import MALFORMED

UNIT_RANGE = ("codigo_ugb", "nivel_da_instituicao")


@dataclass(frozen=True)
class Dimensions:
    """The lookups of units, classifiers and funds; after ``prepared`` each is evaluated and checked."""

    ugb: DataFrame | Lookup
    ced: DataFrame | Lookup
    fr: DataFrame | Lookup

    def prepared(self) -> "Dimensions":
        return Dimensions(
            prepare_lookup(self.ugb, "codigo_ugb"), prepare_lookup(self.ced, "ced"), prepare_lookup(self.fr, "fr"))

    def repeated_keys(self) -> DataFrame:
        """(dim, key, n) of the keys that a lookup holds more than once; they multiply the rows looked up."""
        keys = {"ugb": (self.ugb, "codigo_ugb"), "ced": (self.ced, "ced"), "fr": (self.fr, "fr")}
        parts = [repeated_keys(rows_of(dim), key).select(F.lit(name).alias("dim"), F.col(key).alias("key"), "n")
                 for name, (dim, key) in keys.items()]
        return reduce(lambda a, b: a.unionByName(b), parts)


def read_table(
    spark: SparkSession, path: str, fmt: str = "csv", *, skip: int = 0, sep: str = ","
) -> DataFrame:
    """A lookup sheet as text with clean names.

    ``skip`` leaves out that many lines above the header.  A sheet of several
    part files has the same header in each of them.  Lines are numbered per file
    to find it, one task per file; a line that does not fit the header raises.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select([F.col(f"`{o}`").cast("string").alias(n)
                          for o, n in zip(df.columns, clean_names(df.columns))])
    at = [F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq")]
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), *at)
    lines = lines.withColumn("n", F.row_number().over(Window.partitionBy("file").orderBy("block", "seq")))
    heads = [r.value.lstrip("\ufeff") for r in lines.where(F.col("n") == skip + 1).select("value").distinct().collect()]
    if len(heads) != 1:
        raise ValueError(f"a lookup sheet needs one header, {path} has {len(heads)}")
    names = clean_names(next(csv.reader(heads, delimiter=sep)))
    body = lines.where((F.col("n") > skip + 1) & (F.trim("value") != ""))
    schema = ",".join(f"`{n}` string" for n in (*names, MALFORMED))
    options = {"sep": sep, "escape": '"', "columnNameOfCorruptRecord": MALFORMED}
    cells = body.select(F.from_csv("value", F.lit(schema), options).alias("r")).select("r.*")
    found = F.raise_error(F.concat(F.lit("malformed line in a lookup sheet: "), F.col(MALFORMED))).cast("boolean")
    cells = cells.where(F.when(F.col(MALFORMED).isNull(), F.lit(True)).otherwise(found)).drop(MALFORMED)
    return tidy_text(cells, cells.columns)


def unit_dimension(sheet: DataFrame) -> DataFrame:
    """Columns ``codigo_ugb`` to ``nivel_da_instituicao``, district in title case."""
    return column_range(sheet, *UNIT_RANGE).withColumn("distrito", title_case("distrito"))


def classifier_dimension(sheet: DataFrame, code="codigo", description="designacao") -> DataFrame:
    return (
        sheet.select(F.col(code).alias("ced"), F.col(description).alias("ced_desc"))
        .filter(F.col("ced").isNotNull())
        .withColumn("ced", strip_decimal_zeros("ced"))
    )


def fund_dimension(
    sheet: DataFrame, code="codigo_receita", name="tipo_receita", modality="financiador"
) -> DataFrame:
    return (
        sheet.select(
            F.col(code).alias("fr"), F.col(name).alias("fr_nome"), F.col(modality).alias("fr_modalidade")
        )
        .withColumn("fr", strip_decimal_zeros("fr"))
        .filter(F.col("fr").isNotNull())
    )


def load_dimensions(units_sheet: DataFrame, names_sheet: DataFrame) -> Dimensions:
    """The three lookups; classifier and fund names share one sheet."""
    return Dimensions(
        unit_dimension(units_sheet),
        classifier_dimension(names_sheet),
        fund_dimension(names_sheet),
    )


def unit_codes(units: DataFrame | Lookup) -> DataFrame:
    """The distinct unit codes: the list of units to keep."""
    return rows_of(units).select("codigo_ugb").distinct()
