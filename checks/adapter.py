"""Budget extracts and lookups as views over the test tables.

One SQL text serves both engines: Spark fills the braces with DataFrames, the
oracle with table names.  Every view is a projection of whole tables, so the
work of a query grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rubrica.schema import METRICS, ROW_ORDER
from rubrica.sources.dimensions import Dimensions, load_dimensions
from rubrica.sources.extracts import type_extract
from rubrica.sources.sinks import ordered, write_csv

#: Unique in the test tables; they stand for the place of a row in its file.
FILE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def _classifier(part: str) -> str:
    """The first five digits of a classifier as a number, from a part key."""
    return (
        f"100000 + 10000 * (1 + {part} % 2) + 1000 * (1 + {part} % 5 % 2) + 100 * ({part} % 3) "
        f"+ 10 * ({part} % 7 % 2)"
    )


#: Whole amounts: sums of them are exact in floating point, in any order.
_AMOUNTS = (
    "price", "price + quantity", "price - quantity", "price + tax", "quantity",
    "quantity + discount", "quantity - tax", "price - tax", "discount - tax", "discount",
    "price - discount",
)


def _cell(i: int, amount: str) -> str:
    # Zero lines, and cells that are no number in a different column per line.
    return (
        f"CASE WHEN l_orderkey % 13 = 0 THEN '0' WHEN l_orderkey % 97 = {i} THEN 'n/d' "
        f"ELSE CAST({amount} AS STRING) || '.50' END AS {METRICS[i]}"
    )


EXTRACT = f"""
SELECT 'DemonstrativoConsolidado' || CASE l_returnflag WHEN 'A' THEN 'OrcamentoFuncionamento'
      WHEN 'N' THEN 'InvestimentoCompInterna' ELSE 'InvestimentoCompExterna' END
    || '_' || CAST(year(l_shipdate) AS STRING) || '0831_'
    || CAST(year(l_shipdate) AS STRING) || '0905.csv' AS source_file,
  {", ".join(FILE_ORDER)},
  '50A' || lpad(CAST(l_suppkey AS STRING), 6, '0') || ' - UNIDADE ' || CAST(l_suppkey AS STRING) AS ugb,
  '0' || CAST(l_suppkey % 5 AS STRING) || ' - FUNCAO' AS funcao,
  ' ' || l_linestatus || ' ' AS programa,
  CASE WHEN l_orderkey % 89 = 0 THEN ' ' ELSE '10' || CAST(l_linenumber % 2 AS STRING) END AS fr,
  CASE WHEN l_orderkey % 41 = 0 THEN '' ELSE CAST(d - d % z AS STRING) END AS ced,
  {", ".join(_cell(i, a) for i, a in enumerate(_AMOUNTS))},
  CAST(discount AS STRING) AS execucao_percent
FROM (SELECT *, {_classifier('l_partkey')} + l_orderkey % 3 AS d,
    CASE l_orderkey % 4 WHEN 0 THEN 10000 WHEN 1 THEN 1000 WHEN 2 THEN 100 ELSE 1 END AS z,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS price, CAST(round(l_quantity) AS BIGINT) AS quantity,
    CAST(round(l_discount * 100) AS BIGINT) AS discount, CAST(round(l_tax * 100) AS BIGINT) AS tax
  FROM {{lineitem}}) t"""

UNITS_SHEET = """
SELECT '50A' || lpad(CAST(s_suppkey AS STRING), 6, '0') AS codigo_ugb, s_name AS nome_ugb,
  'A' || CAST(s_suppkey % 3 AS STRING) AS ambito,
  CASE WHEN r_name = 'ASIA' THEN '-' ELSE r_name END AS provincia,
  CASE WHEN s_suppkey % 7 = 0 THEN '-' ELSE n_name || '-' || r_name || ' (SEDE)' END AS distrito,
  'P' || CAST(s_nationkey AS STRING) AS adm2020_24,
  'Q' || CAST(s_nationkey AS STRING) AS adm2025_29,
  'N' || CAST(s_suppkey % 2 AS STRING) AS nivel_da_instituicao,
  s_acctbal AS observacao
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
WHERE s_suppkey % 5 <> 0"""

# Classifier and fund names share a sheet, each leaving the other's cells empty.
# A code of the first two digits "11" was stored as a number and ends in ".0".
NAMES_SHEET = f"""
WITH prefixes AS (SELECT DISTINCT {_classifier('p_partkey')} AS p FROM {{part}}),
codes AS (
  SELECT CAST(p AS STRING) AS c FROM prefixes UNION SELECT CAST(p + 1 AS STRING) FROM prefixes
  UNION SELECT CAST(p - p % 100 AS STRING) FROM prefixes
  UNION SELECT CAST(p - p % 1000 AS STRING) FROM prefixes
  UNION SELECT CAST(p - p % 10000 AS STRING) FROM prefixes)
SELECT c || CASE WHEN substr(c, 1, 2) = '11' THEN '.0' ELSE '' END AS codigo,
  'Classificador ' || c AS designacao,
  CAST(NULL AS STRING) AS codigo_receita, CAST(NULL AS STRING) AS tipo_receita,
  CAST(NULL AS STRING) AS financiador
FROM codes
UNION ALL
SELECT NULL, NULL, '10' || CAST(r_regionkey AS STRING) || CASE WHEN r_regionkey = 0 THEN '.00' ELSE '' END,
  'Receita ' || r_name, CASE WHEN r_regionkey = 1 THEN 'Externo' ELSE 'Interno' END
FROM {{region}}"""


#: Printed before each report name: characters that paths encode.
NAME_PREFIX = "R#1 50% + "

#: Header cells of the lookup sheets as they are printed.
UNITS_HEADER = (
    "Código UGB", "Nome UGB", "Âmbito", "Província", "Distrito", "Adm2020_24", "Adm2025_29",
    "Nível da Instituição", "Observação",
)
NAMES_HEADER = ("Código", "Designação", "Código Receita", "Tipo Receita", "Financiador")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give the scan of a file with fewer splits than cores to all cores.

    A test table is one row group, which one task reads.  A table of many files
    is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def _view(spark, sf_dir, template, *names) -> DataFrame:
    return spark.sql(template, **{n: table(spark, sf_dir, n) for n in names})


def raw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract as its files would give it: text cells, report name, place in the file."""
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    df = spark.sql(EXTRACT, lineitem=lines)
    order = F.struct(*FILE_ORDER).alias(ROW_ORDER)
    return df.select("source_file", order, *[c for c in df.columns if c not in ("source_file", *FILE_ORDER)])


def typed_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_extract(raw_extract(spark, sf_dir).drop("execucao_percent"))


def write_reports(raw: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Reports as folders of CSV parts whose rows are in the order of the report."""
    named = raw.withColumn("source_file", F.concat(F.lit(NAME_PREFIX), "source_file"))
    write_csv(ordered(named, ["source_file"], [ROW_ORDER]).drop(ROW_ORDER), folder, ["source_file"], mode)


def write_sheet(sheet: DataFrame, header, folder: str) -> None:
    """A lookup sheet as one CSV file with a line above its header."""
    spark = sheet.sparkSession
    cells = [F.col(c).cast("string") for c in sheet.columns]
    lines = sheet.select(F.lit(2).alias("n"), F.to_csv(F.struct(*cells), {"escape": '"', "nullValue": ""}).alias("line"))
    head = spark.createDataFrame([(0, "Sistema de Administração Financeira"), (1, ",".join(header))], "n int, line string")
    head.unionByName(lines).orderBy("n", "line").coalesce(1).select("line").write.text(folder)


def units_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, UNITS_SHEET, "supplier", "nation", "region")


def names_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, NAMES_SHEET, "part", "region")


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return load_dimensions(units_sheet(spark, sf_dir), names_sheet(spark, sf_dir))
