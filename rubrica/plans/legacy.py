"""The earlier long-format pipeline: parents are found by counting rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import all_zero, ced_prefix, drop_all_zero, prefix_group, unit_id, with_group_columns
from ..functions.metadata import with_file_metadata
from ..operators.columns import matching, unpivot
from ..operators.groups import HASH, group_hash, keep_first
from ..operators.hierarchy import less
from ..operators.joins import Lookup, filter_valid, lookup, null_safe_join
from ..schema import (
    BUDGET_METRICS, CLASSIFIER, EXPENSE_METRICS, PRODUCTION, ROW_ORDER, SOURCE_FILE, UNIT_KEY,
)
from ..sources.dimensions import Dimensions
from .enrich import recode_central

# The column order of the long table.
LONG_COLUMNS = (
    SOURCE_FILE, "reporte_tipo", "data_reporte", "data_extraido", "ano", "mes",
    "ugb_id", "funcao", "programa", "fr", "ced", "metrica", "valor",
)
#: Metrics the earlier expense script leaves out of its result.
DROPPED_HELPER = EXPENSE_METRICS[0]


def legacy_base(typed: DataFrame, units: DataFrame, metrics=BUDGET_METRICS) -> DataFrame:
    """Rows of known units with a non-zero metric of the block, deduplicated by amount."""
    block = typed.select(
        SOURCE_FILE, ROW_ORDER, unit_id().alias("ugb_id"), *UNIT_KEY, CLASSIFIER, *metrics
    )
    rows = drop_all_zero(filter_valid(block, units), metrics)
    return with_group_columns(dedup_by_amount(rows, metrics[0]), PRODUCTION)


def dedup_by_amount(df: DataFrame, amount: str, also=()) -> DataFrame:
    """First row per unit key, three digits and amount, and per ``also``.

    The number itself is the key.  A missing part, the amount included, makes the
    whole key missing: one such row per file is kept.
    """
    parts = {**{f"__{c}": F.col(c) for c in UNIT_KEY}, "__c3": ced_prefix(3), "__amount": F.col(amount)}
    present = reduce(and_, [F.col(c).isNotNull() for c in (*UNIT_KEY, CLASSIFIER, amount)])
    keyed = df.withColumn("__present", present).withColumns(
        {name: F.when(F.col("__present"), c) for name, c in parts.items()}
    ).drop("__present")
    return keep_first(keyed, [SOURCE_FILE, *also, *parts]).drop(*parts)


def legacy_adjust(base: DataFrame, metrics=BUDGET_METRICS, also=()) -> DataFrame:
    """Rows of multi-row groups with parents netted, and the rows outside any group; groups are within ``also``.

    * four digits shared by several rows: rows ending in ``000`` less the others;
    * three digits shared by several rows, one of which is alone in its four
      digits: rows ending in ``00`` less the others, all rows of the group, so
      rows of the first kind are listed twice;
    * the rest as it is.

    Sums of the three-digit groups come from those of the four-digit groups, of
    which one has as many as there are digits.  ``part`` tells the three apart.
    """
    g4, g3 = [*also, *prefix_group(4)], [*also, *prefix_group(3)]
    ced = F.col(CLASSIFIER)
    per4 = base.groupBy(*g4).agg(
        F.count("*").alias("__n4"),
        *[F.sum(F.when(~ced.endswith("000"), F.col(m))).alias(f"__s4_{m}") for m in metrics],
        *[F.sum(F.when(~ced.endswith("00"), F.col(m))).alias(f"__p3_{m}") for m in metrics],
    )
    w3 = Window.partitionBy(*g3)
    stats = per4.withColumns({
        "__in4": F.col("__n4") > 1,
        "__in3": (F.sum("__n4").over(w3) > 1) & F.max(F.col("__n4") == 1).over(w3),
        **{f"__s3_{m}": F.sum(f"__p3_{m}").over(w3) for m in metrics},
    }).drop("__n4", *[f"__p3_{m}" for m in metrics])
    rows = null_safe_join(base, stats, g4)
    return _net_parts(rows, metrics).select(*base.columns, "part")


def _net_parts(rows: DataFrame, metrics) -> DataFrame:
    """Rows with the sums and marks of their groups -> one line for each part that holds the row."""
    ced = F.col(CLASSIFIER)
    in4, in3 = F.col("__in4"), F.col("__in3")
    named = lambda *names: F.array(*map(F.lit, names))
    parts = (
        F.when(in4 & in3, named("4d", "3d")).when(in4, named("4d")).when(in3, named("3d"))
        .otherwise(named("leaf"))
    )
    out = rows.withColumn("part", F.explode(parts))
    four = (F.col("part") == "4d") & ced.endswith("000")
    three = (F.col("part") == "3d") & ced.endswith("00")
    net = {
        m: F.when(four, less(m, f"__s4_{m}")).when(three, less(m, f"__s3_{m}")).otherwise(F.col(m))
        for m in metrics
    }
    return out.withColumns(net)


def legacy_block(
    typed: DataFrame, units: DataFrame, metrics=BUDGET_METRICS, drop_helper: bool = False
) -> DataFrame:
    """One metric block as a long table.

    ``drop_helper`` leaves the paid-expense metric out of the result, as the
    earlier expense script does after using it as a key.
    """
    adjusted = legacy_adjust(legacy_base(typed, units, metrics), metrics)
    shown = [m for m in metrics if not (drop_helper and m == DROPPED_HELPER)]
    slim = adjusted.select(SOURCE_FILE, "ugb_id", "funcao", "programa", "fr", "ced", *shown)
    # Metadata before the unpivot: it is worked out once per row, not once per metric.
    return unpivot(with_file_metadata(slim, SOURCE_FILE), shown).select(*LONG_COLUMNS)


BLOCKS = (BUDGET_METRICS, EXPENSE_METRICS)


#: A group is hot if its rows and those of all groups that share its bucket are more than this, and than HOT_SHARE mean buckets.
HOT_ROWS, HOT_SHARE, BUCKETS = 1 << 20, 8, 1 << 16


def has_hot_group(typed: DataFrame, most: int = HOT_ROWS) -> bool:
    """Whether the rows of some unit and three digits of a report may be too many for one window.

    Counts all rows by buckets of such groups, combined in each task, so a bucket is never smaller than its largest group.
    """
    bucket = F.pmod(F.xxhash64(SOURCE_FILE, "ugb", ced_prefix(3)), F.lit(BUCKETS))
    per_bucket = typed.filter(F.col(CLASSIFIER).isNotNull()).groupBy(bucket.alias("__bucket")).agg(F.count("*").alias("n"))
    largest, n = per_bucket.agg(F.max("n"), F.sum("n")).first()
    return (largest or 0) > max(most, HOT_SHARE * (n or 0) / BUCKETS)


def _shared(blocks) -> list[str]:
    return [f"__m{i}" for i in range(max(map(len, blocks)))]


def _by_block(rows: DataFrame, blocks, keep) -> DataFrame:
    """A row for each block of which ``keep(i)`` holds; the metrics of the blocks share columns."""
    cell = lambda block, k: F.col(block[k]) if k < len(block) else F.lit(None).cast(rows.schema[block[0]].dataType)
    held = [
        F.struct(F.lit(i).alias("__block"), F.coalesce(keep(i), F.lit(False)).alias("__keep"),
                 *[cell(block, k).alias(m) for k, m in enumerate(_shared(blocks))])
        for i, block in enumerate(blocks)
    ]
    metrics = {m for block in blocks for m in block}
    out = rows.select(*[c for c in rows.columns if c not in metrics], F.inline(F.array(*held)))
    return out.filter("__keep").drop("__keep")


def legacy_adjusted(typed: DataFrame, units: DataFrame | Lookup, blocks=(BUDGET_METRICS,), most: int = HOT_ROWS) -> DataFrame:
    """``legacy_adjust`` of ``legacy_base`` of each block, whose metrics share the columns ``__m0``, ``__m1``, ...

    Rows move once, whole, to the task of their unit key and three digits; dedup and totals are windows there. The rows
    with a missing key, of which one per report and block is kept, are combined in each task instead, whatever their
    number. With a hot group the rows meet their totals in a join, whose hot groups AQE splits.
    """
    shared, also = _shared(blocks), ["__block"]
    metrics = [m for block in blocks for m in block]
    rows = filter_valid(typed.withColumn("ugb_id", unit_id()), units).select(
        SOURCE_FILE, ROW_ORDER, "ugb_id", *UNIT_KEY, CLASSIFIER, *metrics)
    listed = lambda i: ~all_zero(blocks[i])
    if has_hot_group(typed, most):
        base = dedup_by_amount(_by_block(rows, blocks, listed), shared[0], also)
        return legacy_adjust(with_group_columns(base, PRODUCTION), shared, also)

    has_unit = reduce(and_, [F.col(c).isNotNull() for c in UNIT_KEY])
    whole = lambda i: has_unit & F.col(blocks[i][0]).isNotNull()
    missing = _by_block(rows.filter(~reduce(and_, map(whole, range(len(blocks))))), blocks, lambda i: listed(i) & ~whole(i))
    firsts = dedup_by_amount(missing, shared[0], also)
    own = [F.when(F.col("__block") == i, F.col(shared[k])).alias(m) for i, block in enumerate(blocks) for k, m in enumerate(block)]
    firsts = firsts.select(*[c for c in rows.columns if c not in metrics], *own, F.lit(True).alias("__first"))

    g3 = prefix_group(3)
    placed = with_group_columns(rows.filter(has_unit).withColumn("__first", F.lit(False)).unionByName(firsts), PRODUCTION)
    placed = placed.drop("_c5").repartition(*g3).withColumn(HASH, group_hash(g3))
    split = _by_block(placed, blocks, lambda i: listed(i) & (F.col("__first") | F.col(blocks[i][0]).isNotNull()))
    # Ties are broken by the rest of the row, as in keep_first.
    order = (ROW_ORDER, "ugb_id", *UNIT_KEY, CLASSIFIER, *shared)
    key = [HASH, *g3, *also]
    first = F.row_number().over(Window.partitionBy(*key, shared[0]).orderBy(*order))
    base = split.withColumn("__nth", first).filter("__nth = 1").drop("__nth")

    ced = F.col(CLASSIFIER)
    w4, w3 = Window.partitionBy(*key, "_c4"), Window.partitionBy(*key)
    stats = base.withColumns({
        "__n4": F.count("*").over(w4),
        **{f"__s4_{m}": F.sum(F.when(~ced.endswith("000"), F.col(m))).over(w4) for m in shared},
    }).withColumns({
        "__in4": F.col("__n4") > 1,
        "__in3": (F.count("*").over(w3) > 1) & F.max(F.col("__n4") == 1).over(w3),
        **{f"__s3_{m}": F.sum(F.when(~ced.endswith("00"), F.col(m))).over(w3) for m in shared},
    })
    return _net_parts(stats, shared).select(SOURCE_FILE, ROW_ORDER, "ugb_id", *UNIT_KEY, CLASSIFIER, *also, *shared, "part")


def legacy_long(typed: DataFrame, units: DataFrame | Lookup, drop_helper: bool = False) -> DataFrame:
    """Budget and expense block of all files, one below the other: ``legacy_block`` of both in one pass."""
    shared = _shared(BLOCKS)
    slim = legacy_adjusted(typed, units, BLOCKS).select(
        SOURCE_FILE, "ugb_id", "funcao", "programa", "fr", "ced", "__block", *shared)
    # Metadata before the unpivot: it is worked out once per row, not once per metric.
    slim = with_file_metadata(slim, SOURCE_FILE)
    named = F.lit(None)
    for i, block in enumerate(BLOCKS):
        cells = [F.struct(F.lit(m).alias("metrica"), F.col(shared[k]).alias("valor"))
                 for k, m in enumerate(block) if not (drop_helper and m == DROPPED_HELPER)]
        named = F.when(F.col("__block") == i, F.array(*cells)).otherwise(named)
    return slim.withColumn("__cell", F.explode(named)).select(
        *LONG_COLUMNS[:-2], "__cell.metrica", "__cell.valor")


def enrich_long(long: DataFrame, dims: Dimensions) -> DataFrame:
    """The long table with unit and classifier names, in published order."""
    df = lookup(long, dims.ugb, {"ugb_id": "codigo_ugb"})
    df = recode_central(lookup(df, dims.ced, {"ced": "ced"}))
    df = df.withColumnRenamed(SOURCE_FILE, "ficheiro_fonte")
    return df.select(
        "ficheiro_fonte", "adm2020_24", "adm2025_29", "reporte_tipo", *matching(df, "data_*"),
        "ano", "mes", "ugb_id", "funcao", "programa", "fr", *matching(df, "ced*"),
        "nivel_da_instituicao", "ambito", "provincia", "distrito", "metrica", "valor",
    )


def leaf_expense(typed: DataFrame, dims: Dimensions, metric: str = EXPENSE_METRICS[-1]) -> DataFrame:
    """Rows of the finest level with one expense metric and their unit's names."""
    leaves = typed.filter(F.col("ced").isNotNull() & ~F.col("ced").endswith("00")).select(
        F.substring("ugb", 1, 9).alias("ugb_id"), "funcao", "programa", "fr", "ced",
        F.substring("ced", 1, 4).alias("ced_area"), F.lit(metric).alias("metrica"),
        F.col(metric).alias("valor"),
    )
    return lookup(leaves, dims.ugb, {"ugb_id": "codigo_ugb"}).select(
        "ugb_id", F.col("nome_ugb").alias("ugb_nome"), "funcao", "programa",
        "nivel_da_instituicao", "provincia", "distrito", "fr", "ced", "ced_area", "metrica", "valor",
    )
