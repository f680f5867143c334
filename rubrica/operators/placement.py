"""Rows moved once, as they are, to the task of their two-digit group.

Combining rows before they move pays if groups hold many rows.  Where nearly every row is its own
group it sorts all rows in the tasks that read them, and sends each twice as wide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import GROUP_UNIT, KEY_MISSING, PREFIX_LENGTHS, ced_prefix, prefix_group
from ..schema import CLASSIFIER, ROW_ORDER, SOURCE_FILE, UNIT_KEY
from .groups import HASH, group_hash

#: Less input, in bytes as the optimiser estimates them, is not looked at; with fewer rows than LEAST_ROWS nothing changes.
LARGE_BYTES, LEAST_ROWS = 64 << 20, 1 << 20
#: Rows are combined first if a bucket of groups has more than HOT_ROWS and HOT_SHARE mean buckets.
HOT_ROWS, HOT_SHARE, BUCKETS = 1 << 20, 8, 1 << 12
#: The same if groups have more rows than this on average.
MOST_PER_GROUP = 2
#: Rows of one task, so that it sorts them in memory.
TASK_ROWS = 1 << 18

#: Unit key of a row whose grouping form of it is blanked.
OWN_UNIT = "__own_unit"


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def tasks_to_move(rows: DataFrame, key=()) -> int | None:
    """In how many tasks rows are placed whole, or None if they are to be combined, or to meet their totals, elsewhere.

    ``rows`` have the columns of ``place_whole``; ``key`` is what they could be combined by, if they could.  Large
    input is counted by buckets of two-digit groups, so a bucket is never smaller than its largest group.
    """
    needed = {*prefix_group(2), KEY_MISSING, ROW_ORDER, CLASSIFIER, *UNIT_KEY}
    if not needed <= set(rows.columns) or _estimated_bytes(rows) < LARGE_BYTES:
        return None
    bucket = F.pmod(group_hash(prefix_group(2)), F.lit(BUCKETS))
    groups = F.approx_count_distinct(F.xxhash64(*key), 0.2) if key else F.count("*")
    per_bucket = rows.groupBy(bucket.alias("__bucket")).agg(F.count("*").alias("n"), groups.alias("groups"))
    largest, n, groups = per_bucket.agg(F.max("n"), F.sum("n"), F.sum("groups")).first()
    if (n or 0) < LEAST_ROWS or largest > max(HOT_ROWS, HOT_SHARE * n / BUCKETS) or n > MOST_PER_GROUP * groups:
        return None
    return -(-n // TASK_ROWS)


def place_whole(rows: DataFrame, tasks: int, carried) -> DataFrame:
    """Rows in the task of their two-digit group, with grouping columns, OWN_UNIT and the columns ``carried``.

    What the grouping columns say is not sent twice: unit keys travel in their grouping form, longer
    prefixes are cut off again.
    """
    own = F.when(F.col(KEY_MISSING), F.struct(*UNIT_KEY)).alias(OWN_UNIT)
    slim = rows.select(*prefix_group(2), own, ROW_ORDER, CLASSIFIER, *carried)
    # More tasks than the session's default only where there are rows for them.
    many = tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = slim.repartition(tasks, *prefix_group(2)) if many else slim.repartition(*prefix_group(2))
    missing = F.col(OWN_UNIT).isNotNull()
    longer = {f"_c{k}": F.when(~missing, ced_prefix(k)) for k in sorted(PREFIX_LENGTHS) if k > 2}
    return placed.withColumns({HASH: group_hash(prefix_group(2)), KEY_MISSING: missing, **longer})


def own_unit() -> dict[str, Column]:
    """The unit key of placed rows."""
    held = F.col(OWN_UNIT).isNotNull()
    return {c: F.when(held, F.col(f"{OWN_UNIT}.{c}")).otherwise(F.col(g)) for c, g in zip(UNIT_KEY, GROUP_UNIT)}
