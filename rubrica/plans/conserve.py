"""Netting that loses nothing: every row less its nearest descendants, so that the result sums to the roots.

Classifiers form a tree of prefixes.  The stem of a classifier is what stands before its
trailing zeros, two digits at least; the parent of a row is the row with the longest stem that
its own begins with, in the same file and unit key.  Levels play no part, so a total over
details two levels down is netted like any other, and keys are whole classifiers, so
siblings are never merged.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.groups import HASH, group_hash
from ..operators.hierarchy import less
from ..schema import CLASSIFIER, METRICS, SOURCE_FILE, UNIT_KEY

#: Digits of a stem: the shortest one, and of a whole classifier.
SHORTEST, WHOLE = 2, 6


def stem(ced: Column | str = CLASSIFIER) -> Column:
    """``"111000"`` -> ``"111"``, ``"100000"`` -> ``"10"``."""
    c = F.col(ced) if isinstance(ced, str) else ced
    return F.rpad(F.rtrim(c, F.lit("0")), F.greatest(F.lit(SHORTEST), F.length(F.rtrim(c, F.lit("0")))), F.lit("0"))


def net_conserving(rows: DataFrame, metrics=METRICS) -> DataFrame:
    """One row per file, unit key and classifier, less its nearest descendants.

    Rows of one key are added up first.  ``parent`` is the classifier of the nearest present ancestor, NULL
    for a root; ``n_rows`` counts the rows of the key.  Missing key parts are values like any
    other; rows without classifier are roots without descendants.  A NULL metric counts as
    0 where something is taken off it or it is taken off, and stays NULL otherwise.  So, with NULL as 0, the
    result adds up to its roots, per file and unit key.

    Two exchanges: one by whole key after a combine in each task, and one of the combined rows
    by two-digit stem, where windows over longer and longer prefixes share one sort.  A window holds
    the classifiers under one prefix at most, whatever share of the rows a unit has.
    """
    key = [SOURCE_FILE, *UNIT_KEY]
    combined = rows.groupBy(*key, CLASSIFIER).agg(F.count("*").alias("n_rows"), *[F.sum(m).alias(m) for m in metrics])
    lengths = range(SHORTEST, WHOLE)
    df = combined.withColumn("__stem", stem()).withColumn("__length", F.length("__stem"))
    df = df.withColumns({f"__s{k}": F.substring("__stem", 1, k) for k in lengths})
    group = lambda k: [*key, *[f"__s{i}" for i in range(SHORTEST, k + 1)]]
    # Names begin alike, so a hash leads the sort and nearly always decides it.
    df = df.repartition(*group(SHORTEST)).withColumn(HASH, group_hash(group(SHORTEST)))
    df = df.sortWithinPartitions(HASH, *group(WHOLE - 1), CLASSIFIER)
    over = {k: Window.partitionBy(HASH, *group(k)) for k in lengths}

    # The row that owns each prefix of a stem, if there is one; of "11" and "110000" only one does.
    owner = {f"__o{k}": F.max(F.when(F.col("__length") == k, F.col(CLASSIFIER))).over(over[k]) for k in lengths}
    df = df.withColumns(owner)
    above = [F.when(F.col("__length") > k, F.col(f"__o{k}")) for k in reversed(lengths)]
    up = [F.when((F.col("__length") > k) & F.col(f"__o{k}").isNotNull(), k) for k in reversed(lengths)]
    owns = reduce(or_, [(F.col("__length") == k) & (F.col(CLASSIFIER) == F.col(f"__o{k}")) for k in lengths])
    df = df.withColumns({"parent": F.coalesce(*above), "__up": F.coalesce(*up), "__owns": owns})
    df = df.drop(*owner)
    # What a row loses is what names it as parent; those rows are in its own prefix group, and a row owns one
    # prefix at most, so one total per metric is carried on.
    off = {m: F.lit(None) for m in metrics}
    for k in lengths:
        df = df.withColumns({f"__below_{m}": F.sum(F.when(F.col("__up") == k, F.col(m))).over(over[k]) for m in metrics})
        mine = F.col("__owns") & (F.col("__length") == k)
        df = df.withColumns({f"__less_{m}": F.when(mine, F.col(f"__below_{m}")).otherwise(off[m]) for m in metrics})
        df = df.drop(*[f"__below_{m}" for m in metrics])
        off = {m: F.col(f"__less_{m}") for m in metrics}
    net = {m: F.when(F.col(f"__less_{m}").isNotNull(), less(F.coalesce(m, F.lit(0)), f"__less_{m}")).otherwise(F.col(m)) for m in metrics}
    return df.withColumns(net).select(*key, CLASSIFIER, "parent", "n_rows", *metrics)
