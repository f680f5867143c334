"""Parents minus children, level by level.

These are the single steps of the netting; each returns all rows of its level.
``plans.net`` gives the same result as all of them together with less shuffling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import (
    GROUP_UNIT, KEY_MISSING, PREFIX_LENGTHS, classify_level, derive_keys, has_level, level_bit, prefix_group,
    with_group_columns,
)
from ..schema import CLASSIFIER, KEEP, METRICS, PRODUCTION, ROW_ORDER, SOURCE_FILE, UNIT_KEY, Rules
from .groups import HASH, keep_first
from .joins import Lookup, filter_valid, flag_units, null_safe_join
from .placement import OWN_UNIT, own_unit, place_whole, tasks_to_move

PRIORITY = {"A": 1, "B": 2, "C": 3, "D": 4}
#: The level whose rows are netted in groups of so many digits.
PARENT = {2: "D", 3: "C", 4: "B"}


def prepare_extract(typed: DataFrame, units: DataFrame | Lookup, rules: Rules = PRODUCTION) -> DataFrame:
    """Typed rows with keys, flags, level and grouping columns, filtered if the rules say so."""
    df = derive_keys(typed)
    if rules.prefilter:
        df = filter_valid(df, units).withColumns({
            "mec_ugb_class": F.lit(KEEP), "ced_blank_class": F.lit(KEEP),
        })
    else:
        df = flag_units(df, units)
    return with_group_columns(classify_level(df), rules)


#: What ``derive_keys`` and ``with_group_columns`` make of unit key and classifier.
IDS = ("ugb_id", *[f"{name}_{k}{d}" for k in PREFIX_LENGTHS for name, d in (("ced_base", ""), ("id_row_ced", "d"))])
GROUPING = (*GROUP_UNIT, KEY_MISSING, *[f"_c{k}" for k in PREFIX_LENGTHS])


def _in_place(df: DataFrame, tasks: int) -> DataFrame:
    """Prepared rows moved whole, in the order of their groups; the ids, which are long, stay behind."""
    own = (SOURCE_FILE, ROW_ORDER, *UNIT_KEY, CLASSIFIER, *IDS, *GROUPING)
    return place_whole(df, tasks, [c for c in df.columns if c not in own]).sortWithinPartitions(HASH, *prefix_group(5))


def _with_ids(df: DataFrame) -> DataFrame:
    """Rows moved whole with unit key and ids again."""
    return derive_keys(df.withColumns(own_unit()))


def _total(metric: str) -> str:
    return f"__sum_{metric}"


def less(metric: Column | str, children: Column | str) -> Column:
    """A parent without its children: a NULL parent stays NULL, no children count as 0."""
    metric = F.col(metric) if isinstance(metric, str) else metric
    return metric - F.coalesce(children, F.lit(0))


def subtract_children(
    df: DataFrame, group, is_parent: Column, metrics=METRICS, flag: str = "is_parent"
) -> DataFrame:
    """Take the sum of all non-parent rows of a group off each of its parent rows.

    Two passes over the input: one for the totals, combined on the map side, and
    one joined to them, a join whose hot groups AQE splits.
    """
    df = df.withColumn(flag, is_parent).filter(F.col(flag).isNotNull())
    totals = (
        df.filter(~F.col(flag)).groupBy(*group).agg(*[F.sum(m).alias(_total(m)) for m in metrics])
    )
    joined = null_safe_join(df, totals, list(group), "left")
    return joined.withColumns(
        {m: F.when(F.col(flag), less(m, _total(m))).otherwise(F.col(m)) for m in metrics}
    ).select(df.columns)


# Levels, parent suffix and prefix length of the group.
PAIRS = {"CD": ("0000", 2), "BC": ("000", 3), "AB": ("00", 4)}


def collapse_pairs(df: DataFrame, pairs=tuple(PAIRS), metrics=METRICS) -> DataFrame:
    """Pairs of neighbouring levels, the upper less the lower, without a presence test.

    A row comes back once for each pair that holds its level, named in ``pair``;
    all pairs together take two passes over the input.  Large input without hot groups moves
    once, whole, and its totals are windows.
    """
    for pair in pairs:
        if pair not in PAIRS:
            raise ValueError(f"pair must be one of {sorted(PAIRS)}, not {pair!r}")
    tasks = tasks_to_move(df)
    if tasks is not None:
        return _collapse_in_place(df, tasks, pairs, metrics)
    held = [F.when(F.col("ced_group").isin(*p), F.lit(p)) for p in pairs]
    rows = df.withColumns({
        "ced": F.trim("ced"), "pair": F.explode(F.array_compact(F.array(*held))),
    })
    of_pair = lambda value: F.coalesce(*[F.when(F.col("pair") == p, value(*PAIRS[p])) for p in pairs])
    # The longest prefix stands for the shorter ones.
    rows = rows.withColumn("__prefix", of_pair(lambda _, digits: F.col(f"_c{digits}")))
    upper = of_pair(lambda suffix, _: F.col("ced").endswith(suffix))
    return subtract_children(rows, [*prefix_group(1), "pair", "__prefix"], upper, metrics).drop("__prefix")


def _collapse_in_place(df: DataFrame, tasks: int, pairs, metrics) -> DataFrame:
    """``collapse_pairs`` with each row's totals from the windows of its pairs."""
    ced, level = F.trim(CLASSIFIER), F.col("ced_group")
    out = _in_place(df, tasks)
    lines = []
    for pair in pairs:
        suffix, digits = PAIRS[pair]
        held, upper = level.isin(*pair), ced.endswith(suffix)
        over = Window.partitionBy(HASH, *prefix_group(digits))
        total = {f"__group_{m}": F.sum(F.when(held & ~upper, F.col(m))).over(over) for m in metrics}
        # As numbers, not as lines, so that rows between the windows stay narrow.
        out = out.withColumns(total).withColumns({
            f"__{pair}_{m}": F.when(held & upper, less(m, f"__group_{m}")) for m in metrics}).drop(*total)
        net = [F.when(upper, F.col(f"__{pair}_{m}")).otherwise(F.col(m)).alias(m) for m in metrics]
        lines.append(F.when(held & upper.isNotNull(), F.struct(*net, F.lit(pair).alias("pair"), upper.alias("is_parent"))))
    out = out.withColumn("__line", F.explode(F.array_compact(F.array(*lines))))
    out = _with_ids(out).withColumn(CLASSIFIER, ced)
    return out.select(*[F.col(f"__line.{c}") if c in metrics else F.col(c) for c in df.columns],
                      "__line.pair", "__line.is_parent")


def collapse_one_level(df: DataFrame, pair: str, metrics=METRICS) -> DataFrame:
    """One pair of neighbouring levels; see ``collapse_pairs``."""
    return collapse_pairs(df, (pair,), metrics).drop("pair")


def residual_parents(df: DataFrame, pairs, metrics=METRICS) -> DataFrame:
    """Only the upper rows of ``collapse_pairs``: what is left of each total."""
    return collapse_pairs(df, pairs, metrics).filter(F.col("ced_group") == F.substring("pair", 2, 1))


def _level(
    df: DataFrame, parent: str, children: str, digits: int, metrics, subtracted: str, lone: bool
) -> DataFrame:
    """One level: a group's parents less its first level present among ``children``.

    Children below the first one present are left out of the group.  ``lone``
    keeps parents of groups without any child.  A row without a level (only in
    unfiltered data, where its key is NULL) makes the absence of a child
    unknown, so its group gets no fallback.
    """
    group = prefix_group(digits)
    level = F.col("ced_group")
    rank = reduce(
        lambda acc, c: acc.when(level == c, F.lit(len(children) - children.index(c))),
        children, F.when(level.isNull(), F.lit(0)),
    ).otherwise(F.lit(-1))
    per_level = df.groupBy(*group, level.alias("__child"), rank.alias("__rank")).agg(
        *[F.sum(m).alias(_total(m)) for m in metrics]
    )
    best = F.max(F.struct("__rank", "__child", *[_total(m) for m in metrics])).alias("__best")
    unknown = F.bool_or(F.col("__rank") == 0).alias("__unknown")
    stats = per_level.groupBy(*group).agg(best, unknown).select(*group, "__best.*", "__unknown")
    usable = (F.col("__rank") == len(children)) | ~F.col("__unknown")
    stats = stats.filter(usable).drop("__unknown")

    has_child = F.col("__rank") > 0
    is_parent = level == parent
    keep = (level == F.col("__child")) & has_child | is_parent & (has_child | F.lit(lone))
    rows = null_safe_join(df.filter(level.isin(parent, *children)), stats, group).filter(keep)

    # Without a child the fallback of last resort applies, which takes off nothing.
    applied = F.when(has_child, F.col("__child")).otherwise(F.lit(children[-1]))
    nets = is_parent & applied.isin(*subtracted)
    branch = F.when(has_child, F.lit(len(children)) - F.col("__rank")).otherwise(
        F.lit(len(children) - 1)
    )
    total = lambda m: F.when(has_child, F.col(_total(m)))
    out = rows.withColumns({
        **{m: F.when(nets, less(m, total(m))).otherwise(F.col(m)) for m in metrics},
        "is_parent": nets,
        "__branch": branch,
    })
    return out.select(*df.columns, "is_parent", "__branch")


def level_d(df: DataFrame, rules: Rules = PRODUCTION, metrics=METRICS) -> DataFrame:
    """D less C; where a group has no C less B, and without B less A."""
    return _level(df, "D", "CBA", 2, metrics, "CBA", rules.lone_d == "keep")


def level_c(df: DataFrame, rules: Rules = PRODUCTION, metrics=METRICS) -> DataFrame:
    """C less B; with only A below, C as it is or less A by the rules."""
    subtracted = "BA" if rules.c_over_a == "subtract" else "B"
    return _level(df, "C", "BA", 3, metrics, subtracted, rules.lone_c == "C")


def level_b(df: DataFrame, rules: Rules = PRODUCTION, metrics=METRICS) -> DataFrame:
    """B less A, in groups that have an A."""
    return _level(df, "B", "A", 4, metrics, "A", False)


def level_a(df: DataFrame, rules: Rules = PRODUCTION, metrics=METRICS) -> DataFrame:
    """All A rows as they are; none where the rules keep them as children only."""
    rows = df.filter(F.col("ced_group") == "A" if rules.a_rows == "own_level" else F.lit(False))
    return rows.withColumns({"is_parent": F.lit(None).cast("boolean"), "__branch": F.lit(0)})


def _role(parent: str, children: str, digits: int, metrics, subtracted: str, lone: bool) -> Column:
    """A row's line in the table of one level, NULL if it has none there; see ``_level``, whose rows these are."""
    level, mask = F.col("ced_group"), F.col(f"__mask{digits}")
    child = F.col(f"__child{digits}")
    # Rows without a level make the absence of the first child unknown.
    usable = F.coalesce(child == children[0], F.lit(False)) | ~has_level(mask, None)
    is_parent = level == parent
    listed = usable & (F.coalesce(level == child, F.lit(False)) | is_parent & (child.isNotNull() | F.lit(lone)))
    nets = is_parent & F.coalesce(child, F.lit(children[-1])).isin(*subtracted)
    stage = F.lit(len(children) - 1)
    for i, name in enumerate(children):
        stage = F.when(child == name, i).otherwise(stage)
    net = [F.when(nets, less(m, f"__less_{m}")).otherwise(F.col(m)).alias(m) for m in metrics]
    return F.when(listed, F.struct(
        *net, nets.alias("is_parent"), stage.alias("__branch"), F.lit(PRIORITY[parent]).alias("level_priority")))


def _first_child(children: str, digits: int) -> Column:
    out = F.lit(None).cast("string")
    for name in reversed(children):
        out = F.when(has_level(f"__mask{digits}", name), F.lit(name)).otherwise(out)
    return out


def _with_losses(rows: DataFrame, below, group, metrics) -> DataFrame:
    """Rows with the levels and first children of their groups, and what their own level loses."""
    level = F.col("ced_group")
    # A row is a parent on its own level alone, so one total per metric is carried on.
    off = {m: F.lit(None) for m in metrics}
    for digits, children in below.items():
        over = Window.partitionBy(*group(digits))
        rows = rows.withColumn(f"__mask{digits}", F.bit_or("__bit").over(over))
        rows = rows.withColumn(f"__child{digits}", _first_child(children, digits))
        child = F.col(f"__child{digits}")
        rows = rows.withColumns({f"__group_{m}": F.sum(F.when(level == child, F.col(m))).over(over) for m in metrics})
        rows = rows.withColumns({
            f"__less_{m}": F.when(level == PARENT[digits], F.col(f"__group_{m}")).otherwise(off[m]) for m in metrics})
        rows = rows.drop(*[f"__group_{m}" for m in metrics])
        off = {m: F.col(f"__less_{m}") for m in metrics}
    return rows


def union_levels(df: DataFrame, rules: Rules = PRODUCTION, metrics=METRICS) -> DataFrame:
    """The four levels one below the other, with their priority.

    Two passes over the input.  One adds up each level of each four-digit group, combined on the map
    side; sums and levels of the three- and two-digit groups come from those few rows.  The other
    joins every row to what its level loses and to the levels of its three groups, in a join whose hot
    groups AQE splits, and turns it into its lines: as a total on its own level, as a child on coarser ones.
    Large input without hot groups moves once, whole, and the sums are windows.  Rows are those of ``prepare_extract``.
    """
    below = {2: "CBA", 3: "BA", 4: "A"}
    level = F.col("ced_group")
    g4 = prefix_group(4)
    tasks = tasks_to_move(df)
    if tasks is None:
        sums = df.groupBy(*g4, "ced_group").agg(*[F.sum(m).alias(m) for m in metrics])
        sums = sums.withColumn("__bit", level_bit()).repartition(*prefix_group(2)).sortWithinPartitions(*g4)
        sums = _with_losses(sums, below, prefix_group, metrics)
        told = [f"__{what}{digits}" for digits in below for what in ("mask", "child")]
        stats = sums.filter(level.isNotNull()).select(*g4, "ced_group", *told, *[f"__less_{m}" for m in metrics])
        rows = null_safe_join(df.filter(level.isNotNull()), stats, [*g4, "ced_group"])
    else:
        placed = _in_place(df, tasks).withColumn("__bit", level_bit())
        rows = _with_losses(placed, below, lambda digits: [HASH, *prefix_group(digits)], metrics).filter(level.isNotNull())

    own_a = F.struct(*[F.col(m).alias(m) for m in metrics], F.lit(None).cast("boolean").alias("is_parent"),
                     F.lit(0).alias("__branch"), F.lit(PRIORITY["A"]).alias("level_priority"))
    lines = [
        _role("D", below[2], 2, metrics, "CBA", rules.lone_d == "keep"),
        _role("C", below[3], 3, metrics, "BA" if rules.c_over_a == "subtract" else "B", rules.lone_c == "C"),
        _role("B", below[4], 4, metrics, "A", False),
        F.when((level == "A") & F.lit(rules.a_rows == "own_level"), own_a),
    ]
    out = rows.withColumn("__line", F.explode(F.array_compact(F.array(*lines))))
    out = out if tasks is None else _with_ids(out)
    return out.select(*[F.col(f"__line.{c}") if c in metrics else F.col(c) for c in df.columns],
                      "__line.is_parent", "__line.__branch", "__line.level_priority")


def dedup_keys(rules: Rules) -> list[str]:
    if rules.dedup_key == "ced":
        return [SOURCE_FILE, "ced"]
    return [*prefix_group(5), *(["ced"] if rules.dedup_key == "unit_ced" else [])]


def prioritise(levels: DataFrame, rules: Rules = PRODUCTION) -> DataFrame:
    """One row per key: lowest priority number, then file order.

    The ids are made again for the rows that are kept, as they are long and say what unit key and classifier say.
    """
    order = ("level_priority", "__branch", ROW_ORDER)
    kept = keep_first(levels.drop(*IDS), dedup_keys(rules), order)
    return derive_keys(kept).select(*[c for c in levels.columns if c not in order[:2]])
