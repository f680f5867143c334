"""Net of children in two shuffles, whatever the skew.

1. One aggregation by unit key, classifier prefix and level gives each group's
   metric sums and its first row.  Map tasks combine first, so a unit, file or
   missing-key group with any share of the rows sends few rows.
2. The combined rows move once, to the task of their two-digit group, and windows
   over two, three and four digits give every row the sum to take off.  A
   window holds at most the classifiers under one two-digit prefix, a number that
   does not grow with the data.

The row kept per key is the first by (priority, file order), where the priority
of a row is the lowest number of a level that would list it:

    A  1  (2 where A rows are kept as children only)
    B  2 with an A in its four-digit group, else 3
    C  3 with a B (or a usable fallback) in its three-digit group, else 4
    D  4, if its two-digit group has a C, else a B, else an A; else no row
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import (
    KEY_MISSING, classify_level, derive_keys, has_level, level_bit, prefix_group, with_group_columns,
)
from ..functions.metadata import with_file_metadata
from ..operators.groups import HASH, group_hash
from ..operators.hierarchy import less, prepare_extract
from ..operators.joins import Lookup, flag_units
from ..operators.placement import OWN_UNIT, place_whole, tasks_to_move
from ..schema import (
    CLASSIFIER, KEEP, METRICS, PRODUCTION, ROW_ORDER, SOURCE_FILE, UNIT_KEY, Rules,
)

DERIVED = (
    "ced_base_5", "id_row_ced_5d", "ced_base_4", "id_row_ced_4d",
    "ced_base_3", "id_row_ced_3d", "ced_base_2", "id_row_ced_2d",
)
FLAGS = ("mec_ugb_class", "ced_blank_class", "ced_group", "is_parent")


def net_extract(
    typed: DataFrame, units: DataFrame | Lookup, rules: Rules = PRODUCTION, metrics=METRICS
) -> DataFrame:
    """Typed extract rows -> one netted row per key, all files at once.

    Columns the step does not know are carried along with the row that is kept.
    """
    known = {SOURCE_FILE, ROW_ORDER, *UNIT_KEY, CLASSIFIER, *metrics}
    extras = [c for c in typed.columns if c not in known]
    rows = prepare_extract(typed, units, rules)
    tasks = tasks_to_move(with_group_columns(classify_level(typed), rules), _combine_key(rules))
    if tasks is not None:
        rows = _placed(rows, tasks, rules, metrics, extras)
    kept = _choose(
        _with_totals(_combine(rows, rules, metrics, extras), rules, metrics), rules, metrics
    )
    out = derive_keys(kept)
    if rules.prefilter:
        out = out.withColumns({"mec_ugb_class": F.lit(KEEP), "ced_blank_class": F.lit(KEEP)})
    else:
        out = flag_units(out, units)
    return out.select(
        SOURCE_FILE, ROW_ORDER, "ugb_id", *UNIT_KEY, CLASSIFIER, *metrics, *extras, *DERIVED, *FLAGS
    )


def process_extracts(
    typed: DataFrame, units: DataFrame | Lookup, rules: Rules = PRODUCTION, metrics=METRICS
) -> DataFrame:
    """``net_extract`` with the metadata of each row's report."""
    return with_file_metadata(net_extract(typed, units, rules, metrics), SOURCE_FILE, "fonte_reporte")


def _combine_key(rules: Rules) -> list[str]:
    """What rows are combined by.

    Rules that keep several classifiers of one prefix need the whole classifier
    in the key.
    """
    return [*prefix_group(5), "ced_group", *([CLASSIFIER] if rules.dedup_key != "prefix5" else [])]


def _placed(rows: DataFrame, tasks: int, rules: Rules, metrics, extras) -> DataFrame:
    """Rows moved whole, in the order of their groups, which the windows need as well."""
    placed = classify_level(place_whole(rows, tasks, [*metrics, *extras]))
    return placed.sortWithinPartitions(HASH, *_combine_key(rules))


def _combine(rows: DataFrame, rules: Rules, metrics, extras) -> DataFrame:
    """Sums and first row per unit key, classifier prefix and level.

    Rows that are in the task of their group already stay there.
    """
    placed = HASH in rows.columns
    keys = [*([HASH] if placed else []), *_combine_key(rules)]
    # The unit key is in the group already, unless it was blanked there.
    own = F.col(OWN_UNIT) if placed else F.when(F.col(KEY_MISSING), F.struct(*UNIT_KEY))
    payload = [own.alias("unit"), CLASSIFIER, *metrics, *extras]
    first = F.min(F.struct(ROW_ORDER, *payload)).alias("__first")
    sums = [F.sum(m).alias(f"__sum_{m}") for m in metrics]
    return rows.groupBy(*keys).agg(first, F.count("*").alias("__n"), *sums)


def _present(level: str | None, digits: int) -> Column:
    return has_level(f"__levels{digits}", level)


def _with_totals(combined: DataFrame, rules: Rules, metrics) -> DataFrame:
    """Levels present and child sums of the two-, three- and four-digit group."""
    # One exchange and one sort; every window below needs a prefix of that order.  Report names begin alike,
    # so a hash leads the order and nearly always decides it.
    placed = combined
    if HASH not in combined.columns:
        h2 = group_hash(prefix_group(2))
        placed = combined.repartition(*prefix_group(2)).withColumn(HASH, h2).sortWithinPartitions(HASH, *prefix_group(5))
    w2, w3, w4 = (Window.partitionBy(HASH, *prefix_group(k)) for k in (2, 3, 4))
    level = F.col("ced_group")

    def totals(which: Column | str, w, name: str = "__group_") -> dict[str, Column]:
        return {f"{name}{m}": F.sum(F.when(level == which, F.col(f"__sum_{m}"))).over(w) for m in metrics}

    def levels(digits: int, w) -> dict[str, Column]:
        return {f"__levels{digits}": F.bit_or("__bit").over(w)}

    def taken(df: DataFrame, parent: str, total) -> DataFrame:
        # Of a row's three groups only the one of its own level matters, so one total is carried on.
        held = lambda m: F.col(f"__less_{m}") if f"__less_{m}" in df.columns else F.lit(None)
        out = df.withColumns({f"__less_{m}": F.when(level == parent, total(m)).otherwise(held(m)) for m in metrics})
        return out.drop(*[f"{name}{m}" for name in ("__group_", "__a3_") for m in metrics])

    whole = lambda m: F.col(f"__group_{m}")
    without_b = (lambda m: F.col(f"__a3_{m}")) if rules.c_over_a == "subtract" else lambda m: F.lit(None)
    df = placed.withColumn("__bit", level_bit()).withColumns(levels(2, w2))
    a_below = totals("A", w3, "__a3_") if rules.c_over_a == "subtract" else {}
    df = df.withColumns({**levels(3, w3), **totals("B", w3), **a_below})
    df = taken(df, "C", lambda m: F.when(_present("B", 3), whole(m)).otherwise(without_b(m)))
    df = taken(df.withColumns({**levels(4, w4), **totals("A", w4)}), "B", whole)
    child = F.when(_present("C", 2), "C").when(_present("B", 2), "B").otherwise("A")
    return taken(df.withColumns(totals(child, w2)), "D", whole)


#: A row is chosen by these, the lowest first.
CHOICE = ("__priority", "__stage", ROW_ORDER)


def candidates(totals: DataFrame, rules: Rules, metrics) -> DataFrame:
    """Every combined row with its priority, NULL where no level lists it, and its net value in place of each metric.

    Columns that begin with ``__sum_`` and ``__less_`` are the sum of its rows and what a parent loses.
    """
    level = F.col("ced_group")
    c2, b2, a2 = (_present(name, 2) for name in "CBA")
    b3, a3, a4 = _present("B", 3), _present("A", 3), _present("A", 4)
    known = ~_present(None, 2)
    keep_lone_d, keep_lone_c = F.lit(rules.lone_d == "keep"), F.lit(rules.lone_c == "C")
    c_fallback = known & (a3 | keep_lone_c)
    d_listed = c2 | known & (b2 | a2 | keep_lone_d)

    priority = (
        F.when(level == "A", 1 if rules.a_rows == "own_level" else 2)
        .when(level == "B", F.when(a4, 2).otherwise(3))
        .when(level == "C", F.when(b3 | c_fallback, 3).otherwise(4))
        .when((level == "D") & d_listed, 4)
    )
    # Within one priority the level tables are stacked by fallback stage.
    stage = F.when((level == "C") & ~b3 & c_fallback, 1).when(
        (level == "D") & ~c2, F.when(b2, 1).otherwise(2)
    ).otherwise(0)
    c_nets = b3 | c_fallback if rules.c_over_a == "subtract" else b3
    is_parent = (
        F.when(level == "A", None if rules.a_rows == "own_level" else False)
        .when(level == "B", a4).when(level == "C", c_nets).otherwise(True)
    )

    net = {m: F.when(F.col("is_parent"), less(m, f"__less_{m}")).otherwise(F.col(m)) for m in metrics}
    found = totals.select(
        HASH, *prefix_group(5), level, "__first.*", priority.alias("__priority"), stage.alias("__stage"),
        is_parent.alias("is_parent"), "__n", *[f"__sum_{m}" for m in metrics], *[f"__less_{m}" for m in metrics],
    )
    return found.withColumns({f"__own_{m}": F.col(m) for m in metrics}).withColumns(net)


def choice_key(rules: Rules) -> list[str]:
    """What one row is kept per."""
    return {
        "prefix5": prefix_group(5),
        "unit_ced": [*prefix_group(5), CLASSIFIER],
        "ced": [SOURCE_FILE, CLASSIFIER],
    }[rules.dedup_key]


def placed_key(rules: Rules) -> list[str]:
    """``choice_key`` with the hash of the two-digit group ahead, in whose order the rows are, where the key holds that group."""
    return [*([HASH] if rules.dedup_key != "ced" else []), *choice_key(rules)]


def _choose(totals: DataFrame, rules: Rules, metrics) -> DataFrame:
    """The best candidate per key."""
    found = candidates(totals, rules, metrics).filter(F.col("__priority").isNotNull())
    by_key = choice_key(rules)
    helpers = ("__n", "__sum_", "__less_", "__own_", HASH)
    payload = [c for c in found.columns if c not in by_key and not c.startswith(helpers)]
    best = F.min(F.struct(*CHOICE, *[c for c in payload if c not in CHOICE])).alias("__best")
    kept = found.groupBy(*placed_key(rules)).agg(best).select(*by_key, "__best.*")
    unit = {
        c: F.when(F.col("unit").isNotNull(), F.col(f"unit.{c}")).otherwise(F.col(f"_{c}"))
        for c in UNIT_KEY
    }
    return kept.withColumns(unit).drop("unit", "__priority", "__stage")
