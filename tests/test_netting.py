"""Netting: worked examples, a random comparison with a plain model, and the plans."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from rubrica import schema as S
from rubrica.operators import hierarchy as H
from rubrica.plans import legacy as L
from rubrica.plans.net import net_extract

from .model import net as model_net

METRIC = "dotacao_inicial"
SCHEMA = (
    "source_file string, row_order bigint, ugb string, funcao string, programa string, fr string, "
    f"ced string, {METRIC} double"
)
UNIT = "50A000001 - X"
RULES = {
    "production": S.PRODUCTION,
    "unfiltered": S.UNFILTERED,
    "second": S.SECOND_GENERATION,
    "second_all_a": S.SECOND_GENERATION_ALL_A,
    "by_classifier": S.BY_CLASSIFIER,
    "unit_ced": S.PRODUCTION.but(dedup_key="unit_ced"),
    "c_less_a": S.PRODUCTION.but(c_over_a="subtract"),
    "lone_d": S.PRODUCTION.but(lone_d="keep"),
    "lone_c": S.UNFILTERED.but(lone_c="C"),
    "separate": S.PRODUCTION.but(null_keys="separate"),
    "separate_unfiltered": S.UNFILTERED.but(null_keys="separate", lone_d="keep"),
}


def typed(spark, rows):
    return spark.createDataFrame(
        [(r["file"], r["pos"], r["ugb"], r["funcao"], r["programa"], r["fr"], r["ced"], r["x"]) for r in rows],
        SCHEMA,
    )


def line(pos, ced, x, file="f", ugb=UNIT, fr="101"):
    x = None if x is None else float(x)
    return dict(file=file, pos=pos, ugb=ugb, funcao="01", programa="P", fr=fr, ced=ced, x=x)


def units(spark, codes=("50A000001", "50A000002")):
    return spark.createDataFrame([(c,) for c in codes], "codigo_ugb string")


def run(spark, rows, rules=S.PRODUCTION):
    out = net_extract(typed(spark, rows), units(spark), rules, [METRIC])
    return {(r.ced, r[METRIC]) for r in out.collect()}


GOLDEN = {
    "clean chain": (
        [("110000", 100), ("111000", 80), ("111100", 50), ("111111", 30)],
        {("110000", 20), ("111000", 30), ("111100", 20), ("111111", 30)}, {}),
    "siblings with one prefix": (
        [("110000", 100), ("111000", 100), ("111100", 100), ("111101", 60), ("111102", 40)],
        {("110000", 0), ("111000", 0), ("111101", 60)}, {}),
    "siblings kept by whole code": (
        [("110000", 100), ("111000", 100), ("111100", 100), ("111101", 60), ("111102", 40)],
        {("110000", 0), ("111000", 0), ("111100", 0), ("111101", 60), ("111102", 40)},
        {"dedup_key": "unit_ced"}),
    "B loses to A": ([("111100", 100), ("111101", 60)], {("111101", 60)}, {}),
    "C over A only": (
        [("111000", 100), ("111101", 60), ("111111", 40)],
        {("111000", 100), ("111101", 60), ("111111", 40)}, {}),
    "C over A, subtracting": (
        [("111000", 100), ("111101", 60), ("111111", 40)],
        {("111000", 0), ("111101", 60), ("111111", 40)}, {"c_over_a": "subtract"}),
    "lone D": ([("110000", 100)], set(), {}),
    "lone D kept": ([("110000", 100)], {("110000", 100)}, {"lone_d": "keep"}),
    "NULL parent": ([("110000", None), ("111000", 5)], {("110000", None), ("111000", 5)}, {}),
    "NULL child": ([("110000", 9), ("111000", None)], {("110000", 9), ("111000", None)}, {}),
    "fallback is per group": (
        [("110000", 100), ("111000", 30), ("112100", 20)],
        {("110000", 70), ("111000", 30), ("112100", 20)}, {}),
    "each repeated parent nets all": (
        [("110000", 100), ("110000", 90), ("111000", 30)], {("110000", 70), ("111000", 30)}, {}),
}


@pytest.mark.parametrize("case", GOLDEN)
def test_golden(spark, case):
    rows, expected, changes = GOLDEN[case]
    rows = [line(i, ced, x) for i, (ced, x) in enumerate(rows)]
    assert run(spark, rows, S.PRODUCTION.but(**changes)) == expected


def test_rows_with_a_missing_key_part_become_one_per_file(spark):
    rows = [line(0, "111101", 1, fr=None), line(1, "121101", 2, fr=None, ugb="50A000002 - Y"),
            line(0, "111101", 3, fr=None, file="g")]
    assert run(spark, rows) == {("111101", 1.0), ("111101", 3.0)}


def test_tie_of_priorities_in_a_merged_group_goes_by_file_order(spark):
    rows = [line(0, "121000", 7, fr=None), line(1, "111100", 5, fr=None)]
    assert run(spark, rows) == {("121000", 2.0)}


def test_the_surviving_row_keeps_its_own_unit_key(spark):
    rows = [line(0, "111101", 1, fr=None), line(1, "121101", 2)]
    out = net_extract(typed(spark, rows), units(spark), S.PRODUCTION, [METRIC])
    got = {(r.ugb, r.funcao, r.programa, r.fr, r.id_row_ced_5d) for r in out.collect()}
    assert got == {(UNIT, "01", "P", None, None), (UNIT, "01", "P", "101", f"{UNIT}_01_P_101_12110")}


def random_rows(rng, n=70):
    def ced():
        d = "1" + "".join(rng.choice("12") if i == 0 else rng.choice("0123"[: 2 + (i == 4)]) for i in range(5))
        keep = rng.choice([2, 3, 4, 6, 6])
        return None if rng.random() < 0.05 else d[:keep].ljust(6, "0")

    return [
        dict(
            file=rng.choice("fg"), pos=i, ugb=rng.choice([UNIT, UNIT, "50A000002 - Y", "50A000009 - Z"]),
            funcao=None if rng.random() < 0.05 else "01", programa="P",
            fr=None if rng.random() < 0.1 else rng.choice(["101", "102"]), ced=ced(),
            x=None if rng.random() < 0.1 else float(rng.randint(-50, 100)),
        )
        for i in range(n)
    ]


def result(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("name", RULES)
def test_random_extracts_match_the_model(spark, name):
    rules, rng = RULES[name], random.Random(name)
    # Many small extracts at once: each gets its own pair of files.
    rows = []
    for i in range(60):
        rows += [dict(r, file=f"{i}{r['file']}") for r in random_rows(rng)]
    kept = {"50A000001", "50A000002"}
    expected = result((r["file"], r["pos"], r["x"], r["is_parent"]) for r in model_net(rows, kept, rules))
    df = typed(spark, rows)
    closed = net_extract(df, units(spark), rules, [METRIC])
    columns = ["source_file", "row_order", METRIC, "is_parent"]
    assert result(tuple(r) for r in closed.select(columns).collect()) == expected
    prepared = H.prepare_extract(df, units(spark), rules)
    steps = H.prioritise(H.union_levels(prepared, rules, [METRIC]), rules)
    assert result(tuple(r) for r in steps.select(columns).collect()) == expected


def test_row_storage_order_does_not_matter(spark):
    rows = random_rows(random.Random(5), 300)
    shuffled = rows[:]
    random.Random(6).shuffle(shuffled)
    assert run(spark, rows) == run(spark, shuffled)


def test_exact_decimals(spark):
    rows = typed(spark, [line(0, "110000", 0.3), line(1, "111000", 0.1), line(2, "112000", 0.2)])
    rows = rows.withColumn(METRIC, F.col(METRIC).cast(S.EXACT))
    out = net_extract(rows, units(spark), S.PRODUCTION, [METRIC]).filter("ced = '110000'").first()
    assert out[METRIC] == 0


def test_unknown_columns_travel_with_the_row(spark):
    df = typed(spark, [line(0, "111101", 1), line(1, "111102", 2)]).withColumn("nota", F.col("row_order") + 10)
    out = net_extract(df, units(spark), S.PRODUCTION, [METRIC]).collect()
    assert [r.nota for r in out] == [10]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_exchanges_and_rows_combined_before_the_first(spark):
    df = net_extract(typed(spark, [line(0, "111101", 1)]), units(spark), S.PRODUCTION, [METRIC])
    text = plan(df)
    assert text.count("Exchange hashpartitioning") - text.count("Exchange hashpartitioning(__unit") == 2
    # Bottom up: the rows are aggregated before they move, and windows come after.
    assert text.index("Window") < text.index("Exchange hashpartitioning(source_file")
    assert "partial_min" in text and "partial_sum" in text


def test_a_hot_group_sends_few_rows_to_the_windows(spark):
    """A third of all rows in one unit key, and a third without a fund source."""
    n = 30_000
    ids = spark.range(n)
    third = F.col("id") % 3
    digits = F.concat(F.lit("11"), F.lpad(((F.col("id") * 7919) % 50).cast("string"), 4, "0"))
    df = ids.select(
        F.lit("f").alias("source_file"), F.col("id").alias("row_order"),
        F.when(third == 0, F.lit(UNIT)).otherwise(
            F.concat(F.lit("50A000002 - "), (F.col("id") % 500).cast("string"))).alias("ugb"),
        F.lit("01").alias("funcao"), F.lit("P").alias("programa"),
        F.when(third != 1, F.lit("101")).alias("fr"), digits.alias("ced"), F.lit(1.0).alias(METRIC),
    )
    rows = H.prepare_extract(df, units(spark))
    from rubrica.plans.net import _combine

    combined = _combine(rows, S.PRODUCTION, [METRIC], [])
    largest = combined.groupBy("source_file", *H.prefix_group(2)[1:]).count().agg(F.max("count")).first()[0]
    assert largest <= 50
    assert net_extract(df, units(spark), S.PRODUCTION, [METRIC]).filter("fr IS NULL").count() == 1


def test_joins_of_a_hot_group_are_split(spark):
    """Rows meet their group's totals in a join that AQE splits at the hot key."""
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in changes}
    try:
        for k, v in changes.items():
            spark.conf.set(k, v)
        ids = spark.range(0, 60_000, 1, 8)
        df = ids.select(
            F.lit("f").alias("source_file"), F.col("id").alias("row_order"),
            F.when(F.col("id") % 10 != 1, UNIT).otherwise(F.concat(F.lit("50A000002 - "), F.col("id") % 900))
            .alias("ugb"),
            F.lit("01").alias("funcao"), F.lit("P").alias("programa"), F.lit("101").alias("fr"),
            F.when(F.col("id") % 5 == 0, "110000").otherwise("111000").alias("ced"), F.lit(1.0).alias(METRIC),
        )
        out = H.level_d(H.prepare_extract(df, units(spark)), metrics=[METRIC])
        assert len(out.collect()) == 60_000
        assert "skew" in plan(out).lower()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def two_metrics(spark):
    return typed(spark, [line(0, "110000", 100), line(1, "111101", 30)]).withColumn("outra", F.col(METRIC))


def test_windows_carry_one_total_per_metric(spark):
    """Of a row's two-, three- and four-digit group only one is taken off it, so one total goes on."""
    text = plan(net_extract(two_metrics(spark), units(spark), S.PRODUCTION, [METRIC, "outra"]))
    assert not any(f"__less{k}_" in text for k in (2, 3, 4)) and "__less_outra" in text


def test_rows_of_all_levels_meet_one_total_per_metric(spark):
    steps = H.prioritise(H.union_levels(H.prepare_extract(two_metrics(spark), units(spark)), metrics=[METRIC, "outra"]))
    text = plan(steps)
    assert not any(f"__less{k}_" in text for k in (2, 3, 4)) and "__less_outra" in text
    assert {(r.ced, r[METRIC], r.outra) for r in steps.collect()} == {("110000", 70, 70), ("111101", 30, 30)}


def test_the_sort_of_the_windows_begins_with_a_hash(spark):
    text = plan(net_extract(two_metrics(spark), units(spark), S.PRODUCTION, [METRIC, "outra"]))
    assert "Sort [__hash" in text


# -- the earlier pipeline ---------------------------------------------------------------


@pytest.mark.parametrize("most", [L.HOT_ROWS, 0])
def test_legacy_rows_move_once_and_agree_with_the_single_steps(spark, most):
    rng = random.Random(11)
    rows = []
    for i in range(30):
        rows += [dict(r, file=f"{i}{r['file']}") for r in random_rows(rng)]
    df = typed(spark, rows)
    out = L.legacy_adjusted(df, units(spark), ((METRIC,),), most).withColumnRenamed("__m0", METRIC)
    steps = L.legacy_adjust(L.legacy_base(df, units(spark), [METRIC]), [METRIC])
    shown = lambda x: collections.Counter(map(tuple, x.select(S.SOURCE_FILE, S.ROW_ORDER, *S.UNIT_KEY, "ced", METRIC, "part").collect()))
    assert shown(out) == shown(steps) and sum(shown(out).values()) > 100
    assert L.has_hot_group(df, most) == (most == 0)


def test_the_long_table_has_no_join_of_rows_with_totals(spark):
    metrics = {m: F.col(METRIC) for m in S.METRICS}
    df = typed(spark, [line(0, "111000", 5), line(1, "111100", 3), line(2, "111101", 1)]).withColumns(metrics)
    out = L.legacy_long(df, units(spark))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "__s4_" in text and text.count("Join") == text.count("LeftSemi")
    assert out.count() > 0
