"""Plans that read their input once or twice, conserving netting, and where amounts go."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from checks import queries as Q
from rubrica import schema as S
from rubrica.operators import hierarchy as H
from rubrica.plans.conserve import net_conserving
from rubrica.plans.reconcile import PARTS, reconcile_net

from .test_netting import METRIC, RULES, UNIT, line, random_rows, typed, units
from .test_queries import SF_DIR, needs_data


def fact_scans(df):
    """Reads of the fact table in the physical plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("lineitem.parquet" in part.split("\n")[0] for part in plan.split("FileScan parquet")[1:])


@needs_data
@pytest.mark.parametrize("name, most", [
    ("union_levels", 2), ("prioritise", 2), ("legacy_long", 2), ("key_semi_anti", 2), ("level_key_sets", 1),
    ("reconcile_totals", 1), ("reconcile_parts", 1), ("net_extract", 1), ("net_conserving", 1),
])
def test_scans(spark, name, most):
    assert 1 <= fact_scans(Q.queries()[name](spark, SF_DIR)) <= most


# -- conserving netting -----------------------------------------------------------------


def stem(ced):
    short = ced.rstrip("0")
    return short.ljust(2, "0") if len(short) < 2 else short


def conserved(rows):
    """Plain Python: rows by key, each less the keys whose longest present prefix it is."""
    nodes, count = {}, collections.Counter()
    for r in rows:
        key = (r["file"], r["ugb"], r["funcao"], r["programa"], r["fr"], r["ced"])
        count[key] += 1
        old = nodes.get(key)
        nodes[key] = r["x"] if old is None else old if r["x"] is None else old + r["x"]
    parent, taken = {}, collections.defaultdict(list)
    for key in nodes:
        if key[-1] is None:
            continue
        above = [k for k in nodes if k[:-1] == key[:-1] and k[-1] is not None
                 and len(stem(k[-1])) < len(stem(key[-1])) and stem(key[-1]).startswith(stem(k[-1]))]
        parent[key] = max(above, key=lambda k: len(stem(k[-1])), default=None)
        if parent[key]:
            taken[parent[key]].append(nodes[key])
    out = set()
    for key, x in nodes.items():
        off = [v for v in taken[key] if v is not None]
        up = parent.get(key)
        out.add((*key, up and up[-1], count[key], (x or 0) - sum(off) if off else x))
    return out


def test_conserving_netting_is_that_of_the_model_and_sums_to_the_roots(spark):
    rng = random.Random(4)
    rows = []
    for i in range(40):
        rows += [dict(r, file=f"{i}{r['file']}") for r in random_rows(rng)]
    out = net_conserving(typed(spark, rows), [METRIC]).collect()
    want = conserved(rows)
    assert {tuple(r) for r in out} == want and len(out) == len(want)
    key = lambda r: (r.source_file, r.ugb, r.funcao, r.programa, r.fr)
    raw = collections.Counter()
    for r in rows:
        raw[(r["file"], r["ugb"], r["funcao"], r["programa"], r["fr"], r["ced"])] += r["x"] or 0
    total, roots = collections.Counter(), collections.Counter()
    for r in out:
        total[key(r)] += r[METRIC] or 0
        if r.parent is None:
            roots[key(r)] += raw[(*key(r), r.ced)]
    assert total == roots


def test_two_classifiers_of_one_stem(spark):
    rows = [line(0, "110000", 10), line(1, "11", 5), line(2, "111000", 3), line(3, "100000", 1)]
    got = {(r.ced, r.parent, r[METRIC]) for r in net_conserving(typed(spark, rows), [METRIC]).collect()}
    owner = {p for c, p, _ in got if c == "111000"}.pop()
    other = {"110000": "11", "11": "110000"}[owner]
    whole = {"110000": 10.0, "11": 5.0}
    assert got == {("111000", owner, 3.0), (owner, None, whole[owner] - 3), (other, None, whole[other]), ("100000", None, 1.0)}


def test_a_hot_unit_sends_its_classifiers_alone(spark):
    n = 20_000
    same = lambda text: F.concat(F.lit(text), F.substring("id", 1, 0))  # noqa: E731  (no constant to the optimiser)
    df = spark.range(n).select(
        same("f").alias("source_file"), F.col("id").alias("row_order"),
        F.when(F.col("id") % 3 != 0, F.lit(UNIT)).otherwise(F.concat(F.lit("50A000002 - "), F.col("id"))).alias("ugb"),
        same("01").alias("funcao"), same("P").alias("programa"), same("101").alias("fr"),
        F.concat(F.lit("11"), F.lpad(((F.col("id") * 7919) % 40).cast("string"), 4, "0")).alias("ced"), F.lit(1.0).alias(METRIC))
    out = net_conserving(df, [METRIC])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_sum" in plan
    assert plan.index("Window") < plan.index("HashAggregate")
    hot = out.where(F.col("ugb") == UNIT)
    assert hot.count() == 40 and hot.agg(F.sum("n_rows")).first()[0] == n - (n + 2) // 3


def test_conserving_windows_sort_by_a_hash_and_carry_one_total_per_metric(spark):
    out = net_conserving(typed(spark, [line(0, "110000", 100), line(1, "111101", 30)]), [METRIC])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort [__hash" in text
    # A sum for each of the four prefix lengths, dropped as soon as the row's own is picked.
    assert text.count(f"AS __below_{METRIC}#") == 4 and f"AS __less_{METRIC}#" in text
    assert {(r.ced, r.parent, r[METRIC]) for r in out.collect()} == {("110000", None, 70.0), ("111101", "110000", 30.0)}


# -- where amounts go -------------------------------------------------------------------


@pytest.mark.parametrize("name", RULES)
def test_parts_add_up_to_the_raw_totals(spark, name):
    rules, rng = RULES[name], random.Random(name)
    rows = []
    for i in range(12):
        rows += [dict(r, file=f"{i}{r['file']}") for r in random_rows(rng)]
    df = typed(spark, rows)
    found = reconcile_net(df, units(spark), rules, [METRIC]).collect()
    assert found
    for r in found:
        assert (r.raw_total or 0) == sum(r[p] or 0 for p in PARTS)
    net = H.prepare_extract(df, units(spark), rules)
    kept = H.prioritise(H.union_levels(net, rules, [METRIC]), rules).groupBy("source_file", "ced_group").agg(
        F.count("*").alias("n"), F.sum(METRIC).alias("v")).collect()
    assert {(r.source_file, r.ced_group): (r.n, r.v) for r in kept} == {
        (r.source_file, r.ced_group): (r.net_rows, r.net_total) for r in found if r.net_rows is not None}


def test_each_part(spark):
    rows = [line(0, "110000", 100), line(1, "111100", 70), line(2, "111101", 30), line(3, "111102", 20), line(4, "120000", 9)]
    found = {r.ced_group: r for r in reconcile_net(typed(spark, rows), units(spark), S.PRODUCTION, [METRIC]).collect()}
    parts = lambda x: tuple(found[x][p] for p in PARTS)
    # D: 100 less its B; a lone D of 9.  B: 70 less both A, and its prefix goes to an A.  A: the second shares the prefix of the first.
    assert parts("D") == (30.0, 70.0, 0.0, 0.0, 9.0)
    assert parts("B") == (None, 50.0, 0.0, 20.0, 0.0)
    assert parts("A") == (30.0, 0.0, 20.0, 0.0, 0.0)
