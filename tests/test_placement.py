"""Large input whose groups hold few rows moves once, whole; the results are those of the other way."""

import random

import pytest
from pyspark.sql import functions as F

from rubrica import schema as S
from rubrica.functions.keys import classify_level, with_group_columns
from rubrica.operators import hierarchy as H
from rubrica.operators import joins as J
from rubrica.operators import placement as P
from rubrica.plans.net import _combine_key, net_extract

from .model import net as model_net
from .test_netting import METRIC, RULES, line, plan, random_rows, result, typed, units


@pytest.fixture
def any_size(monkeypatch):
    """Every input counts as large, with groups of few rows."""
    monkeypatch.setattr(P, "LARGE_BYTES", 0)
    monkeypatch.setattr(P, "LEAST_ROWS", 0)
    monkeypatch.setattr(P, "MOST_PER_GROUP", 1 << 20)


def many_extracts(name, n=40):
    rng = random.Random(name)
    return [dict(r, file=f"{i}{r['file']}") for i in range(n) for r in random_rows(rng)]


def moves(df):
    """Exchanges of rows by key, those of the unit list left out."""
    text = plan(df)
    return text.count("Exchange hashpartitioning") - text.count("Exchange hashpartitioning(__unit")


@pytest.mark.parametrize("name", RULES)
def test_rows_moved_whole_net_like_the_model(spark, any_size, name):
    rules, rows = RULES[name], many_extracts(name)
    expected = result((r["file"], r["pos"], r["x"], r["is_parent"])
                      for r in model_net(rows, {"50A000001", "50A000002"}, rules))
    out = net_extract(typed(spark, rows), units(spark), rules, [METRIC])
    assert result(tuple(r) for r in out.select("source_file", "row_order", METRIC, "is_parent").collect()) == expected
    assert moves(out) == (2 if rules.dedup_key == "ced" else 1)
    # Whole classifiers are chosen in an order of their own.
    assert rules.dedup_key == "unit_ced" or plan(out).count("Sort [__hash") == 1


@pytest.mark.parametrize("name", ["production", "unfiltered"])
def test_rows_moved_whole_keep_all_their_columns(spark, monkeypatch, name):
    df = typed(spark, many_extracts(name)).withColumn("nota", F.col("row_order") + 10)
    run = lambda: net_extract(df, units(spark), RULES[name], [METRIC])
    combined = run()
    monkeypatch.setattr(P, "LARGE_BYTES", 0)
    monkeypatch.setattr(P, "LEAST_ROWS", 0)
    monkeypatch.setattr(P, "MOST_PER_GROUP", 1 << 20)
    whole = run()
    assert moves(whole) == 1 and moves(combined) == 2
    assert whole.columns == combined.columns and result(whole.collect()) == result(combined.collect())


def test_small_input_hot_groups_and_full_groups_are_combined_first(spark, monkeypatch):
    rows = typed(spark, [line(i, f"11{i % 50:04d}", 1) for i in range(200)])
    keyed = with_group_columns(classify_level(rows), S.PRODUCTION)
    tasks = lambda: P.tasks_to_move(keyed, _combine_key(S.PRODUCTION))
    assert tasks() is None
    monkeypatch.setattr(P, "LARGE_BYTES", 0)
    assert tasks() is None
    monkeypatch.setattr(P, "LEAST_ROWS", 0)
    # 200 rows in five or so groups of one hash bucket.
    assert tasks() is None
    monkeypatch.setattr(P, "MOST_PER_GROUP", 1 << 20)
    assert tasks() == 1
    monkeypatch.setattr(P, "TASK_ROWS", 60)
    assert tasks() == 4
    monkeypatch.setattr(P, "HOT_ROWS", 150)
    assert tasks() is None


def test_unit_lists_are_sent_to_every_task_by_their_bytes(spark):
    """Half a million codes of nine characters are a few MB; a join by shuffle would move every raw row for them."""
    codes = spark.range(500_000).select(F.concat(F.lit("50A"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("codigo_ugb"))
    out = J.filter_valid(typed(spark, [line(0, "111101", 1)]).withColumn("ugb_id", F.substring("ugb", 1, 9)), codes)
    assert "BroadcastHashJoin" in plan(out) and out.count() == 1


@pytest.mark.parametrize("name", ["production", "second", "separate_unfiltered"])
def test_level_tables_and_pairs_of_rows_moved_whole(spark, monkeypatch, name):
    rules = RULES[name]
    df = typed(spark, many_extracts(name)).withColumn("nota", F.col("row_order") + 10)
    rows = H.prepare_extract(df, units(spark), rules)

    def run():
        levels = H.union_levels(rows, rules, [METRIC])
        return H.collapse_pairs(rows, metrics=[METRIC]), levels, H.prioritise(levels, rules)

    joined = run()
    monkeypatch.setattr(P, "LARGE_BYTES", 0)
    monkeypatch.setattr(P, "LEAST_ROWS", 0)
    for before, after in zip(joined, run()):
        assert moves(after) == 1 < moves(before)
        assert after.columns == before.columns and result(after.collect()) == result(before.collect())
