"""Registered queries against their SQL on the smallest test tables.

``python -m checks.compare`` does the same for every query.
"""

import os

import pytest

import __spark_entry__ as entry_point
from checks import oracles, queries
from checks.compare import difference, open_oracle

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = (
    "scan_extracts", "reject_files", "derive_keys", "collapse_one_level", "level_c", "prioritise",
    "net_extract", "net_second_generation", "net_by_classifier", "enrich_final", "legacy_adjust",
    "legacy_enriched", "reconcile_totals", "used_keys", "file_metadata",
)
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracles.oracle_sql())
    assert set(queries.queries()) <= set(entry_point.queries())


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, name):
    assert difference(spark, open_oracle(SF_DIR), SF_DIR, name) == ""


@needs_data
def test_entry(spark):
    assert entry_point.entry(spark).limit(5).count() == 5
