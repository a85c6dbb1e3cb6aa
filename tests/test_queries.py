"""Registered queries against their check SQL on the given tables."""

import os

import pytest
from tests.checking import connect, differences

import __spark_entry__ as entry
from acctrisk.plans import oracle, registry

SF_DIR = "/root/testdata/sf0.01"
SELECTED = [
    "load_usage", "split_notes_keep_banner_note", "parse_changelog", "reconcile_notes",
    "merged_signals", "risk_scores", "dq_report", "validated_risk", "dataset_digest",
    "weight_sensitivity", "annotation_defaults", "batch_annotate",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


def pytest_generate_tests(metafunc):
    if "name" in metafunc.fixturenames:
        chosen = registry.QUERIES if metafunc.config.getoption("--all-queries") else SELECTED
        metafunc.parametrize("name", list(chosen))


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_query_equals_its_sql(spark, con, name):
    mine = entry.queries()[name](spark, SF_DIR).toArrow()
    assert differences(mine, con.sql(entry.oracle_sql()[name]).to_arrow_table()) == ""


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(oracle.all_sql())
    assert set(registry.QUERIES) <= set(entry.queries())


def test_entry_is_ranked_and_not_empty(spark):
    rows = entry.entry(spark).collect()
    scores = [r.composite_risk_score for r in rows]
    assert rows and scores == sorted(scores, reverse=True)
