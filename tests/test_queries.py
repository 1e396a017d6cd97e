"""Every registered query against its SQL, and what its plan must not hold."""

import re
from pathlib import Path

import pytest

import compare
from tuneweave.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()
MODEL_CALLS = {"batch_generate", "model_scores"}


@pytest.fixture(scope="module")
def duck():
    return compare.duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    bad = compare.difference(spark, duck, FOLDER, QUERIES[name], ORACLE[name])
    assert bad is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name not in MODEL_CALLS:
        assert "Python" not in plan and "InPandas" not in plan
    for window in re.findall(r"Window \[.*", plan):
        groups = re.findall(r"\], \[([^\]]*)\]", window)
        if not groups or " ASC" in groups[0] or " DESC" in groups[0]:
            # Only the running sum over bucket totals, at most 65,536 rows, has no partition.
            assert "_within" in window, window


def test_filter_reaches_the_scan(spark):
    query = QUERIES["filter_language"](spark, FOLDER)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[.*In\(lang, \[en,fr\]\)", plan)
    assert "text" not in re.search(r"ReadSchema: (\S+)", plan).group(1)
