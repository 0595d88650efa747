"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import difflib
import os

import compare
import pytest

from tidegauge.plans import bridge

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", [n for n in bridge.QUERIES if n in bridge.ORACLE_SQL])
def test_query_equals_sql(spark, con, name):
    assert compare.differences(bridge.QUERIES[name](spark, SF), con, bridge.ORACLE_SQL[name]) == ""


def test_only_string_similarity_has_no_sql():
    assert set(bridge.QUERIES) - set(bridge.ORACLE_SQL) == {"similar_names"}


def test_similar_names(spark, con):
    names = [r[0] for r in con.execute("SELECT DISTINCT lower(p_name) FROM part WHERE p_name IS NOT NULL ORDER BY 1").fetchall()]
    near = con.execute("SELECT a, b FROM (SELECT unnest($1) AS a) JOIN (SELECT unnest($1) AS b) ON a < b AND levenshtein(a, b) <= 3 AND levenshtein(a, b) <= 0.5 * least(length(a), length(b))", [names]).fetchall()
    plain = lambda t: "".join(c for c in t if c.isalnum())
    want = {(a, b, round(difflib.SequenceMatcher(None, plain(a), plain(b)).ratio(), 6)) for a, b in near}
    got = {tuple(r) for r in bridge.QUERIES["similar_names"](spark, SF).collect()}
    assert got == {w for w in want if w[2] >= 0.7} and got


def test_files_round_trip_has_no_listing_on_the_driver(spark):
    read = bridge.QUERIES["files_round_trip"](spark, SF)
    assert read.inputFiles() == [] and "FileScan" not in read._jdf.queryExecution().executedPlan().toString()


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
