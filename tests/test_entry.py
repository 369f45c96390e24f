"""Entry points: every query against its SQL, and what the plans must look like."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from proofs.registry import ORACLES, QUERIES
from tests.parity import connection, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "recommend_ev" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    problems, _ = differences(entry.queries()[name](spark, FOLDER), entry.oracle_sql()[name], con)
    assert not problems


def plan(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_clustered_layout_prunes(spark):
    text = plan(spark, "layout_slice_lookup")
    assert re.search(r"PartitionFilters: \[isnotnull\(ship_year#\d+\), \(ship_year#\d+ = 2000\)\]", text)
    assert "EqualTo(l_returnflag,R)" in text and "EqualTo(l_linestatus,F)" in text


def test_slices_reach_the_scan(spark):
    text = plan(spark, "long_slice_value")
    assert "EqualTo(l_linestatus,F)" in text and "EqualTo(l_tax,0.0)" in text and "In(l_returnflag, [A,N])" in text
    assert "l_partkey" not in text
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01" in plan(spark, "filter_long_slice")


def test_decision_reads_each_fact_table_once(spark):
    text = plan(spark, "decision")
    assert len(re.findall(r"Location: [^\n]*lineitem", text)) == 1
    assert len(re.findall(r"Location: [^\n]*orders", text)) == 1
    assert "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["decision", "integrate_three_sources", "profile_columns", "row_number_global_scaled", "tco_projection"])
def test_no_python_in_plans(spark, name):
    text = plan(spark, name)
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
