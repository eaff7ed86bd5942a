"""Plan-shape checks: filters and projections reach the Parquet scan; no nested-loop joins."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from jobscope.operators.relational import purge
from jobscope.sources.tables import table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_purge_and_prefix_push_down(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    p = _plan(purge(li, "l_shipdate", 39, "2001-11-05 00:00:00"))
    assert "PushedFilters: [Or(IsNull(l_shipdate)" in p
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp[_a-z]*>", p)
    c = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").startswith("HOUSE")).select("c_custkey")
    assert "StringStartsWith(c_mktsegment,HOUSE)" in _plan(c)


def test_no_nested_loop_or_cartesian_joins(spark, sf_dir):
    for name, fn in entry.queries().items():
        p = _plan(fn(spark, sf_dir))
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name
