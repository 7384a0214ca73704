"""Every registered query against its SQL twin, and the shape of the plans."""

import re

import pytest

import __spark_entry__
from lotwise.plans import CATALOGUE
from tests.conftest import SMALL
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def oracle():
    return connect(SMALL)


@pytest.mark.parametrize("key", list(CATALOGUE))
def test_matches_sql(spark, oracle, key):
    verdict, detail, _ = compare(spark, oracle, CATALOGUE[key], SMALL)
    assert verdict == "ok", detail


def test_entry_points(spark):
    assert set(CATALOGUE) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0


def plan_of(spark, key):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = CATALOGUE[key](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["JOIN-5", "JOIN-8", "SUB-5", "SUB-7", "SUB-9", "SUB-10", "SUB-16", "VEC-6", "GRF-4", "GRF-5", "DW-13"])
def test_no_nested_loops(spark, key):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan_of(spark, key))


def test_partition_filters(spark):
    plan = plan_of(spark, "SRC-13")
    for column in ("month", "o_orderstatus", "bucket"):
        assert re.search(rf"PartitionFilters: \[[^\]]*{column}#", plan), column


def test_pushed_filters(spark):
    plan = plan_of(spark, "FLT-9")
    assert "EqualTo(o_orderstatus,F)" in plan and "GreaterThanOrEqual(o_orderdate" in plan
    assert "StringStartsWith(p_name,red)" in plan_of(spark, "FLT-6")
    assert "ReadSchema: struct<c_name:string,c_mktsegment:string>" in plan_of(spark, "PRJ-1")


def test_semi_and_anti_joins(spark):
    assert "LeftSemi" in plan_of(spark, "SUB-11")
    assert "LeftAnti" in plan_of(spark, "JOIN-10")


def test_dictionaries_are_broadcast_by_size(spark):
    assert "BroadcastHashJoin" in plan_of(spark, "JOIN-7")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_of(spark, "JOIN-7")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_top_k_without_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "DW-9")


def test_limit_per_group_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(spark, "UPD-3")
