"""Physical plans: pruned scans, no Python in JVM queries, checked broadcasts."""

import os

import pytest

import __spark_entry__ as entry
from annolake.session import broadcast_checked

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned_and_unused_window_dropped(spark):
    text = plan(entry.queries()["reason_counts"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_returnflag:string>" in text
    assert "l_extendedprice" not in text and "l_shipdate" not in text
    assert "Python" not in text and "BroadcastHashJoin" in text


def test_pushed_filter(spark):
    text = plan(entry.queries()["class_object_counts"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(p_partkey), LessThan(p_partkey,90)]" in text


@pytest.mark.parametrize("name", ["bbox_to_yolo", "seeded_split", "image_rollup", "lint_label_lines", "class_split_pivot"])
def test_no_python_and_no_cross_product(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_broadcast_is_only_hinted_when_small(spark):
    small, big = spark.range(10), spark.range(11)
    left = spark.range(5)
    hinted = lambda right: "broadcast" in left.join(broadcast_checked(right, 10), "id")._jdf.queryExecution().analyzed().toString()
    assert hinted(small) and not hinted(big)
