"""Registered queries against their SQL twins on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from annolake.plans import catalog  # noqa: E402
from annolake.plans.fixtures import BASE_TABLES  # noqa: E402
from compare import rows_of  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")

# A cross-section; tools/compare.py runs all of them.
NAMES = [
    "reason_counts", "class_split_pivot", "bbox_to_yolo", "letterbox_boxes", "portable_basename", "safe_output_name",
    "archive_audit", "lint_label_lines", "lint_coco_subset", "reconstruct_totals", "manifest_availability",
    "split_summary", "dataset_profile", "image_rollup", "video_summary", "moving_fps", "best_epoch", "seeded_split",
    "required_files_missing", "compare_expected", "subset_annotation_report", "run_readiness", "conversion_counters",
    "find_manifest_by_rows", "confusion_matrix", "batch_predict", "file_digests", "image_header_ok", "sink_result_upsert",
    "scan_image_list",
]


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, name):
    base = duckdb.connect()
    for table in BASE_TABLES:
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    frame = entry.queries()[name](spark, FOLDER)
    result = base.sql(entry.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(result.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(result.columns, result.fetchall())
