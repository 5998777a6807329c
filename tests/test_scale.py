"""Plans whose cost per row must not grow with the table."""

import contextlib
import io
import re
from types import SimpleNamespace

from pyspark.sql import functions as F

from annolake.functions import boxes
from annolake.operators import evaluate
from annolake.plans import catalog
from annolake.sources import archives, readers, writers


def largest_method(frame):
    """Bytes of the largest generated method of a plan; the JVM compiles none of more than 8000."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("codegen")
    return max(int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue()))


def test_to_yolo_is_compiled(spark):
    rows = [
        (10.0, 20.0, 30.0, 40.0, 100, 200), (10.0, 20.0, 0.0, 40.0, 100, 200), (200.0, 200.0, 10.0, 10.0, 100, 100),
        (None, 1.0, 1.0, 1.0, 10, 10), (1.0, 1.0, 1.0, 1.0, 0, 10), (1.0, 1.0, 1.0, 1.0, None, 10), (-5.0, 10.0, 20.0, 20.0, 15, 40),
    ]
    frame = spark.createDataFrame(rows, "x double, y double, w double, h double, width int, height int")
    made = boxes.to_yolo(*[F.col(c) for c in ("x", "y", "w", "h", "width", "height")])
    found = frame.select(made.alias("r")).select("r.reason", *[f"r.box.{c}" for c in ("xc", "yc", "w", "h")])
    assert largest_method(found) < 6000
    assert [tuple(r) for r in found.collect()] == [
        (None, 0.25, 0.2, 0.3, 0.2), ("bbox_size_not_positive", *[None] * 4), ("bbox_outside_image", *[None] * 4),
        ("bbox_needs_four_values", *[None] * 4), ("image_dimensions_not_positive", *[None] * 4), (None, *[None] * 4),
        (None, 0.5, 0.5, 1.0, 0.5),
    ]


def test_envelope_of_the_precision_curve_is_a_running_maximum(spark):
    """A frame that reaches to the end of its partition is computed anew for every row."""
    rows = [(1, 1, 0.9, 1, 1), (1, 2, 0.8, 1, 0), (1, 3, 0.7, 2, 1), (1, 4, 0.6, 2, 1), (2, 1, 0.5, 3, 1)]
    schema = "class_id long, position long, score double, image_id long, counted long"
    detections = spark.createDataFrame(rows, schema)
    truth = spark.createDataFrame([(1,), (1,), (1,), (1,), (2,)], "class_id long")
    found = evaluate.pr_curve(evaluate.Evaluation(detections, None, truth))
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "currentrow$(), unboundedfollowing$()" not in plan
    curve = {(r.class_id, r.position): (r.tp, r.recall, round(r.precision, 6), round(r.envelope, 6)) for r in found.collect()}
    assert curve == {
        (1, 1): (1, 0.25, 1.0, 1.0), (1, 3): (2, 0.5, 0.666667, 0.75), (1, 4): (3, 0.75, 0.75, 0.75), (2, 1): (1, 1.0, 1.0, 1.0),
    }


def test_small_files_lie_in_archives(spark, tmp_path):
    contents = [b"\xff\xd8\xff" + b"x" * n for n in (0, 1, 511, 512, 513, 5000)] + [b"", b"", b"a\nb\x00\n"]
    files = spark.createDataFrame([(bytearray(c),) for c in contents], "content binary").coalesce(1)
    path = str(tmp_path / "files")
    writers.write_text_files(archives.to_archives(files, 2000), path, 1)
    stored = readers.read_files(spark, path, "*.txt")
    assert 1 < stored.count() < len(contents)
    found = archives.archived_files(stored).collect()
    assert sorted(bytes(r.content) for r in found) == sorted(contents)
    assert all(r.size_bytes == len(r.content) for r in found)
    assert len({r.path for r in found}) == len(contents)


def test_source_split_stats_counts_repeated_ids(spark, tmp_path):
    lines = [(1, 1, 5, 1), (1, 1, 6, 1), (1, 2, 7, 1), (25, 1, 8, 1), (25, 1, 8, 1), (25, 1, 9, 1)]
    columns = "cast(col1 as bigint) l_orderkey, cast(col2 as int) l_linenumber, cast(col3 as bigint) l_partkey, cast(col4 as bigint) l_suppkey"
    spark.createDataFrame(lines, "col1 int, col2 int, col3 int, col4 int").selectExpr(
        *columns.split(", "), "1.0D l_extendedprice", "timestamp_ntz'2020-01-01' l_shipdate", "'N' l_returnflag"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1,), (25,)], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    parts = spark.range(90).selectExpr("id as p_partkey", "'a b' as p_name", "'c' as p_type")
    parts.write.parquet(str(tmp_path / "part.parquet"))
    found = catalog.QUERIES["source_split_stats"](spark, str(tmp_path)).collect()
    assert {r.source_split: (r.annotations, r.duplicate_annotation_ids) for r in found} == {"train2017": (3, 1), "val2017": (3, 2)}


def test_both_smoke_picks_read_the_candidates_once_written(spark, monkeypatch):
    rows = [(f"r{i}", "t", i, ("train", "val")[i % 2], 1 + i, ["a"]) for i in range(8)]
    columns = "internal_record_id string, source_split string, image_id long, split string, valid_object_count long, category_names array<string>"
    seen = []
    monkeypatch.setattr(catalog.splits, "diverse_sample", lambda found, k: seen.append((found, k)) or found)
    picked = catalog._smoke_selection(SimpleNamespace(manifest=spark.createDataFrame(rows, columns)))
    assert [k for _, k in seen] == [32, 16] and len({tuple(found.inputFiles()) for found, _ in seen}) == 1 and seen[0][0].inputFiles()
    assert sorted(r.image_id for r in picked.collect()) == list(range(8))


def test_label_files_lie_in_archives(spark, tmp_path):
    """Files of any length, in far fewer archives than there are files, are read back with the lines' numbers."""
    want = {(f"d/{n}", i + 1, f"{n} {i}" if i % 5 else "") for n in range(60) for i in range(3 + 400 * (n == 7))}
    rows = [(f, i, line or None) for f, i, line in want]
    lines = spark.createDataFrame(rows, "file string, n long, line string").repartition(2, "file").sortWithinPartitions("file", "n")
    path = str(tmp_path / "labels")
    writers.write_text_files(archives.lines_to_archives(lines, 1000), path, 1)
    found = readers.read_labels(spark, path, archived=True).collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want)
    assert len(list((tmp_path / "labels").glob("part-*"))) < 40


def test_scan_label_lines_makes_no_file_for_each_name(spark, tmp_path, monkeypatch):
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_shipdate date, l_returnflag string"
    made = spark.range(400).selectExpr(
        "id * 1000 as l_orderkey", "1 as l_linenumber", "id as l_partkey", "id as l_suppkey", "1.0D as l_extendedprice",
        "date'2000-01-01' as l_shipdate", "'N' as l_returnflag",
    )
    spark.createDataFrame(made.rdd, schema, verifySchema=False).write.parquet(str(tmp_path / "lineitem.parquet"))
    path = str(tmp_path / "staged")
    monkeypatch.setattr(catalog, "staging_path", lambda *_: path)
    found = catalog.QUERIES["scan_label_lines"](spark, str(tmp_path)).collect()
    assert len({r.label_file for r in found}) == len(found) == 400 and {r.line_no for r in found} == {1}
    assert len([p for p in (tmp_path / "staged").rglob("*") if p.suffix == ".txt"]) < 40
