"""Rule details, compaction of results, mergeable distributions, nested predictions."""

from pyspark.sql import functions as F

from annolake.operators import annotate, evaluate, joins, profile, quality, runs
from annolake.sources import writers
from annolake.streaming import frames as streams


def test_offenders_are_counted_and_the_first_named(spark):
    rows = spark.range(500).select(
        F.when(F.col("id") % 5 == 0, "rare").otherwise("hot").alias("rule"), F.format_string("p%03d", "id").alias("example"), F.lit(2).cast("long").alias("weight")
    )
    found = {r.rule: r for r in quality.offender_summary(rows.repartition(7)).collect()}
    assert found["hot"].n == 800 and found["rare"].n == 200
    assert found["rare"].examples == [f"p{i:03d}" for i in range(0, 100, 5)]
    assert found["hot"].examples == [f"p{i:03d}" for i in range(25) if i % 5]
    plan = quality.offender_summary(rows)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2  # before the shuffle too


def _checked(spark, leak):
    manifest = spark.createDataFrame(
        [("train", "s", i, f"images/{i}.jpg", f"labels/{i}.txt") for i in range(8)] + [("val", "s", 0 if leak else 8, "images/8.jpg", "labels/8.txt"), ("test", "s", 9, "images/9.jpg", "labels/9.txt")],
        "split string, source_split string, image_id long, project_image_path string, project_label_path string",
    )
    files = spark.createDataFrame([(f"images/{i}.jpg",) for i in range(10)] + [(f"labels/{i}.txt",) for i in range(9)], "path string")
    lines = spark.createDataFrame([("labels/1.txt", 2, "0 0.5 0.5 0.1"), ("labels/1.txt", 1, "0 0.5 0.5 0.1 0.1")], "label_file string, line_no long, line string")
    once = spark.createDataFrame([(0, 0, 0)], "mismatches long, missing_lines long, extra_lines long")
    ten = spark.createDataFrame([(10,)], "n long")
    texts = spark.createDataFrame([("a.yaml", "path: PATH\\TO\\data"), ("b.yaml", "fine"), ("c.yaml", None)], "name string, text string")
    paths = spark.createDataFrame([("images/1.jpg",), ("images/none.jpg",)], "path string")
    rules = quality.validation_rules(manifest, files, lines, once, ten, files.limit(0), texts, paths)
    return {r.name: (r.status, r.details) for r in rules.collect()}


def test_rules_say_what_failed(spark):
    rules = _checked(spark, leak=True)
    assert len(rules) == 12
    status, details = rules["no_image_source_key_leakage"]
    assert status == "FAIL" and details["count"] == "1" and "0" in details["examples"]
    assert rules["manifest_paths_exist"] == ("FAIL", {"count": "1", "examples": "missing label: labels/9.txt"})
    assert rules["label_format_and_ranges"] == ("FAIL", {"count": "2", "examples": "labels/1.txt:2: field_count\nmissing label: labels/9.txt"})
    assert rules["dataset_yaml_paths_resolve"] == ("FAIL", {"count": "1", "examples": "images/none.jpg"})
    assert rules["no_placeholder_paths"] == ("FAIL", {"count": "1", "examples": "a.yaml"})
    assert rules["all_usable_images_open"] == ("PASS", {"count": "0", "examples": ""})
    assert rules["split_ratios_close_to_80_10_10"] == ("PASS", {"total": "10", "train": "8", "val": "1", "test": "1"})
    assert rules["source_traceability_present"] == ("PASS", {"total": "10", "expected": "10"})
    assert _checked(spark, leak=False)["no_image_source_key_leakage"] == ("PASS", {"count": "0", "examples": ""})


def test_compaction_keeps_the_newest_and_can_be_repeated(spark, tmp_path):
    log, current = str(tmp_path / "log"), str(tmp_path / "current")

    def add(rows):
        spark.createDataFrame(rows, "result_id string, n int, written_at long").write.mode("append").parquet(log)

    def newest():
        return {tuple(r) for r in runs.latest_result(spark.read.parquet(log)).select("result_id", "n").collect()}

    def read():
        return {tuple(r) for r in writers.read_current(spark, log, current).select("result_id", "n").collect()}

    add([(f"r{i}", 0, 1) for i in range(50)])
    assert read() == newest()  # nothing compacted yet
    assert writers.compact_results(spark, log, current, buckets=8) == 8
    before = {p.name for p in (tmp_path / "current").rglob("*.parquet")}
    assert read() == newest() and writers.compact_results(spark, log, current, buckets=8) == 0
    assert {p.name for p in (tmp_path / "current").rglob("*.parquet")} == before
    add([("r3", 7, 2), ("new", 1, 2), ("r4", 1, 0)])  # the last one is older than what is known
    assert read() == newest() and dict(read())["r3"] == 7
    assert 1 <= writers.compact_results(spark, log, current, buckets=8) <= 2
    assert read() == newest() and len(read()) == 51
    assert spark.read.parquet(current).count() == 51


def test_sketches_of_parts_merge(spark):
    rows = spark.range(20_000).select(
        (F.col("id") % 7).alias("part"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 7919 % 20_000).cast("double")).alias("value"),
    )
    shares = {"low": 0.01, "median": 0.5, "p90": 0.9}
    sketches = profile.distribution_sketches(rows, ["part", "kind"], "value")
    assert sketches.count() == 14
    merged = profile.merged_distribution(sketches, ["kind"], shares)
    exact = {r.kind: r for r in rows.groupBy("kind").agg(F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean")).collect()}
    for r in merged.collect():
        assert (r["count"], r["min"], r["max"]) == (exact[r.kind]["count"], exact[r.kind]["min"], exact[r.kind]["max"]) and abs(r["mean"] - exact[r.kind]["mean"]) < 1e-6
    errors = profile.rank_error(rows, "kind", "value", merged, shares).collect()
    assert len(errors) == 2 and all(r[f"{s}_error"] <= 0.01 for r in errors for s in shares)
    none = profile.distribution_summary(rows.filter("value < 0"), "value", approximate=True).first()
    assert none["count"] == 0 and none["median"] is None
    some = profile.distribution_summary(rows, "value", approximate=True).first()
    assert some["count"] == rows.filter("value is not null").count() and abs(some["median"] - 10_000) < 200


def test_nested_predictions_become_rows(spark):
    def make():
        import pandas as pd

        def predict(batch):
            found = [[{"class_id": j, "confidence": 0.5, "x1": 0.0, "y1": 0.0, "x2": float(i), "y2": 1.0} for j in range(i % 3)] for i in batch["id"].tolist()]
            return pd.DataFrame({"id": batch["id"], "detections": found})

        return predict

    kind = "array<struct<class_id:bigint,confidence:double,x1:double,y1:double,x2:double,y2:double>>"
    nested = streams.batch_predict(spark.range(10), make, f"id bigint, detections {kind}")
    names = spark.createDataFrame([(0, "person")], "class_id long, name string")
    rows = runs.detections_explode(nested, names).collect()
    assert sorted((r.id, r.class_id, r.class_name) for r in rows) == sorted((i, j, ["person", "1"][j]) for i in range(10) for j in range(i % 3))


def test_conversion_report_follows_the_images(spark):
    images = spark.createDataFrame([("t", i, f"{i}.jpg", 100, 100) for i in range(4)], "source_split string, image_id long, file_name string, width int, height int")
    files = spark.createDataFrame([("img/0.jpg", True), ("img/1.jpg", False), ("img/1.jpg", True), ("img/2.jpg", None)], "path string, readable boolean")
    boxes = [("t", 0, 1, 1, 10.0, 0), ("t", 0, 2, 1, 10.0, 1), ("t", 0, 3, 9, 10.0, 0), ("t", 1, 4, 1, -5.0, 0), ("t", 2, 5, 1, 10.0, 0), ("t", 3, 6, 1, 10.0, 0), ("t", 8, 7, 1, 10.0, 0)]
    annotations = spark.createDataFrame(boxes, "source_split string, image_id long, annotation_id long, category_id long, w double, iscrowd int").selectExpr(
        "*", "1.0D AS x", "1.0D AS y", "5.0D AS h"
    )
    mapping = spark.createDataFrame([(1, "person", "human", 0)], "category_id long, name string, supercategory string, class_id long")
    row = annotate.conversion_report(annotations, images, mapping, files, F.concat(F.lit("img/"), "file_name")).collect()
    assert len(row) == 1 and row[0].asDict() == {
        "source_split": "t", "images_seen": 4, "images_written": 2, "missing_images": 1, "corrupt_images": 1, "annotations_seen": 7,
        "annotations_written": 1, "invalid_boxes": 1, "unsupported_annotations": 1, "crowd_annotations_skipped": 1,
    }


def test_subset_totals_name_the_classes(spark):
    selected = spark.createDataFrame([("train", "a"), ("train", "b"), ("val", "c"), (None, "d")], "split string, label_file string")
    lines = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), ("d", 7), ("d", None), ("zz", 3)], "label_file string, class_id long")
    names = spark.createDataFrame([(0, "person"), (1, "dog")], "class_id long, name string")
    rows = joins.subset_totals(selected, lines, names).collect()
    got = sorted((str(r.split), r.images, r.annotations, r.represented_class_count, [c.class_name for c in r.represented_classes or []]) for r in rows)
    assert got == [
        ("None", 1, 2, 1, ["7"]), ("None", 4, 5, 3, ["person", "dog", "7"]), ("train", 2, 3, 2, ["person", "dog"]), ("val", 1, 0, 0, []),
    ]


def test_sample_summary_is_one_compiled_pass(spark):
    """The image id of a prediction is worked out once per row, and the detections are read once."""
    images = spark.range(6).select(F.col("id").alias("image_id"), F.lit(640).alias("width"))
    mapping = spark.range(3).select(F.col("id").alias("class_id"), (F.col("id") + 1).alias("category_id"), F.concat(F.lit("c"), "id").alias("name"))
    spelt = ["1", "train2017_000000000001", "val2017_000000000002", "train2017_3", "x1", "", None, "000003", "9" * 30, "4\n"]
    rows = [(i, text, i % 2, 1.0, 1.0, 2.0, 2.0, 0.1 * i) for i, text in enumerate(spelt)]
    predictions = spark.createDataFrame(rows, "det_id long, image_id string, class_id int, x double, y double, w double, h double, score double")
    found = evaluate.convert_predictions(predictions, images, mapping)
    assert {r.det_id: r.image_id for r in found.collect()} == dict(enumerate([1, 1, 2, None, None, None, None, 3, None, 4]))
    detections = evaluate.converted(found).withColumnRenamed("score", "confidence").join(mapping.select("class_id", F.col("name").alias("class_name")), "class_id")
    sample = detections.join(images.filter("image_id > 1 and width > 0").select("image_id"), "image_id", "left_semi")
    plan = sample._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1 and "RLIKE" not in plan
    summary = runs.sample_summary(images, detections, "image_id")
    assert summary._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 1
    got = {r.image_id: (r.detection_count, r.min, r.max, r.mean, r.class_counts) for r in summary.collect()}
    assert got[1] == (2, 0.0, 0.1, 0.05, {"c0": 1, "c1": 1}) and got[0] == (0, None, None, None, None) and len(got) == 6
