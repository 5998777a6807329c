"""Splits, samples, linting, files and run logs on small literal inputs."""

import json

import pytest
from pyspark.sql import functions as F

from annolake.operators import annotate, joins, quality, runs, splits
from annolake.sources import readers, writers


def records(spark, n):
    return spark.range(n).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("internal_record_id"), "id")


@pytest.mark.parametrize("n,want", [(20, (16, 2, 2)), (10, (8, 1, 1)), (0, (0, 0, 0)), (7, (5, 0, 2))])
def test_split_counts(spark, n, want):
    got = {r.split: r["count"] for r in splits.seeded_split(records(spark, n)).groupBy("split").count().collect()}
    assert tuple(got.get(s, 0) for s in ("train", "val", "test")) == want


def test_split_is_deterministic_and_seeded(spark):
    rows = records(spark, 200)
    pick = lambda seed, parts: {r.id: r.split for r in splits.seeded_split(rows.repartition(parts), seed=seed).collect()}
    assert pick(42, 2) == pick(42, 5)
    assert pick(42, 2) != pick(7, 2)


def test_split_guards(spark):
    with pytest.raises(ValueError, match="sum to 1"):
        splits.seeded_split(records(spark, 5), train_ratio=0.5)
    with pytest.raises(ValueError, match="Duplicate"):
        splits.seeded_split(records(spark, 5).union(records(spark, 1)))


def test_sample(spark):
    rows = records(spark, 50)
    assert splits.seeded_sample(rows, "internal_record_id", 12).count() == 12
    with pytest.raises(ValueError, match="Cannot sample"):
        splits.seeded_sample(rows, "internal_record_id", 51)


def test_diverse_sample_covers_all_categories(spark):
    kinds = ["a", "b", "c", "d", "e", "f"]
    rows = [(f"r{i}", 1 + i % 3, [kinds[i % 6]]) for i in range(12)] + [("empty", 0, [])]
    frame = spark.createDataFrame(rows, "internal_record_id string, valid_object_count int, category_names array<string>")
    picked = splits.diverse_sample(frame, 6).collect()
    assert len(picked) == 6 and {n for r in picked for n in r.category_names} == set(kinds)
    assert sorted(r.pick for r in picked) == [1, 2, 3, 4, 5, 6]
    with pytest.raises(ValueError):
        splits.diverse_sample(frame, 14)


@pytest.mark.parametrize("batch", [1, 3, 256])
def test_diverse_sample_is_the_plain_greedy_choice(spark, monkeypatch, batch):
    monkeypatch.setattr(splits, "DIVERSE_BATCH", batch)
    rows = [(f"r{i}", 1 + i * 5 % 4, sorted({f"c{i * 7 % 9}", f"c{i * i % 11}", f"c{i % 3}"})) for i in range(40)]
    frame = spark.createDataFrame(rows, "internal_record_id string, valid_object_count int, category_names array<string>")
    hashes = {r[0]: r[1] for r in frame.select("internal_record_id", splits.seeded_hash(F.col("internal_record_id"))).collect()}
    seen, left, want = set(), list(rows), []
    while len(want) < 9:
        best = min(left, key=lambda r: (-len(set(r[2]) - seen), -len(r[2]), -r[1], hashes[r[0]], r[0]))
        left.remove(best)
        want.append(best[0])
        seen |= set(best[2])
    got = splits.diverse_sample(frame, 9).orderBy("pick").collect()
    assert [r.internal_record_id for r in got] == want


def lines(spark, *texts):
    return spark.createDataFrame([("f.txt", i + 1, t) for i, t in enumerate(texts)], "label_file string, line_no long, line string")


def test_lint_dialects(spark):
    bad = lines(spark, "80 0.5 0.5 0.2 0.2", "1 1.2 0.5 0.2 0.2")
    assert {r.error for r in annotate.lint_label_lines(bad, "smoke").collect()} == {"class_out_of_range", "value_out_of_range"}
    assert annotate.lint_label_lines(bad, "smoke").count() == 2
    assert annotate.lint_label_lines(bad, "project").count() == 1
    odd = lines(spark, "", "1.0 0.5 0.5 0.2 0.2", "-1 0.5 0.5 0 0.2", "1 x 0.5 0.2 0.2", "1 0.5")
    count = lambda d: sorted((r.line_no, r.error) for r in annotate.lint_label_lines(odd, d).collect())
    assert (1, "field_count") in count("processed") and (2, "non_numeric") in count("processed")
    assert all(n not in (1, 2) for n, _ in count("smoke"))
    assert [e for n, e in count("project") if n == 3] == ["class_out_of_range", "non_positive_size"]


def test_leakage(spark):
    rows = spark.createDataFrame([("train", 1), ("test", 1), ("val", 2), ("train", 3)], "split string, k int")
    got = {(r.left_split, r.right_split): r.overlaps for r in splits.split_leakage(rows, {"k": F.col("k")}).collect()}
    assert got == {("test", "train"): 1, ("test", "val"): 0, ("train", "val"): 0}


def test_read_document(spark, tmp_path):
    document = {
        "images": [{"id": 1, "file_name": "a.jpg", "width": 100, "height": 100, "license": 3}],
        "annotations": [
            {"id": 5, "image_id": 1, "category_id": 1, "bbox": [10, 10, 20, 20], "area": 400, "iscrowd": 0},
            {"id": 6, "image_id": 1, "category_id": 1},
        ],
        "categories": [{"id": 1, "name": "person", "supercategory": "human"}],
    }
    (tmp_path / "d.json").write_text(json.dumps(document, indent=1))
    tables = readers.read_coco(spark, str(tmp_path / "d.json"), "val2017")
    mapping = annotate.category_mapping(tables.categories)
    rows = {r.annotation_id: r for r in annotate.classify_annotations(tables.annotations, tables.images, mapping).collect()}
    assert rows[5].status == "accepted" and tuple(rows[5].yolo) == (0.2, 0.2, 0.2, 0.2)
    assert rows[6].reason == "missing_bbox" and rows[5].internal_record_id == "val2017_1_5"
    (tmp_path / "bad.json").write_text("not json")
    with pytest.raises(Exception):  # noqa: B017
        readers.read_coco(spark, str(tmp_path / "bad.json"), "x").images.collect()


def test_processed_manifests_must_agree(spark, tmp_path):
    body = lambda name: json.dumps({"images": [{"image_id": 1, "source_split": "a", "file_name": "f", "width": 1, "height": 1}],
                                    "categories": [{"class_id": 0, "coco_category_id": 1, "name": name, "supercategory": ""}]})
    (tmp_path / "a.json").write_text(body("person"))
    (tmp_path / "b.json").write_text(body("person"))
    images, categories = readers.read_processed(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")])
    assert images.count() == 2 and categories.count() == 1
    (tmp_path / "c.json").write_text(body("car"))
    with pytest.raises(ValueError, match="mismatch"):
        readers.read_processed(spark, [str(tmp_path / n) for n in ("a.json", "c.json")])


def test_labels_and_lists_keep_order(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.txt").write_text("1 0.1 0.1 0.1 0.1\n2 0.2 0.2 0.2 0.2\n")
    (tmp_path / "l" / "b.txt").write_text("3 0.1 0.1 0.1 0.1")
    rows = {(r.label_file, r.line_no): r.line[0] for r in readers.read_labels(spark, str(tmp_path / "l")).collect()}
    assert rows == {("a.txt", 1): "1", ("a.txt", 2): "2", ("b.txt", 1): "3"}
    for folder in ("train", "val", "a b+c%20"):
        (tmp_path / "deep" / folder).mkdir(parents=True)
        (tmp_path / "deep" / folder / "a.txt").write_text("1 0.1 0.1 0.1 0.1")
    files = {r.label_file for r in readers.read_labels(spark, str(tmp_path / "deep")).collect()}
    assert files == {"train/a.txt", "val/a.txt", "a b+c%20/a.txt"}
    (tmp_path / "list.txt").write_text(" z.jpg \n\n  \na.jpg\nm.jpg\n")
    listed = readers.read_image_list(spark, str(tmp_path / "list.txt")).orderBy("file", "ord").collect()
    assert [r.path for r in listed] == ["z.jpg", "a.jpg", "m.jpg"]


def test_epochs(spark, tmp_path):
    names = ["epoch", "metrics/precision"]
    (tmp_path / "r.csv").write_text("      epoch,   metrics/precision\n   1,  0.9\n   0,  0.9\n")
    rows = readers.read_epochs(spark, str(tmp_path / "r.csv"), names)
    assert [r.epoch for r in rows.collect()] == [0, 1]
    best = runs.best_epoch(rows, [("precision", "metrics/precision", "max")]).first()
    assert (best.best_epoch, best.final_epoch) == (0, 1)
    assert runs.completed_note(rows, 3).first()[1] == "2 epochs completed although 3 were configured."
    (tmp_path / "e.csv").write_text("epoch,metrics/precision\n")
    with pytest.raises(ValueError, match="No training rows"):
        readers.read_epochs(spark, str(tmp_path / "e.csv"), names)


def test_eval_log(spark):
    text = ["  Class  Images Instances P R mAP50 mAP50-95", "all 2500 17751 0.68 0.553 0.61 0.38", "cell phone 10 12 0.5 0.4 0.3 0.2",
            "Speed: 4.4ms pre-process, 363.1ms inference, 15.1ms NMS per image", "", "noise"]
    rows, speed = runs.parse_eval_log(spark.createDataFrame([(t,) for t in text], "line string"))
    assert {r.class_name: r.map50 for r in rows.collect()} == {"all": 0.61, "cell phone": 0.3}
    assert tuple(speed.first()) == (4.4, 363.1, 15.1)


def test_class_filter(spark):
    mapping = spark.createDataFrame([(0, "person"), (1, "cell phone")], "class_id long, name string")
    entries = spark.createDataFrame([("Cell Phone",), ("7",), ("nope",)], "entry string")
    got = {r.entry: r.class_id for r in runs.resolve_class_filter(entries, mapping).collect()}
    assert got == {"Cell Phone": 1, "7": 7, "nope": None}
    with pytest.raises(ValueError, match="Unknown"):
        runs.resolve_class_filter(entries, mapping, strict=True)
    detections = spark.range(3).select(F.col("id").alias("class_id"))
    assert runs.filter_by_class(detections, None).count() == 3


def test_readiness_paths(spark):
    base = dict(checkpoint_exists=True, yaml_exists=True, manifest_exists=True, yaml_train="a", yaml_val="b", yaml_test="b",
                manifest_name="val_manifest.csv", usable_pairs=0, exact_subset_available=False)
    r = quality.evaluation_readiness(spark.createDataFrame([base])).first()
    assert r.evaluation_readiness_status == "blocked" and r.refused_validation_manifest
    assert not r.no_validation_data_substitution and "no usable" in r.blocking_issues


def test_label_files_round_trip(spark, tmp_path):
    rows = [("t", 1, 10, 3, 0.1, 0.2, 0.3, 0.4), ("t", 1, 11, 4, 1 / 3, 0.5, 0.25, 0.125)]
    frame = spark.createDataFrame(rows, "source_split string, image_id long, annotation_id long, class_id long, xc double, yc double, bw double, bh double")
    yolo = F.struct("xc", "yc", F.col("bw").alias("w"), F.col("bh").alias("h"))
    classified = frame.select("source_split", "image_id", "annotation_id", "class_id", yolo.alias("yolo"), F.lit("accepted").alias("status"))
    images = spark.createDataFrame([("t", 1), ("t", 2)], "source_split string, image_id long")
    table = writers.label_table(classified, images)
    assert table.filter("label_file like '%2.txt' and line is null").count() == 1
    writers.write_label_table(table, str(tmp_path / "table"))
    writers.write_label_files(table, str(tmp_path / "files"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 3
    expected = joins.label_lines_from(classified)
    parsed = annotate.parse_label_lines(joins.label_text(expected).select("source_split", "image_id", "pos", "line"))
    r = joins.label_roundtrip(parsed, expected).first()
    assert (r.positions, r.missing_lines, r.extra_lines, r.mismatches) == (2, 0, 0, 0)


def test_class_tokens_that_are_no_numbers_do_not_stop_the_job(spark):
    lines = [("a.txt", n, t) for n, t in enumerate(["nan .5 .5 .1 .1", "1e30 .5 .5 .1 .1", "-0.5 .5 .5 .1 .1", ""])]
    frame = spark.createDataFrame(lines, "label_file string, line_no int, line string")
    assert [r.class_id for r in annotate.parse_label_lines(frame).sort("line_no").collect()] == [None, None, 0, None]
    found = annotate.lint_label_lines(frame, "smoke").filter("line_no < 3").collect()
    assert {(r.line_no, r.error) for r in found} == {(0, "non_numeric"), (1, "non_numeric")}


def test_nested_records_name_their_parts(spark):
    images = spark.createDataFrame([("a", 1), ("a", 2)], "source_split string, image_id long")
    box = F.struct(*[F.lit(0.5).alias(c) for c in ("xc", "yc", "w", "h")])
    annotations = spark.range(7).select(
        F.lit("a").alias("source_split"), F.lit(1).cast("long").alias("image_id"), F.col("id").alias("annotation_id"),
        *[F.col("id").alias(c) for c in ("category_id", "class_id")], F.lit("n").alias("category_name"),
        *[F.lit(1.0).alias(c) for c in "xywh"], box.alias("yolo"),
    )
    for size, expected in ((3, [(1, 0, 3, 3), (1, 1, 3, 3), (1, 2, 3, 1), (2, 0, 1, 0)]), (1000, [(1, 0, 1, 7), (2, 0, 1, 0)])):
        found = writers.nest_records(images, annotations, size).select("image_id", "part", "parts", F.size("annotations"))
        assert sorted(map(tuple, found.collect())) == expected


def test_records_of_usual_images_are_nested_without_a_rank(spark, monkeypatch, tmp_path):
    images = spark.createDataFrame([("t", i, "train") for i in range(7)], "source_split string, image_id long, project_split string")
    columns = "annotation_id long, image_id long, source_split string, category_id long, class_id long, category_name string, x double, y double, w double, h double, yolo struct<xc:double,yc:double,w:double,h:double>"
    rows = [(n, None if n == 17 else n % 6, "t", 1, 0, "a", 1.0, 2.0, 3.0, float(n), (0.1, 0.2, 0.3, 0.4)) for n in range(18)]
    monkeypatch.setattr(writers, "_runs", None)
    nested = writers.nest_records(images, spark.createDataFrame(rows, columns), 3)
    writers.write_records(nested, str(tmp_path / "records"), "project_split", per_file=2)
    files = list((tmp_path / "records").rglob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert max(spark.read.text(str(f)).count() for f in files) <= 2
    found = {r.image_id: [a.id for a in r.annotations] for r in readers.read_manifest_jsonl(spark, str(tmp_path / "records")).collect()}
    assert found == {i: [n for n in range(18) if n % 6 == i and n != 17] for i in range(7)}
