"""Documents read in byte ranges and joined from part files."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from annolake.sources import documents, readers, writers


@pytest.fixture
def small_ranges(spark):
    """Input splits of 4 KB, so that every document is read by many tasks."""
    names = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def _odd(rng):
    return "".join(rng.choice(["a", "}", "{", '"', "\\", "é", "]", "[", ",", " ", "\n"]) for _ in range(rng.randint(0, 12)))


def _document(rng):
    return {
        "info": {"x": {"y": [{"z": "}"}]}, "t": _odd(rng)},
        "images": [{"id": i, "file_name": _odd(rng)} for i in range(200)],
        "none": [],
        "annotations": [{"id": i, "seg": {"counts": _odd(rng), "size": [1, {"q": _odd(rng)}]}, "bbox": [1, 2, 3, 4.5]} for i in range(200)],
        "version": "}{",
        "categories": [{"id": 1, "name": _odd(rng)}],
        "nums": [1, 2, 3],
    }


def _sorted(values):
    return sorted(json.dumps(v, sort_keys=True) for v in values)


def test_elements_of_any_layout(spark, tmp_path, small_ranges):
    rng, made = random.Random(1), {}
    for name, layout in (("a", {}), ("b", {"indent": 1}), ("c", {"separators": (",", ":"), "ensure_ascii": False})):
        made[name] = _document(rng)
        (tmp_path / f"{name}.json").write_text(json.dumps(made[name], **layout) + "\n" * (name == "b"))
    assert spark.read.text(str(tmp_path), lineSep="}").rdd.getNumPartitions() > 10
    found = documents.json_elements(spark, str(tmp_path)).collect()
    for name, document in made.items():
        for section in document:
            want = document[section] if isinstance(document[section], list) else []
            got = [json.loads(r.element) for r in found if r.file.endswith(f"/{name}.json") and r.section == section]
            assert _sorted(got) == _sorted(v for v in want if isinstance(v, dict)), (name, section)


def test_top_level_arrays(spark, tmp_path, small_ranges):
    rng = random.Random(2)
    rows = [{"image_id": _odd(rng), "bbox": [1, 2], "n": {"m": _odd(rng)}} for _ in range(150)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "none.json").write_text("[]\n")
    found = documents.json_elements(spark, [str(tmp_path / "a.json"), str(tmp_path / "none.json")], 1).collect()
    assert _sorted(json.loads(r.element) for r in found) == _sorted(rows)


def test_broken_documents_are_errors(spark, tmp_path):
    good = json.dumps(_document(random.Random(3)))
    broken = ["not json", good[:1000], good[:-3], good + " x", good + "}", good.replace("}, {", "} {", 1), good.replace('"images": [', '"images": [[', 1)]
    for i, text in enumerate(broken):
        path = tmp_path / f"{i}.json"
        path.write_text(text)
        with pytest.raises(Exception, match="broken JSON document"):
            documents.json_elements(spark, str(path)).select("element").collect()
    (tmp_path / "p.json").write_text('[{"image_id": "1", "category_id": "x", "bbox": [], "score": 1}]')
    with pytest.raises(Exception, match="MALFORMED|FAILED|malformed"):
        readers.read_predictions(spark, str(tmp_path / "p.json")).collect()


def test_written_documents_load_and_read_back(spark, tmp_path, small_ranges):
    images = spark.createDataFrame(
        [(s, i, 'a"}.jpg', 10, 20) for s in ("train", "val") for i in range(150)], "source_split string, image_id long, file_name string, width int, height int"
    )
    boxes = spark.createDataFrame(
        [("train", i, i % 150, 1, 1.0, 2.0, None if i % 7 == 0 else 3.0, 4.0, 0) for i in [*range(300), 3, 3]] + [("only", 1, 1, 1, 1.0, 2.0, 3.0, 4.0, 1)],
        "source_split string, annotation_id long, image_id long, category_id long, x double, y double, w double, h double, iscrowd int",
    )
    categories = spark.createDataFrame([(1, "person", None), (2, "dog", "animal")], "category_id long, name string, supercategory string")
    path = str(tmp_path / "out")
    for _ in range(2):  # a second run replaces the first
        writers.write_coco_documents(images, boxes, categories, path)
        loaded = {p.stem: json.loads(p.read_text()) for p in (tmp_path / "out").glob("*.json")}
        assert {n: [len(v) for v in d.values()] for n, d in loaded.items()} == {"train": [150, 302, 2], "val": [150, 0, 2], "only": [0, 1, 2]}
    assert not (tmp_path / "out" / "_parts").exists()
    assert [e["id"] for e in loaded["val"]["images"]] == list(range(150)) and loaded["val"]["images"][3]["file_name"] == 'a"}.jpg'
    tables = readers.read_coco(spark, path, split_pattern=readers.FILE_SPLIT)
    assert {tuple(r) for r in tables.images.groupBy("source_split").count().collect()} == {("train", 150), ("val", 150)}
    kept = tables.annotations.filter("source_split = 'train'")
    assert kept.count() == 302 and kept.filter("w is null").count() == kept.filter(F.col("annotation_id") % 7 == 0).count() == 43
    assert sorted(tables.categories.select("category_id").collect()) == [(1,), (2,)]
    empty = str(tmp_path / "empty")
    writers.write_coco_documents(images.limit(0), boxes.limit(0), categories, empty)
    assert not list((tmp_path / "empty").glob("*.json"))


def test_label_lines_stay_numbered_over_byte_ranges(spark, tmp_path, small_ranges):
    rng = random.Random(5)
    want = set()
    for name, count in (("a/one.txt", 2500), ("a/two.txt", 3), ("b/one.txt", 900), ("b/none.txt", 0)):
        lines = [rng.choice(["0 0.1 0.2 0.3 0.4", "", " 7 é", "12 0.5 0.5 0.25 0.125"]) for _ in range(count)]
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("\n".join(lines) + "\n" * (count != 3) if count else "")
        want |= {(name, i, line) for i, line in enumerate(lines, 1)}
    assert {tuple(r) for r in readers.read_labels(spark, str(tmp_path)).collect()} == want


def test_the_split_is_matched_from_the_front_of_a_path():
    for pattern, split in ((readers.FILE_SPLIT, "val"), (readers.DIRECTORY_SPLIT, "b c")):
        assert re.match(pattern, "file:///x.json/a/b c/val.json")[1] == split
    assert not re.search(readers.FILE_SPLIT, "file:/a/.json") and not re.search(readers.DIRECTORY_SPLIT, "a//b.json")
    assert re.search(readers.FILE_SPLIT, "val.json")[1] == "val" and not re.search(readers.DIRECTORY_SPLIT, "val.json")


def test_documents_leave_only_their_elements(spark, tmp_path, monkeypatch):
    """Writing needs no checkpoint, and what reading staged on its way is deleted."""
    from annolake import session

    names = iter(range(99))
    monkeypatch.setattr(session, "staging_path", lambda _, name: str(tmp_path / "staged" / f"{name}-{next(names)}"))
    images = spark.createDataFrame([("train", i % 40, "a,b", 10, 20) for i in range(50)], "source_split string, image_id long, file_name string, width int, height int")
    boxes = spark.createDataFrame([], "source_split string, annotation_id long, image_id long, category_id long, x double, y double, w double, h double, iscrowd int")
    categories = spark.createDataFrame([(1, "person", None)], "category_id long, name string, supercategory string")
    monkeypatch.setattr(type(images), "checkpoint", lambda *_, **__: pytest.fail("a checkpoint"))
    path = str(tmp_path / "out")
    writers.write_coco_documents(images, boxes, categories, path)
    assert not (tmp_path / "staged").exists()
    loaded = json.loads((tmp_path / "out" / "train.json").read_text())
    assert [len(v) for v in loaded.values()] == [50, 0, 1] and [e["id"] for e in loaded["images"]] == sorted(i % 40 for i in range(50))
    assert documents.json_elements(spark, path).count() == 51
    assert [p.name.split("-")[0] for p in (tmp_path / "staged").iterdir()] == ["elements"]


def test_predictions_come_back_from_packed_documents(spark, tmp_path):
    rows = spark.range(50).select(F.col("id").cast("string").alias("image_id"), F.lit(1).alias("category_id"), F.array(*[F.lit(1.5)] * 4).alias("bbox"), F.lit(0.5).alias("score"))
    writers.write_text_files(writers.array_documents(rows, per_document=20), str(tmp_path / "p"), 1, "gzip")
    assert len(list((tmp_path / "p").glob("*.gz"))) == 3
    read = readers.read_predictions(spark, str(tmp_path / "p")).collect()
    assert sorted(int(r.image_id) for r in read) == list(range(50)) and {r.h for r in read} == {1.5}
