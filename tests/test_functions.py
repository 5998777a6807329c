"""Literal cases for boxes, names and media facts."""

import pytest
from pyspark.sql import functions as F

from annolake.functions import boxes, names


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def lit(*values):
    return [F.lit(float(v)) for v in values]


def test_box_to_normalised(spark):
    r = one(spark, boxes.to_yolo(*lit(10, 20, 30, 40), F.lit(100), F.lit(200)).alias("r")).r
    assert r.reason is None
    assert (r.box.xc, r.box.yc, r.box.w, r.box.h) == pytest.approx((0.25, 0.2, 0.3, 0.2))


def test_box_errors(spark):
    zero = one(spark, boxes.to_yolo(*lit(10, 20, 0, 40), F.lit(100), F.lit(200)).alias("r")).r
    outside = one(spark, boxes.to_yolo(*lit(200, 200, 10, 10), F.lit(100), F.lit(100)).alias("r")).r
    assert zero.reason == "bbox_size_not_positive" and zero.box is None
    assert outside.reason == "bbox_outside_image"


def test_clip(spark):
    r = one(
        spark,
        boxes.clip_box(*lit(-5, 10, 20, 20), F.lit(100), F.lit(100)).alias("a"),
        boxes.clip_box(*lit(200, 200, 10, 10), F.lit(100), F.lit(100)).alias("b"),
    )
    assert tuple(r.a) == (0, 10, 15, 20) and r.b is None


def test_letterbox(spark):
    frame = boxes.letterbox(F.lit(800), F.lit(400), 640)
    corners = F.struct(*[v.alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), lit(0, 0, 800, 400), strict=True)])
    r = one(spark, frame.alias("f"), boxes.letterbox_corners(corners, frame).alias("c"))
    assert (r.f.scale, r.f.left, r.f.top) == (0.8, 0, 160)
    assert tuple(r.c) == (0, 160, 640, 480)


def test_iou(spark):
    r = one(
        spark,
        boxes.iou(*lit(0, 0, 10, 10), *lit(5, 0, 10, 10)).alias("a"),
        boxes.iou(*lit(0, 0, 10, 10), *lit(20, 0, 10, 10)).alias("b"),
    )
    assert r.a == pytest.approx(1 / 3) and r.b == 0


def test_names(spark):
    r = one(
        spark,
        names.parse_project_image(F.lit("a/train2017_000000000009.JPG")).alias("p"),
        names.parse_project_image(F.lit("a/photo.jpg")).alias("q"),
        names.prediction_image_id(F.lit("train2017_000000000007")).alias("i"),
        names.prediction_image_id(F.lit("42")).alias("j"),
        names.prediction_image_id(F.lit("x42")).alias("k"),
        names.label_path(F.lit("d/images/train/a.b.jpg")).alias("l1"),
        names.label_path(F.lit("d/photos/x.jpg")).alias("l2"),
        names.label_path(F.lit("images/train/images/x.jpg")).alias("l3"),
        names.safe_output_name(F.lit("id"), F.lit("my photo (1).JPG"), "annotated").alias("s"),
        names.safe_output_name(F.lit("id"), F.lit("..."), "x", "mp4").alias("s2"),
        names.basename(F.lit("G:\\a\\b.jpg")).alias("b"),
        names.extension(F.lit("a.tar.GZ")).alias("e"),
        names.extension(F.lit(".hidden")).alias("e2"),
    )
    assert tuple(r.p) == ("train2017", 9, "000000000009.jpg") and r.q is None
    assert (r.i, r.j, r.k) == (7, 42, None)
    assert r.l1 == "d/labels/train/a.b.txt" and r.l2 == "d/labels/photos/x.txt"
    assert r.l3 == "labels/train/images/x.txt"
    assert r.s == "id_my_photo__1__annotated.jpg"
    assert r.b == "b.jpg" and r.e == "gz" and r.e2 == ""


def test_label_path_without_images_directory(spark):
    r = one(spark, names.label_path(F.lit("set/photos/day1/x.jpg")).alias("p"))
    assert r.p == "set/photos/labels/day1/x.txt"


def test_media(spark):
    fourcc = sum(ord(c) << (8 * i) for i, c in enumerate("avc1"))
    r = one(
        spark,
        names.codec_tag(F.lit(fourcc)).alias("c"),
        names.codec_tag(F.lit(0)).alias("z"),
        names.codec_browser_compatible(F.lit(" H264 ")).alias("ok"),
        names.codec_browser_compatible(F.lit(None).cast("string")).alias("none"),
        names.effective_fps(F.lit(0.0)).alias("fps"),
        names.video_duration(F.lit(60), F.lit(0.0)).alias("d"),
        names.latency_to_fps(F.lit(0.0)).alias("f0"),
        names.valid_result_id(F.lit("../etc/passwd")).alias("bad"),
        names.path_excluded(F.lit("data\\raw\\coco\\x.jpg")).alias("ex"),
        names.archive_entry_flags(F.lit("data/raw/coco2017/train2017/000000000009.jpg")).alias("fl"),
    )
    assert (r.c, r.z, r.ok, r.none, r.fps, r.d, r.f0, r.bad, r.ex) == ("avc1", "", True, False, 30.0, 2.0, 0.0, False, True)
    assert r.fl.prohibited and r.fl.dataset_media and not r.fl.model_file


def test_checked_threshold(spark):
    assert one(spark, names.checked_threshold(F.lit(0.5), "IoU").alias("v")).v == 0.5
    with pytest.raises(Exception, match="between 0 and 1"):
        one(spark, names.checked_threshold(F.lit(1.5), "IoU").alias("v"))
