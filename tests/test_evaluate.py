"""The evaluator against an independent restatement of the protocol, with and without hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from annolake.constants import AREA_RANGES, IOU_THRESHOLDS
from annolake.operators import annotate, evaluate


def make(seed, images=12, classes=3):
    rng = random.Random(seed)
    gt, dt = [], []
    for image in range(images):
        for cls in range(classes):
            for _ in range(rng.randint(0, 5)):
                x, y, w, h = rng.randint(0, 60), rng.randint(0, 60), rng.choice([8, 20, 32, 60, 110]), rng.choice([10, 32, 90, 120])
                gt.append((image, cls, len(gt) + 1, float(x), float(y), float(w), float(h), float(w * h)))
                for _ in range(rng.randint(0, 3)):
                    j = lambda v: float(max(1, v + rng.randint(-4, 4)))
                    dt.append((image, cls, len(dt) + 1, j(x), j(y), j(w), j(h), rng.randint(1, 40) / 40))
            if rng.random() < 0.5:
                dt.append((image, cls, len(dt) + 1, 200.0, 200.0, 30.0, 30.0, rng.randint(1, 40) / 40))
    return gt, dt


def iou(a, b):
    w = min(a[3] + a[5], b[3] + b[5]) - max(a[3], b[3])
    h = min(a[4] + a[6], b[4] + b[6]) - max(a[4], b[4])
    return w * h / (a[5] * a[6] + b[5] * b[6] - w * h) if w > 0 and h > 0 else 0.0


def restated(gt, dt):
    """AP and AR by class, area range and threshold, straight from the protocol's text."""
    ap, ar, ar1, ar10 = {}, {}, {}, {}
    images = sorted({r[0] for r in gt} | {r[0] for r in dt})
    for cls in sorted({r[1] for r in gt}):
        for a, (_, lo, hi) in enumerate(AREA_RANGES):
            npig = sum(r[1] == cls and lo <= r[7] <= hi for r in gt)
            if not npig:
                continue
            for t, threshold in enumerate(IOU_THRESHOLDS):
                marks = []
                for image in images:
                    truth = [r for r in gt if r[0] == image and r[1] == cls]
                    truth.sort(key=lambda r: not lo <= r[7] <= hi)
                    dets = sorted((r for r in dt if r[0] == image and r[1] == cls), key=lambda r: (-r[7], r[2]))
                    used = set()
                    for rank, det in enumerate(dets[:100]):
                        best, bar = None, min(threshold, 1 - 1e-10)
                        for g in truth:
                            if g[2] in used:
                                continue
                            if best and lo <= best[7] <= hi and not lo <= g[7] <= hi:
                                break
                            value = iou(det, g)
                            if value < bar:
                                continue
                            best, bar = g, value
                        if best:
                            used.add(best[2])
                            ignored = not lo <= best[7] <= hi
                        else:
                            ignored = not lo <= det[5] * det[6] <= hi
                        marks.append((-det[7], image, rank, bool(best), ignored))
                marks.sort()
                kept = [m for m in marks if not m[4]]
                tp, precision, recall = 0, [], []
                for n, m in enumerate(kept, 1):
                    tp += m[3]
                    precision.append(tp / n)
                    recall.append(tp / npig)
                for i in range(len(precision) - 2, -1, -1):
                    precision[i] = max(precision[i], precision[i + 1])
                points = []
                for i in range(101):
                    at = next((k for k, r in enumerate(recall) if r >= i * 0.01), None)
                    points.append(0.0 if at is None else precision[at])
                ap[cls, a, t] = sum(points) / 101
                ar[cls, a, t] = tp / npig
                if a == 0:
                    ar1[cls, t] = sum(m[3] for m in kept if m[2] < 1) / npig
                    ar10[cls, t] = sum(m[3] for m in kept if m[2] < 10) / npig
    mean = lambda d, keep: (lambda v: sum(v) / len(v) if v else -1.0)([x for k, x in d.items() if keep(k)])
    return [
        mean(ap, lambda k: k[1] == 0), mean(ap, lambda k: k[1:] == (0, 0)), mean(ap, lambda k: k[1:] == (0, 5)),
        *[mean(ap, lambda k, a=a: k[1] == a) for a in (1, 2, 3)],
        mean(ar1, lambda k: True), mean(ar10, lambda k: True),
        *[mean(ar, lambda k, a=a: k[1] == a) for a in (0, 1, 2, 3)],
    ]


GT = "image_id long, class_id long, gt_id long, x double, y double, w double, h double, area double"
DT = "image_id long, class_id long, det_id long, x double, y double, w double, h double, score double"


@pytest.mark.parametrize("hot", [1_000, 1])
def test_summary(spark, monkeypatch, hot):
    monkeypatch.setattr(evaluate, "HOT_GROUP_BOXES", hot)
    gt, dt = make(5)
    found = evaluate.coco_ap_ar(evaluate.evaluate(spark.createDataFrame(gt, GT), spark.createDataFrame(dt, DT)))
    assert [r.value for r in found.collect()] == pytest.approx(restated(gt, dt), abs=2e-6)


def test_hot_keys_find_the_same_pairs(spark, monkeypatch):
    gt, dt = make(9, images=1)
    left = spark.createDataFrame(gt * 1, GT).drop("area")
    right = spark.createDataFrame(dt, DT).drop("score")
    pairs = lambda: sorted((r.l_gt_id, r.r_det_id) for r in evaluate.overlapping_boxes(left, right, "image_id", 0.45).collect())
    plain = pairs()
    monkeypatch.setattr(evaluate, "HOT_GROUP_BOXES", 1)
    assert plain and pairs() == plain
    assert plain == sorted((g[2], d[2]) for g in gt for d in dt if iou(g, d) > 0.45)
    # Many boxes on the right side alone make a key hot as well.
    monkeypatch.setattr(evaluate, "HOT_GROUP_BOXES", left.count())
    more = right.union(right.withColumn("det_id", F.col("det_id") + 10_000))
    both = evaluate.overlapping_boxes(left, more, "image_id", 0.45)
    assert "_cell_x" in both._jdf.queryExecution().analyzed().toString()
    assert both.count() == 2 * len(plain)


def test_convert_predictions(spark):
    images = spark.createDataFrame([(7,)], "image_id long")
    mapping = annotate.category_mapping(
        spark.createDataFrame([(3, "car", ""), (1, "person", "")], "category_id long, name string, supercategory string")
    )
    assert {r.category_id: r.class_id for r in mapping.collect()} == {1: 0, 3: 1}
    rows = [
        (1, "train2017_000000000007", 1, 1.0, 2.0, 3.0, 4.0, 0.9),
        (2, "8", 1, 1.0, 2.0, 3.0, 4.0, 0.9),
        (3, "7", 9, 1.0, 2.0, 3.0, 4.0, 0.9),
        (4, "7", 0, 1.0, 2.0, 0.0, 4.0, 0.9),
    ]
    raw = spark.createDataFrame(rows, "det_id long, image_id string, class_id int, x double, y double, w double, h double, score double")
    got = {r.det_id: (r.image_id, r.category_id, r.outcome) for r in evaluate.convert_predictions(raw, images, mapping).collect()}
    assert got[1] == (7, 3, "converted")
    assert [got[i][2] for i in (2, 3, 4)] == ["dropped_unknown_image", "dropped_unknown_category", "dropped_invalid_bbox"]
    assert evaluate.conversion_counters(evaluate.convert_predictions(raw, images, mapping)).first().source_prediction_count == 4


def test_top_detections_are_cut_before_the_shuffle(spark):
    rows = spark.createDataFrame(make(1)[1], DT)
    plan = evaluate.max_dets_rank(rows, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, plan


def test_empty_sides(spark):
    gt, dt = make(3)
    none = evaluate.evaluate(spark.createDataFrame(gt, GT), spark.createDataFrame([], DT))
    assert evaluate.coco_ap_ar(none).filter("metric = 'AP@0.50'").first().value == 0.0
    nothing = evaluate.evaluate(spark.createDataFrame([], GT), spark.createDataFrame(dt, DT))
    assert {r.value for r in evaluate.coco_ap_ar(nothing).collect()} == {-1.0}


def test_curves_have_no_interpreted_lambda(spark):
    truth = spark.createDataFrame([(1, 0, 1, 0.0, 0.0, 10.0, 10.0, 100.0)], "image_id long, class_id long, gt_id long, x double, y double, w double, h double, area double")
    found = spark.createDataFrame([(1, 0, 1, 0.0, 0.0, 10.0, 10.0, 0.5)], "image_id long, class_id long, det_id long, x double, y double, w double, h double, score double")
    per_class = evaluate.evaluate(truth, found).per_class
    assert "lambda" not in per_class._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.area, r.ap) for r in per_class.collect()} == {(0, 1.0), (1, 1.0)}


def test_cuts_are_staged_tables_and_curves_come_when_asked(spark, monkeypatch):
    from annolake import session

    truth = spark.createDataFrame([(i, i % 3, i, 0.0, 0.0, 10.0 + i, 10.0, 100.0 + 10 * i) for i in range(40)], "image_id long, class_id long, gt_id long, x double, y double, w double, h double, area double")
    found = truth.select("image_id", "class_id", F.col("gt_id").alias("det_id"), "x", "y", (F.col("w") + F.col("gt_id") % 4).alias("w"), "h", (F.col("gt_id") / 50).alias("score"))
    staged = []
    for module in (session, evaluate):
        put = module.stage
        monkeypatch.setattr(module, "stage", lambda df, name, put=put: staged.append(name) or put(df, name))
    monkeypatch.setattr(type(truth), "checkpoint", lambda *_, **__: pytest.fail("a checkpoint"))
    made = evaluate.evaluate(truth, found)
    assert "cut" in staged and "average" not in staged
    assert {r.class_id for r in made.per_class.collect()} == {0, 1, 2} and staged.count("average") == 4
    odd = spark.createDataFrame([(1, None)], "a int, b void")
    monkeypatch.undo()
    assert session.cut_lineage(odd).collect() == odd.collect()
