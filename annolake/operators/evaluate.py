"""Detection evaluation: prediction conversion, greedy matching, precision/recall, AP and AR.

Ground truth rows: ``image_id, class_id, gt_id, x, y, w, h, area``.
Detection rows:    ``image_id, class_id, det_id, x, y, w, h, score``.
Ties in score are broken by image and detection id.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolake.constants import AREA_RANGES, IOU_THRESHOLDS, MAX_DETECTIONS, SUMMARY_METRICS
from annolake.functions import boxes, names
from annolake.operators.ordered import HALO_CHUNK_ROWS, with_running_totals, with_totals_by_position
from annolake.session import broadcast_checked, cut_lineage, forget_shuffles, stage

GROUP = ["image_id", "class_id"]
# A group with more boxes than this is divided before boxes are paired.
HOT_GROUP_BOXES = 1_000
RECALL_STEP = 0.01
RECALL_POINTS = 101

# Thresholds of the class-agnostic confusion matrix.
CONFUSION_CONFIDENCE = 0.25
CONFUSION_IOU = 0.45


def convert_predictions(predictions: DataFrame, images: DataFrame, mapping: DataFrame) -> DataFrame:
    """Every prediction with its ``outcome``: converted, or the first reason to drop it."""
    known = images.select(F.col("image_id").alias("_image"), F.lit(True).alias("_known")).distinct()
    lookup = mapping.select(F.col("class_id").alias("_class"), "category_id")
    # Exploded, so that what later joins ask of the id is asked of the value: otherwise each of their filters is pushed
    # down with the whole expression, and a generated method of more than 8000 bytes is not compiled by the JVM.
    number = F.explode(F.array(names.prediction_image_id(F.col("image_id")))).alias("_id")
    named = predictions.select(*[c for c in predictions.columns if c != "image_id"], number)
    joined = named.join(known, F.col("_id") == F.col("_image"), "left").join(
        broadcast_checked(lookup), F.col("class_id").cast("long") == F.col("_class"), "left"
    )
    sized = (F.col("w") > 0) & (F.col("h") > 0) & F.col("x").isNotNull() & F.col("y").isNotNull()
    outcome = (
        F.when(F.col("_known").isNull(), "dropped_unknown_image")
        .when(F.col("category_id").isNull(), "dropped_unknown_category")
        .when(~F.coalesce(sized, F.lit(False)), "dropped_invalid_bbox")
        .otherwise("converted")
    )
    return joined.select(
        "det_id",
        F.col("_id").alias("image_id"),
        F.col("class_id").cast("long").alias("class_id"),
        "category_id",
        *[F.round(F.col(c), 3).alias(c) for c in ("x", "y", "w", "h")],
        F.round(F.coalesce("score", F.lit(0.0)), 5).alias("score"),
        outcome.alias("outcome"),
    )


def converted(predictions: DataFrame) -> DataFrame:
    return predictions.filter("outcome = 'converted'").drop("outcome")


def conversion_counters(predictions: DataFrame) -> DataFrame:
    """One row: read, converted and dropped counts."""
    return predictions.agg(
        F.count("*").alias("source_prediction_count"),
        F.count_if(F.col("outcome") == "converted").alias("converted_prediction_count"),
        *[
            F.count_if(F.col("outcome") == f"dropped_{kind}").alias(f"dropped_{kind}_count")
            for kind in ("unknown_image", "unknown_category", "invalid_bbox")
        ],
    )


def ground_truth(classified: DataFrame) -> DataFrame:
    """Accepted annotations as evaluation boxes (clipped, three decimals)."""
    box = boxes.round_box(F.col("clipped"))
    return classified.filter("status = 'accepted'").select(
        "image_id",
        "class_id",
        F.col("annotation_id").alias("gt_id"),
        *[box[c].alias(c) for c in ("x", "y", "w", "h")],
        boxes.box_area(box).alias("area"),
    )


def max_dets_rank(detections: DataFrame, keep: int = MAX_DETECTIONS) -> DataFrame:
    """Best ``keep`` detections per image and class, with their rank.

    The rank filter is pushed below the shuffle, so a crowded image sends few rows.
    """
    order = Window.partitionBy(*GROUP).orderBy(F.desc("score"), "det_id")
    return detections.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _size_class(area: Column) -> Column:
    """Bit per area range that contains the area (both ends belong to a range)."""
    return sum(
        (F.when(area.between(lo, hi), 1 << i).otherwise(0) for i, (_, lo, hi) in enumerate(AREA_RANGES)),
        F.lit(0),
    )


def candidate_pairs(gt: DataFrame, ranked: DataFrame, min_iou: float = IOU_THRESHOLDS[0]) -> DataFrame:
    """Box pairs of one image and class that overlap enough to match.

    A group holds at most ``MAX_DETECTIONS`` detections, so pairs grow linearly with the
    ground truth.  Groups with very many true boxes are spread over several salts; there a
    detection keeps, per size class, as many of its best boxes as the largest rank: fewer
    detections than that compete for them, so no other box can ever be taken.
    """
    left = gt.select(*GROUP, "gt_id", _size_class(F.col("area")).alias("gt_sizes"),
                     *[F.col(c).alias(f"g{c}") for c in ("x", "y", "w", "h")])
    right = ranked.select(*GROUP, "rank", "det_id", _size_class(F.col("w") * F.col("h")).alias("det_sizes"),
                          *[F.col(c).alias(f"d{c}") for c in ("x", "y", "w", "h")])
    hot = (
        gt.groupBy(*GROUP)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > HOT_GROUP_BOXES)
        .select(*GROUP, F.ceil(F.col("_n") / HOT_GROUP_BOXES).cast("int").alias("_salts"))
    )
    keys = list(GROUP)
    salted = not hot.isEmpty()
    if salted:
        hot = broadcast_checked(hot)
        left = left.join(hot, GROUP, "left").withColumn(
            "_salt", F.coalesce(F.pmod(F.hash("gt_id"), F.col("_salts")), F.lit(0))
        )
        right = right.join(hot, GROUP, "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
        )
        left, right = left.drop("_salts"), right.drop("_salts")
        keys.append("_salt")
    overlap = boxes.iou(*[F.col(f"{side}{c}") for side in "gd" for c in ("x", "y", "w", "h")])
    pairs = (
        left.join(right, keys)
        .withColumn("iou", overlap)
        .filter(F.col("iou") >= min_iou)
        .select(*GROUP, "rank", "det_id", "det_sizes", "gt_id", "gt_sizes", "iou")
    )
    if salted:
        # A detection has fewer rivals than the ranking keeps detections, however many that is.
        rivals = (ranked.agg(F.max("rank")).first()[0] or 0) + 1
        best = Window.partitionBy(*GROUP, "rank", "gt_sizes").orderBy(F.desc("iou"), F.desc("gt_id"))
        pairs = (
            pairs.withColumn("_nth", F.row_number().over(best))
            .filter(F.col("_nth") <= rivals)
            .drop("_nth")
        )
    return pairs


def _grouped(pairs: DataFrame) -> DataFrame:
    """One row per image and class with its detections in rank order and their candidates."""
    per_detection = pairs.groupBy(*GROUP, "rank", "det_id", "det_sizes").agg(
        F.collect_list(F.struct("iou", "gt_id", "gt_sizes")).alias("cands")
    )
    grouped = per_detection.groupBy(*GROUP).agg(
        F.sort_array(F.collect_list(F.struct("rank", "det_id", "det_sizes", "cands"))).alias("dets")
    )
    taken = F.flatten(F.transform("dets", lambda d: d["cands"]["gt_id"]))
    simple = (F.size(taken) == F.size("dets")) & (F.size(F.array_distinct(taken)) == F.size("dets"))
    return grouped.withColumn("simple", simple)


def _threshold(value: float) -> float:
    return min(value, 1 - 1e-10)


def _greedy(dets: Column, combos: Column) -> Column:
    """Per (area, threshold) the greedy one-to-one assignment in rank order.

    Each detection takes, among boxes still free and overlapping enough, one that counts in
    the area range before one that does not, then the best overlap, then the later box.
    """

    def assign(combo: Column) -> Column:
        def step(state: Column, det: Column) -> Column:
            free = F.filter(
                det["cands"],
                lambda c: (c["iou"] >= combo["threshold"]) & ~F.array_contains(state["used"], c["gt_id"]),
            )
            best = F.array_max(
                F.transform(
                    free,
                    lambda c: F.struct(
                        (c["gt_sizes"].bitwiseAND(combo["area_bit"]) != 0).alias("counts"),
                        c["iou"].alias("iou"),
                        c["gt_id"].alias("gt_id"),
                    ),
                )
            )
            # The one-element transform binds `best` once instead of repeating its expression.
            return F.element_at(
                F.transform(
                    F.array(best),
                    lambda b: F.when(b.isNull(), state).otherwise(
                        F.struct(
                            F.concat(state["used"], F.array(b["gt_id"])).alias("used"),
                            F.concat(
                                state["out"],
                                F.array(
                                    F.struct(
                                        combo["combo"].alias("combo"),
                                        det["rank"].alias("rank"),
                                        det["det_id"].alias("det_id"),
                                        det["det_sizes"].alias("det_sizes"),
                                        b["gt_id"].alias("gt_id"),
                                        b["counts"].alias("counts"),
                                    )
                                ),
                            ).alias("out"),
                        )
                    ),
                ),
                1,
            )

        start = F.struct(
            F.array().cast("array<bigint>").alias("used"),
            F.array()
            .cast(
                "array<struct<combo:int,rank:int,det_id:bigint,det_sizes:int,gt_id:bigint,counts:boolean>>"
            )
            .alias("out"),
        )
        return F.aggregate(dets, start, step, lambda state: state["out"])

    return F.flatten(F.transform(combos, assign))


def _combos(areas: int = len(AREA_RANGES)) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(a * len(IOU_THRESHOLDS) + t).alias("combo"),
                F.lit(1 << a).alias("area_bit"),
                F.lit(_threshold(value)).alias("threshold"),
            )
            for a in range(areas)
            for t, value in enumerate(IOU_THRESHOLDS)
        ]
    )


def match_detections(gt: DataFrame, ranked: DataFrame) -> DataFrame:
    """Matches over all sizes: ``image_id, class_id, det_id, gt_id, iou_threshold``."""
    grouped = _grouped(candidate_pairs(cut_lineage(gt), ranked))
    found = grouped.select(*GROUP, F.inline(_greedy(F.col("dets"), _combos(areas=1))))
    thresholds = F.array(*[F.lit(t) for t in IOU_THRESHOLDS])
    return found.select(
        *GROUP, "det_id", "gt_id", F.get(thresholds, F.col("combo")).alias("iou_threshold")
    )


def _match_masks(pairs: DataFrame) -> DataFrame:
    """Per matched detection two bit sets over (area, threshold): counted and ignored matches."""
    grouped = _grouped(pairs)
    steps = len(IOU_THRESHOLDS)

    # One candidate each way: nothing to compete for, the overlap alone decides.
    lone = grouped.filter("simple").select(*GROUP, F.inline("dets")).withColumn("c", F.element_at("cands", 1))
    reached = sum(
        (F.when(F.col("c.iou") >= _threshold(t), 1 << i).otherwise(0) for i, t in enumerate(IOU_THRESHOLDS)),
        F.lit(0),
    ).cast("long")
    counted, ignored = F.lit(0).cast("long"), F.lit(0).cast("long")
    for a in range(len(AREA_RANGES)):
        inside = F.col("c.gt_sizes").bitwiseAND(F.lit(1 << a)) != 0
        shifted = F.shiftleft(F.col("_reached"), a * steps)
        counted = counted + F.when(inside, shifted).otherwise(0)
        ignored = ignored + F.when(inside, 0).otherwise(shifted)
    lone = lone.withColumn("_reached", reached).select(
        *GROUP, "rank", "det_sizes", counted.alias("counted"), ignored.alias("ignored")
    )

    bit = F.expr("shiftleft(1L, combo)")
    contested = (
        grouped.filter("not simple")
        .select(*GROUP, F.inline(_greedy(F.col("dets"), _combos())))
        .groupBy(*GROUP, "rank", "det_sizes")
        .agg(
            F.coalesce(F.bit_or(F.when(F.col("counts"), bit)), F.lit(0)).alias("counted"),
            F.coalesce(F.bit_or(F.when(~F.col("counts"), bit)), F.lit(0)).alias("ignored"),
        )
    )
    return lone.unionByName(contested)


@dataclass
class Evaluation:
    """Intermediate tables of one evaluation run."""

    detections: DataFrame  # ranked detections with match bit sets and position within the class
    rates: DataFrame | None  # what `per_class` is, if it is known
    truth: DataFrame

    @cached_property
    def per_class(self) -> DataFrame:
        """``class_id, area, threshold``, positives, ``ap``, ``recall`` (at 1 and 10 too); worked out when first asked for."""
        return _per_class(self.detections, self.truth) if self.rates is None else self.rates


def _bit(mask: str, index: int) -> Column:
    return F.shiftright(F.col(mask), index).bitwiseAND(F.lit(1))


def evaluate(gt: DataFrame, detections: DataFrame) -> Evaluation:
    """Match once, then derive every curve and summary from the match bit sets."""
    truth = cut_lineage(gt)
    ranked = cut_lineage(max_dets_rank(detections))
    # Cut, so that what pairs the boxes is gone before the ranking begins.
    masks = cut_lineage(_match_masks(candidate_pairs(truth, ranked)).drop("det_sizes"))
    areas = len(AREA_RANGES)

    scored = ranked.join(masks, [*GROUP, "rank"], "left").select(
        *GROUP, "det_id", "rank", "score",
        _size_class(F.col("w") * F.col("h")).alias("sizes"),
        F.coalesce("counted", F.lit(0)).alias("counted"),
        F.coalesce("ignored", F.lit(0)).alias("ignored"),
    )
    in_range = {
        f"seen_{a}": F.shiftright(F.col("sizes"), a).bitwiseAND(F.lit(1)).cast("long") for a in range(1, areas)
    }
    placed = with_running_totals(
        scored, ["class_id"], [F.desc("score"), "image_id", "rank"],
        {"position": F.lit(1).cast("long"), **in_range},
    )
    return Evaluation(cut_lineage(placed), None, truth)


def _moves(placed: DataFrame, area: int) -> DataFrame:
    """One row per threshold in which a detection hit in the area range, or changes what counts there.

    Only matched detections move recall; false positives enter through ``position``/``seen``.  An out-of-range detection
    counts when it matched a counting box, an in-range one does not when it matched an ignored box.
    """
    steps = len(IOU_THRESHOLDS)
    bit = lambda mask, index: F.expr(f"shiftright({mask}, {index}) & 1")
    # Plain conditions are compiled, a lambda over a sequence is not; nor is a generated method of more than 8000 bytes,
    # which all areas and thresholds at once come to beside a scan.
    touched = [F.when(F.expr(f"(shiftright(counted | ignored, {area * steps + i}) & 1) = 1"), F.lit(i)) for i in range(steps)]
    adjust = F.lit(0).cast("long") if not area else F.when(bit("sizes", area) == 0, F.col("hit")).otherwise(-bit("ignored", "combo"))
    return (
        placed.filter("counted != 0 or ignored != 0")
        .withColumn("threshold", F.explode(F.array(*touched)))
        .filter("threshold is not null")
        .withColumn("combo", F.lit(area * steps) + F.col("threshold"))
        .withColumn("hit", bit("counted", "combo").cast("long"))
        .withColumn("adjust", adjust)
        .filter("hit != 0 or adjust != 0")
        .select("class_id", "combo", F.lit(area).alias("area"), "position", "rank", "hit", "adjust", F.col(f"seen_{area}" if area else "position").alias("seen"))
    )


def _per_class(placed: DataFrame, truth: DataFrame) -> DataFrame:
    steps, areas = len(IOU_THRESHOLDS), len(AREA_RANGES)
    positives = broadcast_checked(
        _positives(truth).select("class_id", F.posexplode(F.array(*[F.col(f"npig_{a}") for a in range(areas)])).alias("area", "npig"))
    )
    # An area after the other, each down to a few rows a class: the rows of all at once would fill the disks.
    parts = []
    for area in range(areas):
        moves = _moves(placed, area)
        totals = moves.groupBy("class_id", "combo").agg(
            F.sum("hit").alias("tp"),
            *[F.sum(F.when(F.col("rank") <= keep, F.col("hit")).otherwise(0)).alias(f"top{keep}") for keep in (1, 10)],
        )
        parts.append((stage(totals, "totals"), stage(_average(moves, positives), "average")))
        forget_shuffles(placed.sparkSession)
    totals, average = (reduce(DataFrame.union, some) for some in zip(*parts, strict=True))
    share = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.col("npig")
    return (
        positives.filter("npig > 0")
        .withColumn("threshold", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
        .withColumn("combo", F.col("area") * steps + F.col("threshold"))
        .join(totals, ["class_id", "combo"], "left")
        .join(average, ["class_id", "combo"], "left")
        .select(
            "class_id", "area", "threshold", "npig",
            F.coalesce("ap", F.lit(0.0)).alias("ap"),
            share("tp").alias("recall"), share("top1").alias("recall_1"), share("top10").alias("recall_10"),
        )
    )


def _average(moves: DataFrame, positives: DataFrame) -> DataFrame:
    """``class_id, combo, ap``: the mean precision over the recall points."""
    running = with_totals_by_position(
        moves, ["class_id", "combo"], "position", {"tp": F.col("hit"), "adjusted": F.col("adjust")}
    )
    curve = (
        running.filter("hit = 1")
        .join(positives, ["class_id", "area"])
        .withColumn("block", _recall_block(F.col("tp"), F.col("npig")))
        .groupBy("class_id", "combo", "block")
        .agg(F.max(F.col("tp") / (F.col("seen") + F.col("adjusted"))).alias("precision"))
    )
    # Precision at a recall point is the best precision at or beyond it; a block stands for
    # the recall points after the previous block up to itself.
    by_block = Window.partitionBy("class_id", "combo").orderBy("block")
    beyond = by_block.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        curve.withColumn("_best", F.max("precision").over(beyond))
        .withColumn("_width", F.col("block") - F.coalesce(F.lag("block").over(by_block), F.lit(-1)))
        .groupBy("class_id", "combo")
        .agg((F.sum(F.col("_best") * F.col("_width")) / RECALL_POINTS).alias("ap"))
    )


def _positives(truth: DataFrame) -> DataFrame:
    """Boxes that count, per class and area range."""
    return truth.groupBy("class_id").agg(
        *[F.count_if(F.col("area").between(lo, hi)).alias(f"npig_{i}") for i, (_, lo, hi) in enumerate(AREA_RANGES)]
    )


def _recall_block(tp: Column, npig: Column) -> Column:
    """Largest i with i * 0.01 <= tp / npig, compared in double arithmetic."""
    near = F.floor(tp * 100 / npig)
    recall = tp / npig
    return (
        F.when((near + 1) * RECALL_STEP <= recall, near + 1)
        .when(near * RECALL_STEP <= recall, near)
        .otherwise(near - 1)
        .cast("int")
    )


def coco_ap_ar(evaluation: Evaluation) -> DataFrame:
    """The twelve summary metrics, six decimals; -1 where nothing counts."""
    rows = evaluation.per_class
    area, step = F.col("area"), F.col("threshold")
    values = [
        F.avg(F.when(area == 0, F.col("ap"))),
        F.avg(F.when((area == 0) & (step == 0), F.col("ap"))),
        F.avg(F.when((area == 0) & (step == 5), F.col("ap"))),
        *[F.avg(F.when(area == a, F.col("ap"))) for a in (1, 2, 3)],
        F.avg(F.when(area == 0, F.col("recall_1"))),
        F.avg(F.when(area == 0, F.col("recall_10"))),
        *[F.avg(F.when(area == a, F.col("recall"))) for a in (0, 1, 2, 3)],
    ]
    one = rows.agg(*[F.round(F.coalesce(v, F.lit(-1.0)), 6).alias(f"m{i}") for i, v in enumerate(values)])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("metric"), F.col(f"m{i}").alias("value")) for i, name in enumerate(SUMMARY_METRICS)]
    )
    return one.select(F.inline(pairs))


def coco_ap_by_class(evaluation: Evaluation, mapping: DataFrame) -> DataFrame:
    """AP over all thresholds per class; -1 for a class without true boxes."""
    per_class = (
        evaluation.per_class.filter("area = 0").groupBy("class_id").agg(F.avg("ap").alias("_ap"))
    )
    return mapping.join(per_class, "class_id", "left").select(
        "class_id", F.col("name").alias("class_name"), F.round(F.coalesce("_ap", F.lit(-1.0)), 6).alias("ap")
    )


def pr_curve(evaluation: Evaluation, threshold: int = 0) -> DataFrame:
    """Recall, precision and envelope at each true positive of a class (all sizes)."""
    hits = evaluation.detections.filter(_bit("counted", threshold) == 1)
    npig = evaluation.truth.groupBy("class_id").agg(F.count("*").alias("npig"))
    ordered = with_totals_by_position(hits, ["class_id"], "position", {"tp": F.lit(1).cast("long")})
    points = ordered.join(broadcast_checked(npig), "class_id").select(
        "class_id", "position", "score", "tp",
        (F.col("tp") / F.col("npig")).alias("recall"),
        (F.col("tp") / F.col("position")).alias("precision"),
        F.floor(F.col("position") / HALO_CHUNK_ROWS).alias("_chunk"),
    )
    # Envelope: best precision from here on.  Later chunks enter by their maxima, the rest
    # of the own chunk by a window of bounded size.
    best = points.groupBy("class_id", "_chunk").agg(F.max("precision").alias("_m"))
    later = Window.partitionBy("class_id").orderBy("_chunk").rowsBetween(1, Window.unboundedFollowing)
    best = best.select("class_id", "_chunk", F.coalesce(F.max("_m").over(later), F.lit(0.0)).alias("_later"))
    # Backwards, as a running maximum: a frame up to the end would be gone through anew for every row.
    rest = (
        Window.partitionBy("class_id", "_chunk")
        .orderBy(F.desc("position"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return points.join(best, ["class_id", "_chunk"]).select(
        "class_id", "position", "score", "tp", "recall", "precision",
        F.greatest(F.max("precision").over(rest), F.col("_later")).alias("envelope"),
    )


def per_class_metrics(evaluation: Evaluation, mapping: DataFrame) -> DataFrame:
    """Images, instances, P and R at the confidence with the best mean F1, AP50 and AP50-95."""
    buckets = 1000
    truth = evaluation.truth.groupBy("class_id", "image_id").agg(F.count("*").alias("_n")).groupBy("class_id").agg(
        F.count("*").alias("images"), F.sum("_n").alias("instances")
    )
    counted = evaluation.detections.groupBy(
        "class_id", F.least(F.floor(F.col("score") * buckets), F.lit(buckets - 1)).cast("int").alias("bucket")
    ).agg(F.count("*").alias("_dets"), F.sum(_bit("counted", 0)).alias("_tps"))
    grid = truth.select("class_id", "instances", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    above = Window.partitionBy("class_id").orderBy(F.desc("bucket"))
    levels = (
        grid.join(counted, ["class_id", "bucket"], "left")
        .select(
            "class_id", "bucket", "instances",
            F.sum(F.coalesce("_dets", F.lit(0))).over(above).alias("_d"),
            F.sum(F.coalesce("_tps", F.lit(0))).over(above).alias("_t"),
        )
        .withColumn("p", F.when(F.col("_d") > 0, F.col("_t") / F.col("_d")).otherwise(0.0))
        .withColumn("r", F.col("_t") / F.col("instances"))
        .withColumn("f1", F.when(F.col("_t") > 0, 2 * F.col("_t") / (F.col("_d") + F.col("instances"))).otherwise(0.0))
    )
    mean_f1 = levels.groupBy("bucket").agg(F.round(F.avg("f1"), 9).alias("_f1"))
    chosen = mean_f1.agg(F.max_by("bucket", F.struct("_f1", -F.col("bucket"))).alias("b")).select("b").scalar()
    at_best = levels.filter(F.col("bucket") == chosen).select("class_id", "p", "r")
    ap = evaluation.per_class.filter("area = 0").groupBy("class_id").agg(
        F.max(F.when(F.col("threshold") == 0, F.col("ap"))).alias("_ap50"), F.avg("ap").alias("_ap")
    )
    return (
        truth.join(at_best, "class_id")
        .join(ap, "class_id")
        .join(mapping.select("class_id", "name"), "class_id")
        .select(
            F.col("name").alias("class_name"), "images", "instances",
            F.round("p", 6).alias("precision"), F.round("r", 6).alias("recall"),
            F.round("_ap50", 6).alias("map50"), F.round("_ap", 6).alias("map50_95"),
        )
    )


def _log2_floor(value: Column) -> Column:
    return F.floor(F.log2(value)).cast("int")


def overlapping_boxes(left: DataFrame, right: DataFrame, key: str, min_iou: float) -> DataFrame:
    """Pairs of one ``key`` with IoU above ``min_iou``: columns ``l_*``, ``r_*`` and ``iou``.

    Keys with few boxes are joined directly.  A key with very many on either side is cut into cells whose
    size follows the box size: two boxes with such an IoU differ at most by 1/min_iou in
    width and height and their centres are close, so each right box looks up a few cells.
    """
    a = left.select(F.col(key), *[F.col(c).alias(f"l_{c}") for c in left.columns if c != key])
    b = right.select(F.col(key), *[F.col(c).alias(f"r_{c}") for c in right.columns if c != key])
    sides = left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).union(right.select(key, F.lit(0), F.lit(1)))
    hot = (
        sides.groupBy(key)
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        .filter((F.least("_l", "_r") > 0) & (F.greatest("_l", "_r") > HOT_GROUP_BOXES))
        .select(key, F.lit(True).alias("_hot"))
    )
    keys = [key]
    if not hot.isEmpty():
        hot = broadcast_checked(hot)
        slack = (1 - min_iou) / (2 * (1 + min_iou))
        a, b = a.join(hot, key, "left"), b.join(hot, key, "left")
        for axis, size in (("x", "w"), ("y", "h")):
            level, cell = f"_level_{axis}", f"_cell_{axis}"
            own = _log2_floor(F.col(f"l_{size}"))
            centre = F.col(f"l_{axis}") + F.col(f"l_{size}") / 2
            a = a.withColumn(level, F.when(F.col("_hot"), own).otherwise(0)).withColumn(
                cell, F.when(F.col("_hot"), F.floor(centre / F.pow(F.lit(2.0), own))).otherwise(0)
            )
            length = F.col(f"r_{size}")
            levels = F.sequence(_log2_floor(length * min_iou), _log2_floor(length / min_iou))
            b = b.withColumn(level, F.explode(F.when(F.col("_hot"), levels).otherwise(F.array(F.lit(0)))))
            side = F.pow(F.lit(2.0), F.col(level))
            middle = F.col(f"r_{axis}") + length / 2
            reach = (side * 2 + length) * slack
            cells = F.sequence(F.floor((middle - reach) / side), F.floor((middle + reach) / side))
            b = b.withColumn(
                cell, F.explode(F.when(F.col("_hot"), cells).otherwise(F.array(F.lit(0).cast("long"))))
            )
            keys += [level, cell]
        a, b = a.drop("_hot"), b.drop("_hot")
    overlap = boxes.iou(*[F.col(f"{side}_{c}") for side in "lr" for c in ("x", "y", "w", "h")])
    return a.join(b, keys).withColumn("iou", overlap).filter(F.col("iou") > min_iou)


def confusion_matrix(
    gt: DataFrame,
    detections: DataFrame,
    confidence: float = CONFUSION_CONFIDENCE,
    min_iou: float = CONFUSION_IOU,
) -> DataFrame:
    """True class by predicted class (-1 is background), counts and share of the true class.

    A detection takes its best overlapping box of any class; a box keeps its best detection.
    """
    truth = cut_lineage(gt.select("image_id", "gt_id", "class_id", "x", "y", "w", "h"))
    kept = cut_lineage(
        detections.filter(F.col("score") >= confidence).select(
            "image_id", "det_id", "class_id", "x", "y", "w", "h"
        )
    )
    pairs = overlapping_boxes(truth, kept, "image_id", min_iou)
    per_detection = pairs.groupBy("image_id", "r_det_id").agg(
        F.max_by(
            F.struct("l_gt_id", "l_class_id", "r_class_id", "iou"), F.struct("iou", -F.col("l_gt_id"))
        ).alias("m")
    )
    per_box = per_detection.groupBy("image_id", "m.l_gt_id").agg(
        F.max_by(F.struct("m.l_class_id", "m.r_class_id"), F.struct("m.iou", -F.col("r_det_id"))).alias("m")
    )
    matched = per_box.groupBy(
        F.col("m.l_class_id").alias("true_class"), F.col("m.r_class_id").alias("predicted_class")
    ).agg(F.count("*").alias("n"))
    background = F.lit(-1).cast("long")
    parts = [
        matched,
        truth.groupBy(F.col("class_id").alias("true_class"), background.alias("predicted_class")).agg(
            F.count("*").alias("n")
        ),
        matched.groupBy("true_class", background.alias("predicted_class")).agg((-F.sum("n")).alias("n")),
        kept.groupBy(background.alias("true_class"), F.col("class_id").alias("predicted_class")).agg(
            F.count("*").alias("n")
        ),
        matched.groupBy(background.alias("true_class"), "predicted_class").agg((-F.sum("n")).alias("n")),
    ]
    cells = parts[0]
    for part in parts[1:]:
        cells = cells.unionByName(part)
    cells = cells.groupBy("true_class", "predicted_class").agg(F.sum("n").alias("n")).filter("n > 0")
    share = F.col("n") / F.sum("n").over(Window.partitionBy("true_class"))
    return cells.withColumn("share", F.round(share, 6))


def score_histogram(detections: DataFrame, bands: int = 20) -> DataFrame:
    return detections.groupBy(
        "class_id", F.least(F.floor(F.col("score") * bands), F.lit(bands - 1)).cast("int").alias("band")
    ).agg(F.count("*").alias("detections"))
