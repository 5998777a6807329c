"""Training runs, logs, per-frame results, latency and stored result documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolake.constants import EPOCH_METRICS
from annolake.functions import names
from annolake.operators.ordered import value_distribution, with_lookback, with_rank
from annolake.session import broadcast_checked

MOVING_WINDOW = 20


def best_epoch(
    epochs: DataFrame, metrics: Sequence[tuple[str, str, str]] = tuple(EPOCH_METRICS), epoch: str = "epoch"
) -> DataFrame:
    """Per metric: final value, best value and the earliest epoch that reached it."""
    long = epochs.select(
        F.col(epoch).cast("long").alias("epoch"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("metric"),
                        F.lit(direction).alias("direction"),
                        F.col(f"`{column}`").cast("double").alias("value"),
                    )
                    for label, column, direction in metrics
                ]
            )
        ),
    )
    signed = F.when(F.col("direction") == "max", -F.col("value")).otherwise(F.col("value"))
    best = F.min_by(F.struct("value", "epoch"), F.struct(signed, F.col("epoch")))
    return (
        long.groupBy("metric", "direction")
        .agg(best.alias("_best"), F.max_by("value", "epoch").alias("final"), F.max("epoch").alias("final_epoch"))
        .select(
            "metric", "direction", "final", "final_epoch",
            F.col("_best.value").alias("best"), F.col("_best.epoch").alias("best_epoch"),
        )
    )


def completed_note(epochs: DataFrame, configured: int | None) -> DataFrame:
    n = F.count("*").cast("string")
    short = F.concat(n, F.lit(" epochs completed."))
    if configured is not None:
        differs = F.concat(n, F.lit(f" epochs completed although {configured} were configured."))
        short = F.when(F.count("*") != configured, differs).otherwise(short)
    return epochs.agg(F.count("*").alias("total_completed_epochs"), short.alias("completed_epochs_note"))


def last_epoch_metrics(epochs: DataFrame, groups: dict[str, dict[str, str]], epoch: str = "epoch") -> DataFrame:
    """Row of the last epoch with its columns gathered in named structs."""
    packed = F.struct(
        *[
            F.struct(*[F.col(f"`{column}`").alias(name) for name, column in members.items()]).alias(group)
            for group, members in groups.items()
        ]
    )
    return epochs.agg(F.max(epoch).alias("epoch"), F.max_by(packed, epoch).alias("_last")).select("epoch", "_last.*")


def parse_eval_log(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Evaluation log text to (metric rows, speed rows).

    A metric row is any line whose last six tokens are two integers and four numbers; the
    tokens before them are the class name.
    """
    # Fixed value: the speed line of the log.
    speed = r"Speed:\s*([0-9.]+)ms pre-process,\s*([0-9.]+)ms inference,\s*([0-9.]+)ms NMS"
    text = lines.select(F.trim(F.regexp_replace("line", r"\s+", " ")).alias("line"))
    parts = F.split("line", " ")
    last = [F.try_element_at(parts, F.lit(i)) for i in range(-6, 0)]
    name = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 6), " ")
    columns = ["images", "instances", "precision", "recall", "map50", "map50_95"]
    kept = text.filter(
        (F.col("line") != "")
        & ~F.col("line").startswith("Class ")
        & ~F.col("line").rlike(speed)
        & (F.size(parts) >= 7)
    )
    rows = kept.select(
        name.alias("class_name"),
        *[
            last[i].try_cast("long" if i < 2 else "double").alias(column)
            for i, column in enumerate(columns)
        ],
    ).dropna(subset=columns)
    rows = rows.filter(~F.col("class_name").isin("", "Class"))
    stages = ["preprocess_ms", "inference_ms", "nms_ms"]
    speeds = text.filter(F.col("line").rlike(speed)).select(
        *[F.regexp_extract("line", speed, i + 1).try_cast("double").alias(c) for i, c in enumerate(stages)]
    )
    return rows, speeds


# What a training log shows when a step ran (all texts of one list must occur).
LOG_EVIDENCE = {
    "pretrained_weights_loaded": [["Transferred ", "items from"]],
    "model_architecture_initialized": [["Model summary:"], ["YOLOv5s summary:"]],
    "training_images_discovered": [["train: ", "32 images"]],
    "validation_images_discovered": [["val: ", "16 images"]],
    "box_loss_executed": [["box_loss"]],
    "objectness_loss_executed": [["obj_loss"]],
    "classification_loss_executed": [["cls_loss"]],
    "optimizer_configured": [["optimizer:", "SGD"]],
    "validation_completed": [["Validating "], ["Class     Images"]],
    "checkpoint_logged": [["Optimizer stripped from", "last.pt"]],
}
LOG_WARNING = r"warning|deprecated"


def training_log_checks(lines: DataFrame) -> DataFrame:
    """One row of evidence flags and the number of lines."""
    wanted = sorted({text for options in LOG_EVIDENCE.values() for group in options for text in group})
    seen = {text: F.coalesce(F.bool_or(F.col("line").contains(text)), F.lit(False)) for text in wanted}
    flags = []
    for check, options in LOG_EVIDENCE.items():
        any_of = F.lit(False)
        for group in options:
            all_of = F.lit(True)
            for text in group:
                all_of = all_of & seen[text]
            any_of = any_of | all_of
        flags.append(any_of.alias(check))
    return lines.agg(*flags, F.count("*").alias("line_count"))


def training_log_warnings(lines: DataFrame, order: str, limit: int = 100) -> DataFrame:
    """First warning or deprecation lines of a log."""
    return lines.filter(F.lower("line").rlike(LOG_WARNING)).orderBy(order).limit(limit)


def frame_fps(frames: DataFrame) -> DataFrame:
    """Instantaneous and 20-frame moving frame rate per source, in frame order.

    The first frame of a source has rate 0 and does not enter the moving average.
    """
    ranked = with_rank(frames, ["source_id"], ["frame_ts", "event_id"], "nth")
    seconds = F.unix_micros(F.col("frame_ts").cast("timestamp"))
    timed = ranked.withColumn("_us", seconds)

    def gap(window) -> Column:
        return (F.col("_us") - F.lag("_us").over(window)) / 1e6

    paced = with_lookback(
        timed,
        ["source_id"],
        "nth",
        MOVING_WINDOW + 1,
        {
            "_gap": gap,
            "_rate": lambda _: F.when(F.col("nth") > 1, F.when(F.col("_gap") > 0, 1.0 / F.col("_gap")).otherwise(0.0)),
            "_moving": lambda window: F.avg("_rate").over(window.rowsBetween(1 - MOVING_WINDOW, 0)),
        },
    )
    return paced.select(
        *frames.columns,
        (F.col("nth") - 1).alias("frame_index"),
        F.coalesce("_rate", F.lit(0.0)).alias("instantaneous_fps"),
        F.coalesce("_moving", F.lit(0.0)).alias("moving_average_fps"),
    )


def latency_benchmark(frames: DataFrame, warmup: int, stages: Sequence[str] = ()) -> DataFrame:
    """Per source, after ``warmup`` frames: latency mean, median, extremes, mean rate, stage means."""
    ranked = with_rank(frames, ["source_id"], ["frame_ts", "event_id"], "_nth")
    measured = ranked.filter(F.col("_nth") > warmup)
    rate = F.when(F.col("inference_ms") > 0, 1000.0 / F.col("inference_ms"))
    summary = measured.groupBy("source_id").agg(
        F.count("*").alias("num_images"),
        F.avg("inference_ms").alias("latency_ms_mean"),
        F.min("inference_ms").alias("latency_ms_min"),
        F.max("inference_ms").alias("latency_ms_max"),
        F.coalesce(F.avg(rate), F.lit(0.0)).alias("fps_mean"),
        *[F.avg(stage).alias(f"{stage}_mean") for stage in stages],
    )
    median = value_distribution(measured, ["source_id"], "inference_ms")
    return summary.join(median.select("source_id", F.col("median").alias("latency_ms_median")), "source_id", "left")


def class_counts_text(pairs: Column) -> Column:
    """``name:count`` items in name order."""
    return F.array_join(
        F.transform(F.sort_array(pairs), lambda p: F.concat_ws(":", p["name"], p["n"].cast("string"))), ","
    )


def detection_class_counts(detections: DataFrame, result: str, class_name: str = "class_name", weight: Column | None = None) -> DataFrame:
    """Per result a sorted map of class to count.

    Counted per (result, class) first, so a large result shrinks to its class list.
    """
    amount = F.sum(weight) if weight is not None else F.count("*")
    counted = detections.groupBy(result, F.col(class_name).alias("_name")).agg(amount.alias("_n"))
    return counted.groupBy(result).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("_name", "_n")))).alias("class_counts")
    )


def confidence_stats(results: DataFrame, detections: DataFrame, result: str) -> DataFrame:
    """Per result min, max and mean confidence; nulls when it has no detection."""
    stats = detections.groupBy(result).agg(
        F.count("*").alias("detection_count"),
        F.min("confidence").alias("min"),
        F.max("confidence").alias("max"),
        F.avg("confidence").alias("mean"),
    )
    return results.select(result).join(stats, result, "left").fillna(0, ["detection_count"])


def sample_summary(images: DataFrame, detections: DataFrame, result: str, timings: DataFrame | None = None) -> DataFrame:
    """Per image: dimensions, detections, class counts, confidence statistics and, from ``timings``, the time it took.

    An image without detections has none of the statistics; one without a timing a null time.
    """
    # One pass over the detections: counts per class carry the statistics of their image.
    per_class = detections.groupBy(result, F.col("class_name").alias("_name")).agg(
        F.count("*").alias("_n"), F.min("confidence").alias("_min"), F.max("confidence").alias("_max"),
        F.sum("confidence").alias("_sum"), F.count("confidence").alias("_known"),
    )
    per_image = per_class.groupBy(result).agg(
        F.sum("_n").alias("detection_count"),
        F.min("_min").alias("min"),
        F.max("_max").alias("max"),
        F.try_divide(F.sum("_sum"), F.sum("_known")).alias("mean"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("_name", "_n")))).alias("class_counts"),
    )
    stats = images.select(result).join(per_image, result, "left").fillna(0, ["detection_count"])
    found = images.join(stats, result)
    return found if timings is None else found.join(timings.select(result, "inference_time_ms"), result, "left")


def video_summary(frames: DataFrame) -> DataFrame:
    """Per source: processed frames, detections, class totals, averages, processing rate."""
    totals = frames.groupBy("source_id").agg(
        F.count("*").alias("processed_frames"),
        F.sum("detection_count").alias("total_detections"),
        F.avg("detection_count").alias("average_detections_per_frame"),
        F.avg("inference_ms").alias("average_inference_time_ms"),
        F.when(F.sum("inference_ms") > 0, F.count("*") / (F.sum("inference_ms") / 1000.0))
        .otherwise(0.0)
        .alias("average_processing_fps"),
    )
    counts = detection_class_counts(
        frames.filter("detection_count > 0"), "source_id", weight=F.col("detection_count")
    )
    return totals.join(counts, "source_id", "left")


def detections_explode(results: DataFrame, class_names: DataFrame) -> DataFrame:
    """Nested detections to rows; an unknown class id is named by its number.

    ``results``: result, detections array<struct<class_id, confidence, x1, y1, x2, y2>>.
    """
    flat = results.select(*[c for c in results.columns if c != "detections"], F.inline("detections"))
    lookup = class_names.select("class_id", F.col("name").alias("_name"))
    return (
        flat.join(broadcast_checked(lookup), "class_id", "left")
        .withColumn("class_name", F.coalesce("_name", F.col("class_id").cast("string")))
        .drop("_name")
    )


def resolve_class_filter(entries: DataFrame, mapping: DataFrame, strict: bool = False) -> DataFrame:
    """Filter entries (ids, digit strings or names in any case) to class ids.

    Unknown entries keep a null ``class_id``; with ``strict`` they are an error.
    """
    text = F.trim("entry")
    lookup = mapping.groupBy(F.lower("name").alias("_name")).agg(F.max("class_id").alias("_id"))
    resolved = entries.withColumn("_text", text).join(
        broadcast_checked(lookup), F.lower("_text") == F.col("_name"), "left"
    )
    resolved = resolved.select(
        *entries.columns,
        F.when(F.col("_text").rlike("^[0-9]+$"), F.col("_text").try_cast("long"))
        .otherwise(F.col("_id"))
        .alias("class_id"),
    )
    if strict and not resolved.filter("class_id is null").isEmpty():
        raise ValueError("Unknown class filter entries for this model.")
    return resolved


def filter_by_class(detections: DataFrame, allowed: DataFrame | None) -> DataFrame:
    """Detections of allowed classes; no filter keeps all."""
    if allowed is None:
        return detections
    return detections.join(broadcast_checked(allowed.select("class_id").distinct()), "class_id", "left_semi")


def filter_confidence(detections: DataFrame, threshold: float, column: str = "score") -> DataFrame:
    if not 0.0 <= threshold <= 1.0:
        raise ValueError("Confidence threshold must be between 0 and 1.")
    return detections.filter(F.col(column) >= threshold)


def latest_result(results: DataFrame, key: str = "result_id", written: Sequence[str] = ("written_at",)) -> DataFrame:
    """Newest document per result id; partial maxima make repeated writes cheap to shuffle."""
    others = [c for c in results.columns if c != key]
    newest = F.max_by(F.struct(*others), F.struct(*written))
    return results.groupBy(key).agg(newest.alias("_doc")).select(key, "_doc.*")


def strongest_classes(metrics: DataFrame, n: int = 5, column: str = "map50_95") -> DataFrame:
    return metrics.orderBy(F.desc(column), "class_name").limit(n)


def weakest_classes(metrics: DataFrame, n: int = 5, column: str = "map50_95") -> DataFrame:
    return metrics.orderBy(F.asc(column), "class_name").limit(n)


def metrics_comparison(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two (metric, value) tables side by side."""
    a = left.select("metric", F.col("value").alias("label_value"))
    b = right.select("metric", F.col("value").alias("coco_value"))
    return a.join(b, "metric", "full").withColumn("difference", F.col("label_value") - F.col("coco_value"))


def archive_audit(entries: DataFrame) -> DataFrame:
    """One row: entries, bytes, entries with each defect, and whether the archive is valid."""
    flagged = entries.select("size_bytes", names.archive_entry_flags(F.col("path")).alias("f"))
    kinds = ["absolute_path", "path_traversal", "prohibited", "model_file", "dataset_media"]
    counted = flagged.agg(
        F.count("*").alias("file_count"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"),
        *[F.count_if(F.col(f"f.{kind}")).alias(f"{kind}_errors") for kind in kinds],
    )
    errors = sum((F.col(f"{kind}_errors") for kind in kinds), F.lit(0))
    return counted.withColumn("valid", errors == 0)
