"""Reconciliation joins: references against files, manifests against sources, labels against boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolake.constants import ACCEPTED, ROBUSTNESS_CASES
from annolake.functions import boxes, names
from annolake.operators.annotate import join_category_lookup
from annolake.operators.ordered import with_usual_rank
from annolake.session import stage


def missing(references: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """References that no file backs (every copy of a repeated reference)."""
    return references.join(files.select(F.col("path").alias(path)), path, "left_anti")


def preview_n(rows: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows by key, for a report."""
    return rows.orderBy(key).limit(n)


def manifest_availability(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """One row: manifest rows, present images and labels, usable pairs, instances.

    ``manifest``: image_path, label_path, valid_object_count.
    """
    present = files.select("path", F.lit(True).alias("_there")).distinct()
    images = present.select(F.col("path").alias("image_path"), F.col("_there").alias("_image"))
    labels = present.select(F.col("path").alias("label_path"), F.col("_there").alias("_label"))
    image_ok = F.coalesce("_image", F.lit(False))
    label_ok = F.coalesce("_label", F.lit(False))
    return (
        manifest.join(images, "image_path", "left")
        .join(labels, "label_path", "left")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(image_ok).alias("image_exists"),
            F.count_if(label_ok).alias("label_exists"),
            F.count_if(image_ok & label_ok).alias("usable_image_label_pairs"),
            F.coalesce(F.sum("valid_object_count"), F.lit(0)).alias("instances"),
        )
    )


def reconstruct_split(
    manifest: DataFrame, images: DataFrame, annotations: DataFrame, mapping: DataFrame, strict: bool = False
) -> DataFrame:
    """Per split and counter: rebuild labels from a manifest and the source annotations.

    ``manifest``: split, source_split, image_id.  ``strict`` fails on an image without
    source metadata; otherwise such rows are counted as ``missing_images``.
    """
    keys = ["source_split", "image_id"]
    source = images.select(*keys, "width", "height")
    found = manifest.select("split", *keys).join(source, keys, "left")
    if strict:
        lost = found.filter("width is null").limit(1).count()
        if lost:
            raise ValueError("Missing image metadata for a manifest row.")
    clipped = boxes.clip_box(*[F.col(c) for c in ("x", "y", "w", "h")], F.col("width"), F.col("height"))
    counter = (
        F.when(F.coalesce(F.col("iscrowd"), F.lit(0)) != 0, "excluded_crowd_annotations")
        .when(F.col("class_id").isNull(), "rejected_annotations")
        .when(clipped.isNull(), "rejected_invalid_boxes")
        .otherwise("accepted_annotations")
    )
    joined = found.filter("width is not null").join(
        annotations.select(*keys, "category_id", "iscrowd", "x", "y", "w", "h"), keys
    )
    by_annotation = join_category_lookup(joined, mapping).groupBy("split", counter.alias("counter")).agg(
        F.count("*").alias("value")
    )
    by_image = found.groupBy("split").agg(
        F.count("*").alias("image_count"), F.count_if(F.col("width").isNull()).alias("missing_images")
    )
    by_image = by_image.unpivot("split", ["image_count", "missing_images"], "counter", "value")
    return by_annotation.unionByName(by_image)


def reconstruct_totals(counters: DataFrame, mapping: DataFrame) -> DataFrame:
    """Counters of all splits summed, plus the class count."""
    totals = counters.groupBy("counter").agg(F.sum("value").alias("value"))
    classes = mapping.agg(F.lit("class_count").alias("counter"), F.count("*").alias("value"))
    return totals.unionByName(classes.select("counter", "value"))


def subset_manifest(selected: DataFrame, label_counts: DataFrame) -> DataFrame:
    """Selected records with the line and class counts of their label file."""
    return selected.join(label_counts, "label_file", "left").fillna(0, ["label_lines", "classes"])


def subset_totals(selected: DataFrame, lines: DataFrame, class_names: DataFrame) -> DataFrame:
    """Per split and for the whole subset (``split`` null): images, annotations and the classes they represent.

    ``selected``: split, label_file.  ``lines``: label_file, class_id of every label line.  ``class_names``: class_id,
    name; a class without a name is named by its number.  Classes are counted per split first, so
    what is listed in the end is bounded by the classes.
    """
    per_class = (
        selected.select("split", "label_file")
        .join(lines.select("label_file", "class_id"), "label_file")
        .groupBy("split", "class_id")
        .agg(F.count("*").alias("n"))
    )
    item = F.when(F.col("class_id").isNotNull(), F.struct("class_id", F.coalesce("name", F.col("class_id").cast("string")).alias("class_name")))
    named = per_class.join(class_names.select("class_id", "name"), "class_id", "left").select("split", "n", item.alias("item"))
    counted = named.groupingSets([["split"], []], "split").agg(
        F.grouping("split").alias("_all"), F.sum("n").alias("annotations"), F.array_sort(F.collect_set("item")).alias("represented_classes")
    )
    images = selected.groupingSets([["split"], []], "split").agg(F.grouping("split").alias("_all"), F.count("*").alias("images"))
    same = (F.col("i._all") == F.col("c._all")) & F.col("i.split").eqNullSafe(F.col("c.split"))
    return images.alias("i").join(counted.alias("c"), same, "left").select(
        "i.split", "images", F.coalesce("annotations", F.lit(0)).alias("annotations"),
        F.coalesce(F.size("represented_classes"), F.lit(0)).alias("represented_class_count"), "represented_classes",
    )


def label_lines_from(classified: DataFrame) -> DataFrame:
    """Expected label rows: accepted boxes of an image in annotation order, ``pos`` from 1."""
    kept = classified.filter(F.col("status") == ACCEPTED).select(
        "source_split",
        "image_id",
        "annotation_id",
        "class_id",
        F.col("yolo.xc").alias("xc"),
        F.col("yolo.yc").alias("yc"),
        F.col("yolo.w").alias("w"),
        F.col("yolo.h").alias("h"),
    )
    # Copies of an id are ordered by their values, so ties are equal rows.
    keys, order = ["source_split", "image_id"], ["annotation_id", "class_id", "xc", "yc", "w", "h"]
    return with_usual_rank(stage(kept, "label-boxes"), keys, order, "pos")


def label_text(row: DataFrame, digits: int = 8) -> DataFrame:
    """Add the label line text with a fixed number of decimals."""
    number = f"%.{digits}f"
    return row.withColumn(
        "line",
        F.format_string(
            f"%d {number} {number} {number} {number}",
            F.col("class_id").cast("int"),
            *[F.col(c).cast("double") for c in ("xc", "yc", "w", "h")],
        ),
    )


def label_roundtrip(written: DataFrame, expected: DataFrame, tolerance: float = 5e-7) -> DataFrame:
    """Compare label rows with expected boxes position by position.

    Both sides: source_split, image_id, pos, class_id, xc, yc, w, h.  One row: compared,
    missing on either side, and positions that differ.
    """
    keys = ["source_split", "image_id", "pos"]
    values = ["class_id", "xc", "yc", "w", "h"]
    left = written.select(*keys, *[F.col(c).alias(f"a_{c}") for c in values])
    right = expected.select(*keys, *[F.col(c).alias(f"b_{c}") for c in values])
    differs = F.col("a_class_id") != F.col("b_class_id")
    for c in values[1:]:
        differs = differs | (F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) > tolerance)
    return left.join(right, keys, "full").agg(
        F.count("*").alias("positions"),
        F.count_if(F.col("a_class_id").isNull()).alias("missing_lines"),
        F.count_if(F.col("b_class_id").isNull()).alias("extra_lines"),
        F.count_if(F.coalesce(differs, F.lit(False))).alias("mismatches"),
    )


def robustness_grid(images: DataFrame, output_dir: str, seed: int) -> DataFrame:
    """One row per image and variant; the occlusion box is drawn from a seeded hash."""
    file_name = names.basename(F.col("path"))

    def draw(label: str, low: Column, high: Column) -> Column:
        text = F.concat(F.lit(f"{seed}:{label}:"), F.col("path"))
        number = F.conv(F.left(F.md5(text.cast("binary")), F.lit(8)), 16, 10).cast("long")
        return low + F.pmod(number, high - low + 1)

    half_w, half_h = F.floor(F.col("width") / 2), F.floor(F.col("height") / 2)
    zero = F.lit(0).cast("long")
    corners = {
        "x1": draw("x1", zero, half_w),
        "y1": draw("y1", zero, half_h),
        "x2": draw("x2", half_w, F.col("width").cast("long")),
        "y2": draw("y2", half_h, F.col("height").cast("long")),
    }
    cases = images.withColumn("case", F.explode(F.array(*[F.lit(c) for c in ROBUSTNESS_CASES])))
    return cases.select(
        "case",
        F.col("path").alias("source"),
        F.concat(F.lit(f"{output_dir}/"), F.col("case"), F.lit("/"), file_name).alias("output"),
        *[F.when(F.col("case") == "occlusion", value).alias(f"occlusion_{name}") for name, value in corners.items()],
    )
