"""Category mapping, annotation classification and conversion, label linting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolake.constants import (
    ACCEPTED,
    EXCLUDED,
    LABEL_DIALECTS,
    REASON_BBOX,
    REASON_CATEGORY,
    REASON_CROWD,
    REASON_IMAGE,
    REASON_NO_BBOX,
    REJECTED,
)
from annolake.functions import boxes, names
from annolake.operators.ordered import with_rank
from annolake.session import broadcast_checked

# Up to this many categories the dense id is a plain window; beyond it a distributed rank.
SMALL_CATEGORY_TABLE = 10_000


def category_mapping(categories: DataFrame) -> DataFrame:
    """Add ``class_id``: the dense 0-based rank of ``category_id``."""
    if categories.limit(SMALL_CATEGORY_TABLE + 1).count() <= SMALL_CATEGORY_TABLE:
        rank = F.row_number().over(Window.orderBy("category_id"))
        return categories.withColumn("class_id", (rank - 1).cast("long"))
    ranked = with_rank(categories, [], ["category_id"], "_rank")
    return ranked.withColumn("class_id", F.col("_rank") - 1).drop("_rank")


def join_category_lookup(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Left join of ``category_id`` to name and dense class id."""
    lookup = mapping.select("category_id", F.col("name").alias("category_name"), "class_id")
    return rows.join(broadcast_checked(lookup), "category_id", "left")


def join_annotations_images(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """Image-driven inner join; annotations of unknown images drop out."""
    image_columns = ["source_split", "image_id", "file_name", "width", "height"]
    extra = [c for c in ("usable",) if c in images.columns]
    return annotations.join(images.select(*image_columns, *extra), ["source_split", "image_id"])


def _classified(joined: DataFrame, mapping: DataFrame) -> DataFrame:
    usable = (F.col("width") > 0) & (F.col("height") > 0)
    if "usable" in joined.columns:
        usable = usable & F.col("usable")
    xywh = [F.col(name) for name in ("x", "y", "w", "h")]
    missing = xywh[0].isNull() | xywh[1].isNull() | xywh[2].isNull() | xywh[3].isNull()
    clipped = boxes.clip_box(*xywh, F.col("width"), F.col("height"))
    crowd = F.coalesce(F.col("iscrowd"), F.lit(0)) != 0
    reason = (
        F.when(crowd, REASON_CROWD)
        .when(~usable, REASON_IMAGE)
        .when(F.col("class_id").isNull(), REASON_CATEGORY)
        .when(missing, REASON_NO_BBOX)
        .when(clipped.isNull(), REASON_BBOX)
        .otherwise("")
    )
    status = F.when(crowd, EXCLUDED).when(F.col("reason") == "", ACCEPTED).otherwise(REJECTED)
    kept = F.col("status") == ACCEPTED
    normal = boxes.normalise_box(F.col("clipped"), F.col("width"), F.col("height"))
    return (
        join_category_lookup(joined, mapping)
        .withColumn("reason", reason)
        .withColumn("status", status)
        .withColumn("clipped", F.when(kept, clipped))
        .withColumn("yolo", F.when(kept, normal))
    )


def classify_annotations(annotations: DataFrame, images: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row per annotation of a known image with status, reason, clipped and normalised box.

    The first matching reason wins: crowd, unusable image, unknown category, missing box,
    nothing left after clipping.
    """
    rows = _classified(join_annotations_images(annotations, images), mapping)
    return rows.withColumn(
        "internal_image_id", names.internal_image_id(F.col("source_split"), F.col("image_id"))
    ).withColumn(
        "internal_record_id",
        names.internal_annotation_id(F.col("source_split"), F.col("image_id"), F.col("annotation_id")),
    )


def convert_annotations(
    annotations: DataFrame,
    images: DataFrame,
    mapping: DataFrame,
    limit: int | None = None,
) -> DataFrame:
    """Simpler conversion: ``outcome`` is written, crowd, unsupported or invalid box.

    ``limit`` keeps the first images by id, as a caller's own choice.
    """
    if limit is not None:
        images = images.orderBy("source_split", "image_id").limit(limit)
    joined = join_annotations_images(annotations, images)
    result = boxes.to_yolo(
        *[F.col(name) for name in ("x", "y", "w", "h")], F.col("width"), F.col("height")
    )
    no_box = F.col("x").isNull() | F.col("y").isNull() | F.col("w").isNull() | F.col("h").isNull()
    outcome = (
        F.when(F.coalesce(F.col("iscrowd"), F.lit(0)) != 0, "crowd_annotations_skipped")
        .when(no_box | F.col("class_id").isNull(), "unsupported_annotations")
        .when(F.col("_yolo.reason").isNotNull(), "invalid_boxes")
        .otherwise("annotations_written")
    )
    return (
        join_category_lookup(joined, mapping)
        .withColumn("_yolo", result)
        .withColumn("outcome", outcome)
        .withColumn("yolo", F.when(F.col("outcome") == "annotations_written", F.col("_yolo.box")))
        .drop("_yolo")
    )


def image_outcomes(images: DataFrame, files: DataFrame, path: Column) -> DataFrame:
    """Images with ``image_outcome``: written, missing (no file at ``path``) or corrupt (a file that is not readable).

    ``files``: path, readable; a path that is listed several times is readable if one of its entries is.
    """
    known = files.groupBy(F.col("path").alias("_path")).agg(F.max(F.coalesce("readable", F.lit(False))).alias("_readable"))
    outcome = F.when(F.col("_readable").isNull(), "missing_images").when(~F.col("_readable"), "corrupt_images").otherwise("images_written")
    return images.withColumn("_path", path).join(known, "_path", "left").withColumn("image_outcome", outcome).drop("_path", "_readable")


CONVERSION_COUNTERS = [
    "images_seen", "images_written", "missing_images", "corrupt_images", "annotations_seen", "annotations_written",
    "invalid_boxes", "unsupported_annotations", "crowd_annotations_skipped",
]


def conversion_report(annotations: DataFrame, images: DataFrame, mapping: DataFrame, files: DataFrame, path: Column) -> DataFrame:
    """One row per source split: what a conversion saw, wrote and left out.

    Only annotations of images that are written get an outcome; ``annotations_seen`` counts all of the split,
    also those whose image is missing, corrupt or unknown.
    """
    split = "source_split"
    checked = image_outcomes(images, files, path)
    seen = checked.groupBy(split, F.col("image_outcome").alias("counter")).agg(F.count("*").alias("n"))
    written = checked.filter("image_outcome = 'images_written'").drop("image_outcome")
    outcomes = convert_annotations(annotations, written, mapping).groupBy(split, F.col("outcome").alias("counter")).agg(F.count("*").alias("n"))
    every = [
        images.groupBy(split).agg(F.lit("images_seen").alias("counter"), F.count("*").alias("n")),
        annotations.groupBy(split).agg(F.lit("annotations_seen").alias("counter"), F.count("*").alias("n")),
    ]
    # A few rows per split from here on.
    rows = seen.union(outcomes).union(every[0]).union(every[1])
    return rows.groupBy(split).agg(
        *[F.coalesce(F.sum(F.when(F.col("counter") == c, F.col("n"))), F.lit(0)).alias(c) for c in CONVERSION_COUNTERS]
    )


def usable_images(images: DataFrame, files: DataFrame | None = None, path: Column | None = None) -> DataFrame:
    """Images with positive dimensions whose file exists."""
    kept = images.filter((F.col("width") > 0) & (F.col("height") > 0))
    if files is None:
        return kept
    return (
        kept.withColumn("path", path)
        .join(files.select("path"), "path", "left_semi")
        .select(*images.columns)
    )


def image_rollup(classified: DataFrame, images: DataFrame) -> DataFrame:
    """Per image: accepted objects, sorted distinct categories, crowd flag, usability.

    The sets are bounded by the category table, so they are safe for a very large image.
    """
    kept = F.col("status") == ACCEPTED
    per_image = classified.groupBy("source_split", "image_id").agg(
        F.count_if(kept).alias("valid_object_count"),
        F.sort_array(F.collect_set(F.when(kept, F.struct("category_id", "category_name")))).alias("_categories"),
        F.bool_or(F.col("status") == EXCLUDED).alias("has_crowd_annotations"),
    )
    return images.join(per_image, ["source_split", "image_id"], "left").select(
        names.internal_image_id(F.col("source_split"), F.col("image_id")).alias("internal_record_id"),
        "source_split",
        "image_id",
        "file_name",
        "width",
        "height",
        F.coalesce("valid_object_count", F.lit(0)).alias("valid_object_count"),
        F.coalesce("_categories.category_id", F.array().cast("array<bigint>")).alias("category_ids"),
        F.coalesce(F.sort_array(F.array_distinct("_categories.category_name")), F.array().cast("array<string>")).alias(
            "category_names"
        ),
        F.coalesce("has_crowd_annotations", F.lit(False)).alias("has_crowd_annotations"),
        ((F.col("width") > 0) & (F.col("height") > 0)).alias("usable_for_training"),
    )


def lint_label_lines(lines: DataFrame, dialect: str = "processed") -> DataFrame:
    """One row per defect of a label line: ``label_file, line_no, error``."""
    upper, blank_is_error, float_class = LABEL_DIALECTS[dialect]
    text = F.trim(F.regexp_replace(F.col("line"), r"\s+", " "))
    parts = F.split(text, " ")
    class_text = F.get(parts, F.lit(0))
    class_id = (
        class_text.try_cast("double").try_cast("long")
        if float_class
        else F.when(class_text.rlike(r"^[+-]?[0-9]+$"), class_text.try_cast("long"))
    )
    values = [F.get(parts, F.lit(i)).try_cast("double") for i in range(1, 5)]
    parsed = lines.select(
        "label_file",
        "line_no",
        (text == "").alias("blank"),
        F.when(text == "", F.lit(0)).otherwise(F.size(parts)).alias("fields"),
        class_id.alias("class_id"),
        *[value.alias(f"v{i}") for i, value in enumerate(values)],
    )
    if not blank_is_error:
        parsed = parsed.filter(~F.col("blank"))
    numeric = F.col("class_id").isNotNull()
    in_range = F.lit(True)
    for i in range(4):
        numeric = numeric & F.col(f"v{i}").isNotNull()
        in_range = in_range & F.col(f"v{i}").between(0.0, 1.0)
    bad_class = F.col("class_id") < 0
    if upper is not None:
        bad_class = bad_class | (F.col("class_id") > upper)
    shaped = F.col("fields") == 5
    errors = F.array(
        F.when(~shaped, "field_count"),
        F.when(shaped & ~numeric, "non_numeric"),
        F.when(shaped & numeric & bad_class, "class_out_of_range"),
        F.when(shaped & numeric & ~in_range, "value_out_of_range"),
        F.when(shaped & numeric & ((F.col("v2") <= 0) | (F.col("v3") <= 0)), "non_positive_size"),
    )
    return parsed.select("label_file", "line_no", F.explode(F.array_compact(errors)).alias("error"))


def parse_label_lines(lines: DataFrame) -> DataFrame:
    """Label text to typed columns; fields that do not parse are null."""
    parts = F.split(F.trim(F.regexp_replace(F.col("line"), r"\s+", " ")), " ")
    return lines.select(
        *[c for c in lines.columns if c != "line"],
        F.get(parts, F.lit(0)).try_cast("double").try_cast("long").alias("class_id"),
        *[F.get(parts, F.lit(i + 1)).try_cast("double").alias(n) for i, n in enumerate(("xc", "yc", "w", "h"))],
    )


def lint_coco_subset(
    images: DataFrame,
    annotations: DataFrame,
    categories: DataFrame,
    expected_images: int | None = None,
    expected_categories: int | None = None,
) -> DataFrame:
    """Constraint violations of a document as ``(rule, key)`` rows."""
    image_key = F.concat_ws(":", "source_split", F.col("image_id").cast("string")).alias("key")
    annotation_key = F.col("annotation_id").cast("string").alias("key")
    found = [
        images.filter((F.col("width") <= 0) | (F.col("height") <= 0)).select(
            F.lit("non_positive_dimensions").alias("rule"), image_key
        ),
        duplicated(images, ["source_split", "image_id"]).select(
            F.lit("duplicate_image_id").alias("rule"), image_key
        ),
        duplicated(annotations, ["annotation_id"]).select(
            F.lit("duplicate_annotation_id").alias("rule"), annotation_key
        ),
    ]
    # One pass over the annotations for all row rules; both references are left joins.
    # A repeated image id counts with its smallest size, in every run.
    known = (
        images.groupBy("source_split", "image_id")
        .agg(F.min(F.struct("width", "height")).alias("_size"))
        .select("source_split", "image_id", "_size.width", "_size.height")
    )
    known_categories = categories.select("category_id", F.lit(True).alias("_category"))
    checked = annotations.join(known, ["source_split", "image_id"], "left").join(
        broadcast_checked(known_categories), "category_id", "left"
    )
    shaped = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("w").isNotNull() & F.col("h").isNotNull()
    sized = (F.col("width") > 0) & (F.col("height") > 0)
    beyond = (F.col("x") + F.col("w") > F.col("width") + 1e-6) | (F.col("y") + F.col("h") > F.col("height") + 1e-6)
    rules = F.array(
        F.when(F.col("width").isNull(), "missing_image"),
        F.when(F.col("_category").isNull(), "missing_category"),
        F.when(~shaped, "invalid_bbox_shape"),
        F.when(shaped & ((F.col("x") < 0) | (F.col("y") < 0)), "negative_coordinate"),
        F.when(shaped & ((F.col("w") <= 0) | (F.col("h") <= 0)), "non_positive_size"),
        F.when(shaped & sized & beyond, "exceeds_image"),
    )
    found.append(checked.select(F.explode(F.array_compact(rules)).alias("rule"), annotation_key))
    for rule, frame, expected in (
        ("image_count", images, expected_images),
        ("category_count", categories, expected_categories),
    ):
        if expected is not None:
            found.append(
                frame.agg(F.count("*").alias("n"))
                .filter(F.col("n") != expected)
                .select(F.lit(rule).alias("rule"), F.col("n").cast("string").alias("key"))
            )
    result = found[0]
    for frame in found[1:]:
        result = result.unionByName(frame)
    return result


def duplicated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")
