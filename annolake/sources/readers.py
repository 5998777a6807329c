"""File sources as DataFrames.  Every reader gives Spark the schema, so nothing is inferred."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake import schemas
from annolake.session import stage
from annolake.sources.archives import archived_lines
from annolake.sources.documents import carried_on, json_elements, section_rows


class AnnotationTables(NamedTuple):
    images: DataFrame
    annotations: DataFrame
    categories: DataFrame


#: Where a document's path names its split: in its directory, or in the file itself.  From the front, as every element
#: is matched: a search would try each place of a long path.
DIRECTORY_SPLIT = r"(?s)^(?:.*/)?([^/]+)/[^/]*$"
FILE_SPLIT = r"(?s)^(?:.*/)?([^/]+)\.json$"


def read_coco(
    spark: SparkSession, path: str | Sequence[str], source_split: str | None = None, split_pattern: str = DIRECTORY_SPLIT
) -> AnnotationTables:
    """Nested annotation documents to three flat tables, every document read in byte ranges by many tasks.

    ``source_split=None`` takes the split from the file's path, by default from its directory.
    """
    split = F.lit(source_split) if source_split else F.regexp_extract("file", split_pattern, 1)
    elements = json_elements(spark, path).withColumn("source_split", split)
    images = section_rows(elements, "images", schemas.IMAGE, "source_split").withColumnRenamed("id", "image_id")
    annotations = section_rows(elements, "annotations", schemas.ANNOTATION, "source_split").select(
        "source_split",
        F.col("id").alias("annotation_id"),
        "image_id",
        "category_id",
        "bbox",
        *[
            F.when(F.size("bbox") == 4, F.get("bbox", F.lit(i))).alias(name)
            for i, name in enumerate(("x", "y", "w", "h"))
        ],
        "area",
        F.coalesce("iscrowd", F.lit(0)).alias("iscrowd"),
    )
    categories = section_rows(elements, "categories", schemas.CATEGORY).distinct().withColumnRenamed("id", "category_id")
    return AnnotationTables(images, annotations, categories)


def read_manifest(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Split manifest CSV; empty numbers become 0, the category column an array."""
    raw = spark.read.csv(path, schema=schemas.MANIFEST, header=True, escape='"')
    number = lambda c: F.coalesce(F.col(c).try_cast("int"), F.lit(0)).alias(c)
    return raw.select(
        "internal_record_id",
        "source_split",
        F.col("image_id").try_cast("long").alias("image_id"),
        "source_image_path",
        "project_image_path",
        "project_label_path",
        number("width"),
        number("height"),
        number("valid_object_count"),
        F.from_json(F.coalesce("category_names", F.lit("[]")), "array<string>").alias("category_names"),
    )


def read_manifest_jsonl(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.json(path, schema=schemas.RECORD, mode="FAILFAST")


def read_processed(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Processed manifests to (image records, categories), read in byte ranges; their category lists must agree."""
    elements = json_elements(spark, list(paths))
    listed = section_rows(elements, "categories", schemas.PROCESSED_CATEGORY, "file")
    documents = elements.select("file").distinct().count()
    # A category that not every document has, or has as often, is a difference.
    names = [c for c in listed.columns if c != "file"]
    per_file = listed.groupBy("file", *names).agg(F.count("*").alias("n"))
    uneven = per_file.groupBy(*names, "n").agg(F.count("*").alias("files")).filter(F.col("files") != documents)
    if not uneven.isEmpty():
        raise ValueError("Category mapping mismatch between processed manifests.")
    return section_rows(elements, "images", schemas.PROCESSED_IMAGE), listed.drop("file").distinct()


def read_image_list(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Image list text: trimmed non-empty lines with their stored order as ``(file, ord)``.

    ``ord`` grows in file order within a file; it is not dense.
    """
    lines = spark.read.text(path).select(
        F.trim("value").alias("path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    ordered = lines.withColumn("ord", F.struct("_block", "_id"))
    return ordered.filter(F.col("path") != "").select("file", "ord", "path")


def _path_below(found: Column, roots: str | Sequence[str]) -> Column:
    """A file's path without the root it was found under; whole if no root is a folder above it."""
    # The metadata column holds an encoded URI, in which a plus sign stands for itself.
    found = F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))
    for root in [roots] if isinstance(roots, str) else roots:
        plain = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", root).strip("/")
        found = F.regexp_replace(found, rf"^[A-Za-z][\w+.-]*:(?:.*?/)?{re.escape(plain)}/+", "")
    return found


def read_labels(spark: SparkSession, path: str | Sequence[str], archived: bool = False) -> DataFrame:
    """Label files to ``label_file, line_no, line``, files named by their path below ``path``, ``archived`` ones by
    their name in the archives (of ``lines_to_archives``) that lie there.

    A file may be read in several byte ranges: lines are numbered within their range and the lines of the file's
    earlier ranges are added.  A blank line counts; an empty file has no lines.
    """
    if archived:
        lines, name = archived_lines(read_files(spark, path)), F.col("file")
    else:
        lines = spark.read.text(path, recursiveFileLookup=True).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
            F.col("value").alias("line"),
        )
        name = _path_below(F.col("file"), path)
    numbered = carried_on(lines, {"before": F.lit(1).cast("long")})
    return numbered.select(name.alias("label_file"), (F.col("before") + 1).alias("line_no"), "line")


def read_predictions(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Detector output; image ids stay text because they come in two spellings.  A broken document is an error.

    Each document is one array, read in byte ranges by many tasks; without ``multi_line`` every line is one detection.
    """
    if multi_line:
        raw = section_rows(json_elements(spark, path, level=1), None, schemas.PREDICTION)
    else:
        raw = spark.read.json(path, schema=schemas.PREDICTION, mode="FAILFAST")
    return raw.select(
        "image_id",
        F.col("category_id").alias("class_id"),
        *[
            F.when(F.size("bbox") == 4, F.get("bbox", F.lit(i))).alias(name)
            for i, name in enumerate(("x", "y", "w", "h"))
        ],
        "score",
    )


def read_epochs(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Training results with padded headers and values, in epoch order; empty is an error."""
    schema = schemas.EPOCHS if columns is None else ", ".join(f"`{c}` double" for c in columns)
    rows = spark.read.csv(
        path, schema=schema, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )
    if rows.isEmpty():
        raise ValueError(f"No training rows found in {path}")
    return rows.orderBy("epoch")


def read_results(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Result documents; unknown fields are ignored, a broken file becomes ``_corrupt_record``."""
    return spark.read.json(path, schema=schemas.RESULT, multiLine=multi_line, mode="PERMISSIVE")


def read_files(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """Files with size and bytes; the bytes are only read when a query uses them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", F.col("length").alias("size_bytes"), "content")


def read_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Log text lines with their order."""
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
        ).alias("ord"),
    )


def file_digests(files: DataFrame) -> DataFrame:
    return files.select("path", "size_bytes", F.sha2("content", 256).alias("sha256"))


def ingest(tables: AnnotationTables) -> AnnotationTables:
    """Flat tables detached from the documents they came from."""
    return AnnotationTables(*[stage(frame, "ingested") for frame in tables])
