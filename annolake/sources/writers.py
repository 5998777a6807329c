"""Sinks: manifests, label text, image lists, annotation documents, predictions, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.constants import MANIFEST_COLUMNS
from annolake.operators.joins import label_lines_from, label_text
from annolake.operators.ordered import with_rank
from annolake.operators.runs import latest_result
from annolake.session import broadcast_checked, cut_lineage, forget_shuffles, stage
from annolake.sources.documents import write_json_documents


def write_manifest_csv(manifest: DataFrame, path: str) -> None:
    """Split manifest as CSV below ``split=...``; arrays become JSON text."""
    flat = manifest.withColumn("category_names", F.to_json("category_names"))
    flat.select(*MANIFEST_COLUMNS, "split").write.partitionBy("split").csv(path, header=True, escape='"')


def write_annotation_manifest(classified: DataFrame, path: str) -> None:
    classified.write.partitionBy("status").parquet(path)


def label_table(classified: DataFrame, images: DataFrame, digits: int = 8) -> DataFrame:
    """Label text rows ``label_file, line_no, line``; an image without labels has one null line.

    One row per line: a label file of any length is spread over many tasks.
    """
    lines = label_text(label_lines_from(classified), digits)
    keys = ["source_split", "image_id"]
    stem = F.concat_ws("_", "source_split", F.lpad(F.col("image_id").cast("string"), 12, "0"))
    return images.select(*keys).join(lines, keys, "left").select(
        F.concat(stem, F.lit(".txt")).alias("label_file"), F.col("pos").alias("line_no"), "line",
        "class_id", "xc", "yc", "w", "h",
    )


def write_label_table(labels: DataFrame, path: str) -> None:
    """Label lines in file and line order; big files simply continue in the next part."""
    ordered = labels.repartitionByRange("label_file", "line_no").sortWithinPartitions("label_file", "line_no")
    ordered.select("label_file", "line_no", "line").write.parquet(path)


def write_label_files(labels: DataFrame, path: str) -> None:
    """One directory per label file holding its text, for loaders that want files."""
    ordered = labels.repartitionByRange("label_file", "line_no").sortWithinPartitions("label_file", "line_no")
    ordered.select("label_file", F.coalesce("line", F.lit("")).alias("line")).write.partitionBy(
        "label_file"
    ).text(path)


def write_image_list(images: DataFrame, path: str) -> None:
    images.select("path", "split").write.partitionBy("split").text(path)


def write_records(records: DataFrame, path: str, *folders: str, per_file: int = 50_000) -> None:
    """Records as lines of JSON in gzip files, below a folder per value of ``folders``; a file is read by one task, so
    it holds at most ``per_file`` records."""
    writer = records.write.option("compression", "gzip").option("maxRecordsPerFile", per_file)
    (writer.partitionBy(*folders) if folders else writer).json(path)


def write_split_jsonl(records: DataFrame, path: str) -> None:
    write_records(records, path, "project_split")


def coco_sections(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> dict[str, DataFrame]:
    """The three sections of annotation documents, entries ``e`` by ``source_split``; every split has all categories."""
    splits = images.select("source_split").union(annotations.select("source_split")).distinct()
    every = splits.agg(F.collect_set("source_split").alias("s")).select("s").scalar()  # a few names
    return {
        "images": images.select("source_split", F.struct(F.col("image_id").alias("id"), "file_name", "width", "height").alias("e")),
        "annotations": annotations.select(
            "source_split",
            F.struct(
                F.col("annotation_id").alias("id"), "image_id", "category_id",
                F.when(F.col("w").isNotNull(), F.array("x", "y", "w", "h")).alias("bbox"),
                (F.col("w") * F.col("h")).alias("area"), "iscrowd",
            ).alias("e"),
        ),
        "categories": categories.select(
            F.explode(every).alias("source_split"), F.struct(F.col("category_id").alias("id"), "name", "supercategory").alias("e")
        ),
    }


def write_coco_documents(images: DataFrame, annotations: DataFrame, categories: DataFrame, path: str) -> None:
    """One annotation document per source split, ``path/<split>.json``, that a JSON loader or an evaluator can open."""
    write_json_documents(coco_sections(images, annotations, categories), "source_split", path)


def _runs(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Add ``part``: runs of exactly ``size`` rows within ``keys``, however skewed the rows are.

    The order covers every column, so rows that tie are equal and may swap freely.
    """
    others = [c for c in rows.columns if c not in keys]
    ranked = with_rank(rows, keys, others, "_nth")
    return ranked.withColumn("part", F.floor((F.col("_nth") - 1) / size)).drop("_nth")


def write_predictions(predictions: DataFrame, path: str) -> None:
    predictions.select(
        "image_id", "category_id", F.array("x", "y", "w", "h").alias("bbox"), "score"
    ).write.json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A metrics table of tens of rows as one CSV file."""
    metrics.coalesce(1).write.csv(path, header=True)


def append_results(results: DataFrame, path: str) -> None:
    """Append result documents; readers take the newest per id."""
    results.withColumn("written_at", F.current_timestamp()).write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _since(log: DataFrame, current: DataFrame | None, written: str) -> DataFrame:
    """Rows of the log that may be newer than what ``current`` has; the newest time itself is looked at again."""
    if current is None:
        return log
    mark = current.agg(F.max(written).alias("m")).select("m").scalar()
    return log.filter(F.coalesce(F.col(written) >= mark, F.lit(True)))


def compact_results(
    spark: SparkSession, log: str, current: str, key: str = "result_id", written: Sequence[str] = ("written_at",), buckets: int = 64
) -> int:
    """Fold what the log gained into the newest row per id, kept below ``current`` in id buckets; returns the buckets rewritten.

    Only the log behind the last compaction and the buckets with a change are read and replaced, so no step sorts
    or groups all history.  The log stays as it is: a run that failed half way is simply repeated, and a run
    without news writes nothing.  Times of the log must not fall behind rows already compacted.
    """
    kept = spark.read.parquet(current) if _exists(spark, current) else None
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    fresh = latest_result(_since(spark.read.parquet(log), kept, written[0]), key, written)
    fresh = fresh.select("*", bucket)
    if kept is not None:
        names = [c for c in fresh.columns if c != "bucket"]
        same = [F.col(f"f.{c}").eqNullSafe(F.col(f"k.{c}")) for c in names]
        fresh = fresh.alias("f").join(kept.alias("k"), [*same, F.col("f.bucket") == F.col("k.bucket")], "left_anti")
    fresh = stage(fresh, "fresh")
    touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most `buckets`
    if not touched:
        return 0
    merged = fresh if kept is None else fresh.unionByName(kept.filter(F.col("bucket").isin(touched)).select(*fresh.columns))
    newest = stage(latest_result(merged, key, written), "newest")  # never read and overwritten at once
    ordered = newest.repartition("bucket")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(current)
    return len(touched)


def read_current(spark: SparkSession, log: str, current: str, key: str = "result_id", written: Sequence[str] = ("written_at",)) -> DataFrame:
    """The newest row per id, from the compacted rows and the log behind them."""
    kept = spark.read.parquet(current).drop("bucket") if _exists(spark, current) else None
    news = _since(spark.read.parquet(log), kept, written[0])
    return latest_result(news if kept is None else kept.unionByName(news), key, written)


def nest_records(images: DataFrame, annotations: DataFrame, per_record: int = 1000) -> DataFrame:
    """Image records with nested annotations, in runs of at most ``per_record`` within their image.

    Every record says which ``part`` (from 0) of how many ``parts`` of its image it is.
    """
    keys = ["source_split", "image_id"]
    item = F.struct(
        F.col("annotation_id").alias("id"), "image_id", "category_id", "class_id", "category_name",
        F.array("x", "y", "w", "h").alias("bbox_coco"),
        F.array("yolo.xc", "yolo.yc", "yolo.w", "yolo.h").alias("bbox_yolo"),
        (F.col("w") * F.col("h")).alias("area"),
    )
    # A null key meets no image.
    annotations = annotations.dropna(subset=keys)
    rows = annotations.select(*keys, item.alias("item"))
    one = F.lit(1).cast("long")
    # Only an image of more than one record has to be ranked; all others are grouped where the join left them.
    large = annotations.groupBy(*keys).agg(F.ceil(F.count("*") / per_record).alias("parts")).filter("parts > 1")
    several = not large.isEmpty()
    if several:
        large = broadcast_checked(cut_lineage(large))
    small = rows.join(large, keys, "left_anti") if several else rows
    nested = small.groupBy(*keys).agg(
        F.lit(0).cast("long").alias("part"), one.alias("parts"), F.sort_array(F.collect_list("item")).alias("annotations")
    )
    if several:
        cut = _runs(rows.join(large.select(*keys), keys, "left_semi"), keys, per_record)
        runs = cut.groupBy(*keys, "part").agg(F.sort_array(F.collect_list("item")).alias("annotations"))
        nested = nested.unionByName(runs.join(large, keys))
    return images.join(nested, keys, "left").withColumns(
        {
            "annotations": F.coalesce("annotations", F.array()),
            "part": F.coalesce("part", F.lit(0).cast("long")),
            "parts": F.coalesce("parts", one),
        }
    )


def array_documents(rows: DataFrame, section: str | None = None, per_document: int = 20_000, **constants) -> DataFrame:
    """Rows as JSON arrays (or objects with one array ``section``), at most ``per_document`` each."""
    items = F.collect_list(F.struct(*rows.columns))
    body = items if section is None else F.struct(items.alias(section), *[v.alias(k) for k, v in constants.items()])
    return _runs(rows, [], per_document).groupBy("part").agg(F.to_json(body).alias("value")).select("value")


def write_text_files(lines: DataFrame, path: str, per_file: int, compression: str = "none") -> None:
    """Text lines (column ``value``) with at most ``per_file`` lines in a file; a ``gzip`` file is read by one task."""
    lines.select("value").write.option("maxRecordsPerFile", per_file).option("compression", compression).text(path)
    forget_shuffles(lines.sparkSession)
