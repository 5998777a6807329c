"""Detection tables derived from the driver tables.

The text below runs unchanged in Spark SQL and in DuckDB; ``{name}`` stands for another
table or view.  Integer arithmetic only, so both engines give the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from annolake.session import stage

VIEWS = {
    "fx_images": """
SELECT o_orderkey AS image_id,
  CASE WHEN o_orderkey % 25 = 0 THEN 'val2017' ELSE 'train2017' END AS source_split,
  concat(lpad(CAST(o_orderkey AS STRING), 12, '0'), '.jpg') AS file_name,
  CAST(CASE WHEN o_orderkey % 211 = 7 THEN 0 ELSE 320 + (o_orderkey * 37) % 321 END AS INT) AS width,
  CAST(240 + (o_orderkey * 53) % 241 AS INT) AS height
FROM {orders}""",
    "fx_categories": """
SELECT p_partkey + 1 AS category_id, concat(p_name, ' ', CAST(p_partkey AS STRING)) AS name, p_type AS supercategory
FROM {part} WHERE p_partkey < 90 AND p_partkey % 9 <> 4""",
    "fx_annotations": """
SELECT (l_orderkey * 8 + l_linenumber) * 16 + repeat - 1 AS annotation_id, l_orderkey AS image_id,
  CASE WHEN l_orderkey % 25 = 0 THEN 'val2017' ELSE 'train2017' END AS source_split,
  l_partkey % 90 + 1 AS category_id,
  CAST((l_partkey * 13 + l_linenumber * 101) % 420 - 20 AS DOUBLE) AS x,
  CAST((l_suppkey * 29 + l_linenumber * 67 + l_partkey * 7) % 320 - 15 AS DOUBLE) AS y,
  CAST(CASE WHEN l_partkey % 97 = 3 THEN NULL WHEN l_partkey % 89 = 5 THEN 0 ELSE 8 + (l_partkey * 17 + l_orderkey * 3) % 200 END AS DOUBLE) AS w,
  CAST(8 + (l_suppkey * 31 + l_orderkey * 5 + l_partkey) % 180 AS DOUBLE) AS h,
  CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 1 ELSE 0 END AS iscrowd
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS BIGINT) AS repeat
  FROM {lineitem}) numbered""",
    # The ids as the table states them: lines of one order and number repeat an id.
    "fx_stated_annotations": """
SELECT l_orderkey * 8 + l_linenumber AS annotation_id, CASE WHEN l_orderkey % 25 = 0 THEN 'val2017' ELSE 'train2017' END AS source_split
FROM {lineitem}""",
    "fx_predictions": """
SELECT annotation_id AS det_id,
  CASE WHEN annotation_id % 101 = 0 THEN concat('other_', CAST(image_id AS STRING))
       WHEN image_id % 2 = 0 THEN CAST(image_id AS STRING)
       ELSE concat('train2017_', lpad(CAST(image_id AS STRING), 12, '0')) END AS image_id,
  CASE WHEN annotation_id % 103 = 0 THEN CAST(80 + category_id AS INT) WHEN annotation_id % 11 = 0 THEN CAST(category_id % 80 AS INT)
       ELSE CAST(category_id - 1 - floor((category_id + 3) / 9) AS INT) END AS class_id,
  x + annotation_id % 7 AS x, y + annotation_id % 5 AS y,
  CASE WHEN annotation_id % 107 = 0 THEN 0 ELSE w + image_id % 9 END AS w, h,
  CAST((image_id * 7919 + annotation_id * 104729) % 100000 AS DOUBLE) / 100000 AS score
FROM {fx_annotations} WHERE iscrowd = 0 AND w > 0 AND annotation_id % 5 <> 0""",
    "fx_label_lines": """
SELECT concat('train2017_', lpad(CAST(image_id AS STRING), 12, '0'), '.txt') AS label_file, annotation_id AS line_no,
  concat(CASE WHEN annotation_id % 79 = 0 THEN '80' ELSE CAST(category_id % 80 AS STRING) END, ' ',
    CASE WHEN annotation_id % 83 = 0 THEN 'abc' WHEN annotation_id % 73 = 0 THEN '1.25' ELSE concat('0.', lpad(CAST((annotation_id * 7919) % 1000000 AS STRING), 6, '0')) END, ' ',
    concat('0.', lpad(CAST((annotation_id * 104729) % 1000000 AS STRING), 6, '0')), ' ',
    CASE WHEN annotation_id % 71 = 0 THEN '0.000000' ELSE concat('0.', lpad(CAST(1 + (annotation_id * 31) % 999999 AS STRING), 6, '0')) END,
    CASE WHEN annotation_id % 67 = 0 THEN '' ELSE concat(' 0.', lpad(CAST(1 + (annotation_id * 37) % 999999 AS STRING), 6, '0')) END) AS line
FROM {fx_annotations}""",
    "fx_frames": """
SELECT user_id AS source_id, ts AS frame_ts, event_id, event_type AS class_name,
  CAST(event_id % 5 AS INT) AS detection_count, value AS inference_ms
FROM {events}""",
    "fx_epochs": """
SELECT event_id AS epoch, value / 1000 AS train_box_loss, CAST((event_id * 37) % 1000 AS DOUBLE) / 1000 AS precision_, CAST((event_id * 61) % 1000 AS DOUBLE) / 1000 AS recall_, CAST((event_id * 17) % 499 AS DOUBLE) / 1000 AS map50_95
FROM {events}""",
    # File listing: every image and label of the set, some of them missing.
    "fx_files": """
SELECT concat('images/', source_split, '_', file_name) AS path, CAST(image_id * 31 % 900000 + 1 AS BIGINT) AS size_bytes
FROM {fx_images} WHERE image_id % 173 <> 0
UNION ALL
SELECT concat('labels/', source_split, '_', lpad(CAST(image_id AS STRING), 12, '0'), '.txt') AS path, CAST(image_id * 7 % 4000 AS BIGINT) AS size_bytes
FROM {fx_images} WHERE image_id % 179 <> 0""",
    # Image list of the set with some entries repeated.
    "fx_image_list": """
SELECT image_id AS ord, concat('images/', source_split, '_', file_name) AS path FROM {fx_images}
UNION ALL
SELECT image_id + 1000000000000 AS ord, concat('images/', source_split, '_', file_name) AS path FROM {fx_images} WHERE image_id % 97 = 0""",
}

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


class Inputs:
    """Lazy access to the driver tables and the derived views of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._views: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.table(name)
        if name not in self._views:
            text = VIEWS[name]
            needed = [n for n in (*BASE_TABLES, *VIEWS) if "{" + n + "}" in text]
            self._views[name] = self.spark.sql(text, **{n: self.view(n) for n in needed})
        return self._views[name]

    def keep(self, name: str) -> None:
        """Write a view that several steps read, so that it is worked out once."""
        self._views[name] = stage(self.view(name), name)

    @cached_property
    def images(self) -> DataFrame:
        return self.view("fx_images")

    @cached_property
    def categories(self) -> DataFrame:
        return self.view("fx_categories")

    @cached_property
    def annotations(self) -> DataFrame:
        return self.view("fx_annotations")

    @cached_property
    def predictions(self) -> DataFrame:
        return self.view("fx_predictions")

    @cached_property
    def label_lines(self) -> DataFrame:
        return self.view("fx_label_lines")

    @cached_property
    def frames(self) -> DataFrame:
        return self.view("fx_frames")

    @cached_property
    def epochs(self) -> DataFrame:
        return self.view("fx_epochs")

    @cached_property
    def files(self) -> DataFrame:
        return self.view("fx_files")

    @cached_property
    def image_list(self) -> DataFrame:
        return self.view("fx_image_list")
