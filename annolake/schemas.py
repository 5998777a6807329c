"""Schemas of the files this package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

from annolake.constants import EPOCH_COLUMNS

IMAGE = "struct<id:bigint,file_name:string,width:int,height:int>"
ANNOTATION = (
    "struct<id:bigint,image_id:bigint,category_id:bigint,bbox:array<double>,area:double,iscrowd:int>"
)
CATEGORY = "struct<id:bigint,name:string,supercategory:string>"

MANIFEST = (
    "internal_record_id string, source_split string, image_id string, source_image_path string, "
    "project_image_path string, project_label_path string, width string, height string, "
    "valid_object_count string, category_names string"
)

OBJECT = (
    "struct<id:bigint,image_id:bigint,category_id:bigint,class_id:bigint,category_name:string,"
    "bbox_coco:array<double>,bbox_yolo:array<double>,area:double>"
)
RECORD = (
    "image_id bigint, source_split string, file_name string, image_path string, label_path string, "
    f"width int, height int, annotations array<{OBJECT}>, project_split string, "
    "project_image_path string, project_label_path string, part bigint, parts bigint"
)
PROCESSED_CATEGORY = "struct<class_id:bigint,coco_category_id:bigint,name:string,supercategory:string>"
PROCESSED_IMAGE = "struct<image_id:bigint,source_split:string,file_name:string,width:int,height:int>"

PREDICTION = "image_id string, category_id int, bbox array<double>, score double"

RESULT = (
    "result_id string, task_type string, original_filename string, source_path string, output_path string, "
    "detection_count bigint, total_detections bigint, processed_frames bigint, "
    "class_counts map<string,bigint>, inference_time_ms double, average_inference_time_ms double, "
    "average_processing_fps double, confidence_threshold double, iou_threshold double, "
    "timestamp string, _corrupt_record string"
)

EPOCHS = T.StructType([T.StructField(name, T.DoubleType()) for name in EPOCH_COLUMNS])
