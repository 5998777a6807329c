"""Values fixed by the data formats and protocols this package works with."""

# Status and reason codes of the annotation classifier.
ACCEPTED = "accepted"
EXCLUDED = "excluded"
REJECTED = "rejected"
REASON_CROWD = "iscrowd_excluded_for_yolov5_compatibility"
REASON_IMAGE = "missing_image_or_invalid_dimensions"
REASON_CATEGORY = "invalid_category_id"
REASON_NO_BBOX = "missing_bbox"
REASON_BBOX = "invalid_bbox:bbox has zero or negative area after clipping"

# Split names, default ratios and seed.
SPLITS = ["train", "val", "test"]
TRAIN_RATIO = 0.8
VAL_RATIO = 0.1
TEST_RATIO = 0.1
SEED = 42

# Object size limits in pixels, and the evaluation area ranges.
SMALL_AREA = 32**2
MEDIUM_AREA = 96**2
AREA_RANGES = [("all", 0.0, 1e10), ("small", 0.0, 1024.0), ("medium", 1024.0, 9216.0), ("large", 9216.0, 1e10)]
IOU_THRESHOLDS = [0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95]
MAX_DETECTIONS = 100

# Names of the twelve summary metrics.
SUMMARY_METRICS = [
    "AP@[0.50:0.95]",
    "AP@0.50",
    "AP@0.75",
    "AP small",
    "AP medium",
    "AP large",
    "AR maxDets=1",
    "AR maxDets=10",
    "AR maxDets=100",
    "AR small",
    "AR medium",
    "AR large",
]

# Training-log metric name, CSV column, direction of "better".
EPOCH_METRICS = [
    ("training_box_loss", "train/box_loss", "min"),
    ("training_objectness_loss", "train/obj_loss", "min"),
    ("training_classification_loss", "train/cls_loss", "min"),
    ("validation_box_loss", "val/box_loss", "min"),
    ("validation_objectness_loss", "val/obj_loss", "min"),
    ("validation_classification_loss", "val/cls_loss", "min"),
    ("precision", "metrics/precision", "max"),
    ("recall", "metrics/recall", "max"),
    ("mAP@0.5", "metrics/mAP_0.5", "max"),
    ("mAP@0.5:0.95", "metrics/mAP_0.5:0.95", "max"),
]

# Columns of a training results file.
EPOCH_COLUMNS = [
    "epoch",
    "train/box_loss",
    "train/obj_loss",
    "train/cls_loss",
    "metrics/precision",
    "metrics/recall",
    "metrics/mAP_0.5",
    "metrics/mAP_0.5:0.95",
    "val/box_loss",
    "val/obj_loss",
    "val/cls_loss",
    "x/lr0",
    "x/lr1",
    "x/lr2",
]

# File suffixes, codec tags, image variants.
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "bmp", "webp"]
VIDEO_EXTENSIONS = ["mp4", "avi", "mov", "mkv", "webm"]
SAMPLE_EXTENSIONS = ["jpg", "jpeg", "png", "bmp"]
BROWSER_CODECS = ["h264", "avc1", "avc3"]
DEFAULT_FPS = 30.0
ROBUSTNESS_CASES = [
    "low_lighting",
    "bright_lighting",
    "occlusion",
    "small_objects",
    "scale_variation",
    "motion_blur",
    "complex_backgrounds",
    "multiple_objects",
]

# Path patterns that may not enter a transfer archive.
PROHIBITED_PATTERNS = [
    ".venv/*",
    "data/raw/*",
    "data/processed/coco_yolo/images/*",
    "data/processed/coco_yolo/labels/*",
    "data/smoke/*",
    "external/yolov5/.git/*",
    "models/pretrained/*.pt",
    "models/trained/*",
    "models/optimized/*",
    "outputs/videos/*",
    "outputs/webcam/*",
    "results/yolov5s/smoke_test/*",
    "**/__pycache__/*",
    "**/*.cache",
    "**/.pytest_cache/*",
]

# Columns of a split manifest.
MANIFEST_COLUMNS = [
    "internal_record_id",
    "source_split",
    "image_id",
    "source_image_path",
    "project_image_path",
    "project_label_path",
    "width",
    "height",
    "valid_object_count",
    "category_names",
]

# Label dialects -> (inclusive class upper bound or null, blank line is an error, class may be a float).
LABEL_DIALECTS = {
    "processed": (79, True, False),
    "smoke": (79, False, True),
    "project": (None, True, False),
}
