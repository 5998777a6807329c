"""Identifiers, paths, media facts and thresholds as Column expressions (no UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from annolake.constants import BROWSER_CODECS, DEFAULT_FPS, PROHIBITED_PATTERNS

# Textual formats of identifiers.
PROJECT_IMAGE = r"^(train2017|val2017)_([0-9]{12})$"
PROJECT_FILE = r"^(train2017|val2017)_([0-9]{12})(\.[^.]*)?$"
#: A number alone or behind the prefix of a project image.
PREDICTION_IMAGE = r"^(?:(?:train2017|val2017)_(?=[0-9]{12}$))?([0-9]+)$"
RESULT_ID = r"^[a-zA-Z0-9_-]{12,64}$"
MEDIA_SUFFIX = r"(?i)\.(jpg|jpeg|png|mp4|avi)$"
MODEL_SUFFIX = r"(?i)\.(pt|pth)$"


def internal_image_id(source_split: Column, image_id: Column) -> Column:
    return F.concat_ws("_", source_split, image_id.cast("string"))


def internal_annotation_id(source_split: Column, image_id: Column, annotation_id: Column) -> Column:
    return F.concat_ws("_", source_split, image_id.cast("string"), annotation_id.cast("string"))


def identity_key(source_split: Column, image_id: Column) -> Column:
    return F.concat_ws(":", source_split, F.lpad(image_id.cast("string"), 12, "0"))


def basename(path: Column) -> Column:
    """Last path segment, for both kinds of slash."""
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def stem(name: Column) -> Column:
    """File name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(name, r"^(.+)\.[^.]*$", "$1")


def extension(name: Column) -> Column:
    """Lower-case suffix without its dot; empty when there is none."""
    return F.lower(F.regexp_extract(basename(name), r"^.+\.([^.]+)$", 1))


def project_name(path: Column, source_split: Column, source_path: Column, suffix: str) -> Column:
    """File name of a manifest path, or ``<split>_<source stem><suffix>`` when it is empty."""
    name = basename(F.coalesce(path, F.lit("")))
    default = F.concat(source_split, F.lit("_"), stem(basename(source_path)), F.lit(suffix))
    return F.when(name == "", default).otherwise(name)


def parse_project_image(name: Column) -> Column:
    """``struct(source_split, image_id, source_file_name)``; null when the name does not fit."""
    file_name = basename(name)
    digits = F.regexp_extract(file_name, PROJECT_FILE, 2)
    return F.when(
        file_name.rlike(PROJECT_FILE),
        F.struct(
            F.regexp_extract(file_name, PROJECT_FILE, 1).alias("source_split"),
            digits.try_cast("long").alias("image_id"),
            F.concat(digits, F.lower(F.regexp_extract(file_name, PROJECT_FILE, 3))).alias("source_file_name"),
        ),
    )


def prediction_image_id(value: Column) -> Column:
    """Numeric image id from a number, a digit string or a prefixed name; else null."""
    # Stated once: each mention of the value is one more copy of the expression it comes from.
    return F.regexp_extract(value.cast("string"), PREDICTION_IMAGE, 1).try_cast("long")


def label_path(image_path: Column) -> Column:
    """Label file of an image: first ``images`` directory becomes ``labels``, suffix ``.txt``.

    Without such a directory the label lies in ``labels/<folder>`` beside the folder.
    """
    name = F.substring_index(image_path, "/", -1)
    directory = F.left(image_path, F.length(image_path) - F.length(name))
    at = F.locate("/images/", F.concat(F.lit("/"), directory))
    swapped = F.concat(
        F.left(directory, at - 1), F.lit("labels/"), F.substr(directory, at + F.lit(len("images/")))
    )
    folder = F.substring_index(F.left(directory, F.length(directory) - 1), "/", -1)
    sibling = F.concat(
        F.left(directory, F.length(directory) - F.length(folder) - 1), F.lit("labels/"), folder, F.lit("/")
    )
    return F.concat(F.when(at > 0, swapped).otherwise(sibling), stem(name), F.lit(".txt"))


def safe_output_name(result_id: Column, original: Column, suffix: str, override: str | None = None) -> Column:
    cleaned = F.left(F.regexp_replace(stem(basename(original)), r"[^\p{L}\p{N}_-]", "_"), F.lit(80))
    kept = F.when(cleaned == "", F.lit("upload")).otherwise(cleaned)
    found = extension(original)
    ending = F.lit(override) if override else F.when(found == "", F.lit("dat")).otherwise(found)
    return F.concat(result_id, F.lit("_"), kept, F.lit(f"_{suffix}."), ending)


def extension_allowed(name: Column, allowed: list[str]) -> Column:
    return F.coalesce(extension(name).isin(*[item.lower().lstrip(".") for item in allowed]), F.lit(False))


def valid_result_id(value: Column) -> Column:
    return F.coalesce(value.rlike(RESULT_ID), F.lit(False))


def codec_tag(value: Column) -> Column:
    """Four characters packed into an integer, NUL padding stripped."""
    chars = [F.char(F.shiftright(value.cast("long"), 8 * index).bitwiseAND(F.lit(255))) for index in range(4)]
    text = F.regexp_replace(F.concat(*chars), r"^\x00+|\x00+$", "")
    return F.when(value == 0, F.lit("")).otherwise(text)


def codec_browser_compatible(codec: Column) -> Column:
    return F.coalesce(F.lower(F.trim(codec)).isin(*BROWSER_CODECS), F.lit(False))


def effective_fps(fps: Column) -> Column:
    return F.when(fps > 0, fps).otherwise(F.lit(DEFAULT_FPS))


def video_duration(frame_count: Column, fps: Column) -> Column:
    return F.when(frame_count > 0, frame_count / effective_fps(fps)).otherwise(F.lit(0.0))


def latency_to_fps(milliseconds: Column) -> Column:
    return F.when(milliseconds > 0, 1000.0 / milliseconds).otherwise(F.lit(0.0))


def glob_to_regex(pattern: str) -> str:
    """Shell glob to an anchored regular expression; ``*`` also crosses slashes."""
    body = "".join({"*": ".*", "?": "."}.get(char, re.escape(char)) for char in pattern)
    return f"^{body}$"


def path_excluded(path: Column, patterns: list[str] = PROHIBITED_PATTERNS) -> Column:
    normal = F.regexp_replace(path, r"\\", "/")
    return normal.rlike("|".join(f"(?:{glob_to_regex(pattern)})" for pattern in patterns))


def archive_entry_flags(path: Column) -> Column:
    """What is wrong with one archive entry, as five booleans."""
    normal = F.regexp_replace(path, r"\\", "/")
    return F.struct(
        normal.startswith("/").alias("absolute_path"),
        normal.rlike(r"(^|/)\.\.(/|$)").alias("path_traversal"),
        path_excluded(path).alias("prohibited"),
        normal.rlike(MODEL_SUFFIX).alias("model_file"),
        (normal.rlike(MEDIA_SUFFIX) & normal.startswith("data/")).alias("dataset_media"),
    )


def size_mb(size_bytes: Column) -> Column:
    return F.round(size_bytes / float(1024**2), 3)


def size_ok(size_bytes: Column, maximum_mb: float) -> Column:
    return size_bytes <= int(float(maximum_mb) * 1024 * 1024)


def threshold_valid(value: Column) -> Column:
    return F.coalesce(value.between(0.0, 1.0), F.lit(False))


def checked_threshold(value: Column, label: str) -> Column:
    """The value itself; the query fails when it lies outside 0..1."""
    message = F.concat(F.lit(f"{label} threshold must be between 0 and 1: "), value.cast("string"))
    return F.when(threshold_valid(value), value).otherwise(F.raise_error(message).cast("double"))


def image_magic_ok(content: Column, size_bytes: Column) -> Column:
    """Whether a file starts like the JPEG, PNG, BMP or WEBP it claims to be."""
    head = F.hex(F.substring(content, 1, 12))
    return (size_bytes > 0) & (
        head.startswith("FFD8FF")
        | head.startswith("89504E470D0A1A0A")
        | head.startswith("424D")
        | (head.startswith("52494646") & head.endswith("57454250"))
    )
