"""Bounding-box arithmetic as Column expressions (no UDF).

Pixel boxes are ``x, y, w, h`` with the origin at the top left; normalised boxes are
``xc, yc, w, h`` relative to the image.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from annolake.constants import MEDIUM_AREA, SMALL_AREA


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"))


def clip_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Box cut to the image; null when nothing is left of it."""
    x1, y1 = F.greatest(F.lit(0.0), x), F.greatest(F.lit(0.0), y)
    x2 = F.least(width.cast("double"), x + w)
    y2 = F.least(height.cast("double"), y + h)
    present = x.isNotNull() & y.isNotNull() & w.isNotNull() & h.isNotNull()
    return F.when(present & (x2 > x1) & (y2 > y1), box(x1, y1, x2 - x1, y2 - y1))


def round_box(value: Column, digits: int = 3) -> Column:
    return F.when(
        value.isNotNull(),
        box(*[F.round(value[name], digits) for name in ("x", "y", "w", "h")]),
    )


def normalise_box(value: Column, width: Column, height: Column) -> Column:
    """Pixel box to normalised centre form."""
    return F.when(
        value.isNotNull() & (width > 0) & (height > 0),
        F.struct(
            ((value["x"] + value["w"] / 2.0) / width).alias("xc"),
            ((value["y"] + value["h"] / 2.0) / height).alias("yc"),
            (value["w"] / width).alias("w"),
            (value["h"] / height).alias("h"),
        ),
    )


def to_yolo(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """``struct(box, reason)``: the normalised box, or why there is none."""
    # Plain numbers and every condition once: fields of nested structs are built anew for each use, and a generated
    # method of more than 8000 bytes is not compiled by the JVM.
    x1, y1 = F.greatest(F.lit(0.0), x), F.greatest(F.lit(0.0), y)
    cut_w = F.least(width.cast("double"), x + w) - x1
    cut_h = F.least(height.cast("double"), y + h) - y1
    normal = [(x1 + cut_w / 2.0) / width, (y1 + cut_h / 2.0) / height, cut_w / width, cut_h / height]
    made = F.struct(*[value.alias(name) for value, name in zip(normal, ("xc", "yc", "w", "h"), strict=True)])
    none = F.lit(None).cast("struct<xc:double,yc:double,w:double,h:double>")
    because = lambda reason: F.struct(none.alias("box"), F.lit(reason).alias("reason"))
    return (
        F.when((width <= 0) | (height <= 0), because("image_dimensions_not_positive"))
        .when(x.isNull() | y.isNull() | w.isNull() | h.isNull(), because("bbox_needs_four_values"))
        .when((w <= 0) | (h <= 0), because("bbox_size_not_positive"))
        .when(~F.coalesce((cut_w > 0) & (cut_h > 0), F.lit(False)), because("bbox_outside_image"))
        # What is left of a box is never negative here.
        .when(F.greatest(*normal) > 1, because("normalised_bbox_out_of_range"))
        .when((width > 0) & (height > 0), F.struct(made.alias("box"), F.lit(None).cast("string").alias("reason")))
        .otherwise(F.struct(none.alias("box"), F.lit(None).cast("string").alias("reason")))
    )


def yolo_to_corners(xc: Column, yc: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    return F.struct(
        ((xc - w / 2) * width).alias("x1"),
        ((yc - h / 2) * height).alias("y1"),
        ((xc + w / 2) * width).alias("x2"),
        ((yc + h / 2) * height).alias("y2"),
    )


def letterbox(width: Column, height: Column, size: int = 640) -> Column:
    """Scale and padding that fit an image into a square; rounding is half to even."""
    scale = F.least(F.lit(size) / width, F.lit(size) / height)
    resized_w = F.bround(width * scale, 0).cast("long")
    resized_h = F.bround(height * scale, 0).cast("long")
    pad_w, pad_h = F.lit(size) - resized_w, F.lit(size) - resized_h
    left, top = F.floor(pad_w / 2), F.floor(pad_h / 2)
    return F.struct(
        scale.alias("scale"),
        resized_w.alias("resized_width"),
        resized_h.alias("resized_height"),
        left.alias("left"),
        top.alias("top"),
        (pad_w - left).alias("right"),
        (pad_h - top).alias("bottom"),
    )


def letterbox_corners(corners: Column, frame: Column) -> Column:
    return F.struct(
        (corners["x1"] * frame["scale"] + frame["left"]).alias("x1"),
        (corners["y1"] * frame["scale"] + frame["top"]).alias("y1"),
        (corners["x2"] * frame["scale"] + frame["left"]).alias("x2"),
        (corners["y2"] * frame["scale"] + frame["top"]).alias("y2"),
    )


def box_area(value: Column, digits: int = 3) -> Column:
    return F.round(value["w"] * value["h"], digits)


def box_changed(x: Column, y: Column, w: Column, h: Column, other: Column, tolerance: float = 1e-6) -> Column:
    changed = F.lit(False)
    for mine, name in ((x, "x"), (y, "y"), (w, "w"), (h, "h")):
        changed = changed | (F.abs(mine - other[name]) > tolerance)
    return changed


def size_bucket(area: Column) -> Column:
    return F.when(area < SMALL_AREA, "small").when(area < MEDIUM_AREA, "medium").otherwise("large")


def iou(ax: Column, ay: Column, aw: Column, ah: Column, bx: Column, by: Column, bw: Column, bh: Column) -> Column:
    """Intersection over union of two pixel boxes; 0 when they do not meet."""
    overlap_w = F.least(ax + aw, bx + bw) - F.greatest(ax, bx)
    overlap_h = F.least(ay + ah, by + bh) - F.greatest(ay, by)
    overlap = overlap_w * overlap_h
    return F.when(
        (overlap_w > 0) & (overlap_h > 0), overlap / (aw * ah + bw * bh - overlap)
    ).otherwise(F.lit(0.0))
