"""Column functions on boxes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CORNERS = ("xmin", "ymin", "xmax", "ymax")

# Category ids run from 1 to 90 with gaps; (first id, last id, shift) per run.
CATEGORY_RUNS = [
    (1, 11, 1),
    (13, 25, 2),
    (27, 28, 3),
    (31, 44, 5),
    (46, 65, 6),
    (67, 67, 7),
    (70, 70, 9),
    (72, 82, 10),
    (84, 90, 11),
]


def corners(box: Column | None = None) -> tuple[Column, ...]:
    """The four corner columns, of a struct column if one is given."""
    return tuple(F.col(c) if box is None else box[c] for c in CORNERS)


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union of two corner boxes; null when both are empty."""
    ax0, ay0, ax1, ay1 = a
    bx0, by0, bx1, by1 = b
    wide = F.greatest(F.least(ax1, bx1) - F.greatest(ax0, bx0), F.lit(0.0))
    high = F.greatest(F.least(ay1, by1) - F.greatest(ay0, by0), F.lit(0.0))
    inter = wide * high
    union = (ax1 - ax0) * (ay1 - ay0) + (bx1 - bx0) * (by1 - by0) - inter
    return F.try_divide(inter, union)


def size_iou(w: Column, h: Column, other_w: Column, other_h: Column) -> Column:
    """Intersection over union of two boxes with the same centre."""
    inter = F.least(w, other_w) * F.least(h, other_h)
    return F.try_divide(inter, w * h + other_w * other_h - inter)


def centre_size(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> tuple[Column, ...]:
    return (xmin + xmax) / 2, (ymin + ymax) / 2, xmax - xmin, ymax - ymin


def centre_corners(x: Column, y: Column, w: Column, h: Column) -> tuple[Column, ...]:
    return x - w / 2, y - h / 2, x + w / 2, y + h / 2


def round_half_even(v: Column) -> Column:
    return F.bround(v).cast("int")


def truncate(v: Column) -> Column:
    """Towards zero."""
    return v.cast("int")


def compact_category(category: Column) -> Column:
    """Category ids with gaps to consecutive codes; ids inside a gap stay as they are."""
    out = category
    for first, last, shift in CATEGORY_RUNS:
        out = F.when(category.between(first, last), category - shift).otherwise(out)
    return out


def numbered_name(folder: str, image_id: Column) -> Column:
    """`folder/000000000042.jpg`"""
    return F.concat(F.lit(folder), F.lpad(image_id.cast("string"), 12, "0"), F.lit(".jpg"))
