"""Annotation boxes: clean-up, class codes, training lines, crops.

A box table has `image, xmin, ymin, xmax, ymax, label` and further columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.boxes import CORNERS, round_half_even, truncate
from brindle.functions.text import basename
from brindle.operators.grouping import HOT_ROWS, global_index, group_index
from brindle.session import materialize

# Boxes of one line at most; an image of more has several.
LINE_BOXES = 100_000


def dedupe(boxes: DataFrame) -> DataFrame:
    return boxes.dropDuplicates()


def drop_incomplete(boxes: DataFrame) -> DataFrame:
    return boxes.na.drop("any")


def class_codes(boxes: DataFrame, position: Sequence[str]) -> DataFrame:
    """`label, code`: consecutive codes in the order in which labels first appear."""
    first = boxes.groupBy("label").agg(F.min(F.struct(*position)).alias("_first"))
    return global_index(first, ["_first", "label"], "code").select("label", F.col("code").cast("int"))


def encode(boxes: DataFrame, codes: DataFrame) -> DataFrame:
    """Add `code`; a table that has one already is left alone. The dictionary is a written table."""
    return boxes if "code" in boxes.columns else boxes.join(codes, "label")


def rounded(boxes: DataFrame) -> DataFrame:
    return boxes.withColumns({c: round_half_even(F.col(c)) for c in CORNERS})


def box_text(*values: Column) -> Column:
    return F.concat_ws(",", *[v.cast("string") for v in values])


def image_lines(
    boxes: DataFrame,
    image: Column,
    text: Column,
    order: Sequence[str],
    name: str = "line",
    max_boxes: int = LINE_BOXES,
) -> DataFrame:
    """`image, part, line`: the texts of an image's boxes, in order, behind its name.

    A line holds `max_boxes` boxes at most: the box at place `i` of its image is in part
    `i div max_boxes`, whatever the size of the image. Parts in order are the image's whole list; the
    reader of such lines takes them together again.
    """
    placed = group_index(boxes.withColumn("_image", image), ["_image"], order, "_place")
    part = F.floor(F.col("_place") / max_boxes).alias("part")
    item = F.struct("_place", text.alias("_text"))
    grouped = placed.groupBy("_image", part).agg(F.sort_array(F.collect_list(item)).alias("items"))
    joined = F.array_join(F.transform("items", lambda i: i["_text"]), " ")
    return grouped.select(
        F.col("_image").alias("image"), "part", F.concat_ws(" ", "_image", joined).alias(name)
    )


def add_bare_images(lines: DataFrame, images: DataFrame, name: str = "line") -> DataFrame:
    """Lines of `image_lines` and, for every other `image`, a line that holds its name alone."""
    others = images.select("image").distinct().join(lines.select("image").distinct(), "image", "left_anti")
    return lines.unionByName(others.select("image", F.lit(0).cast("long").alias("part"), F.col("image").alias(name)))


def training_lines(
    boxes: DataFrame,
    order: Sequence[str],
    folder: str = "",
    max_boxes: int = LINE_BOXES,
    path_column: str | None = None,
) -> DataFrame:
    """`path xmin,ymin,xmax,ymax,code ...` per image, from rounded and encoded boxes.

    The path is folder and image, or the full path that `path_column` holds.
    """
    prefix = folder if not folder or folder.endswith("/") else folder + "/"
    name = F.col(path_column) if path_column else F.concat(F.lit(prefix), "image")
    text = box_text(*[F.col(c) for c in (*CORNERS, "code")])
    return image_lines(boxes, name, text, order, max_boxes=max_boxes)


def prediction_lines(boxes: DataFrame, order: Sequence[str], max_boxes: int = LINE_BOXES) -> DataFrame:
    """`image xmin,ymin,xmax,ymax,label,score ...` per image."""
    text = box_text(*[F.col(c) for c in (*CORNERS, "label", "confidence")])
    return image_lines(boxes, F.col("image"), text, order, max_boxes=max_boxes)


def centrality() -> Column:
    """Horizontal distance of the box centre from the image centre, as a share of the width."""
    return F.abs((F.col("xmin") + F.col("xmax")) / 2 / F.col("x_size") - 0.5)


def central_box(boxes: DataFrame, order: Sequence[str]) -> DataFrame:
    """The most central box of every image; ties by `order`. A mergeable minimum, not a sort."""
    rest = [c for c in boxes.columns if c != "image" and c not in order]
    key = F.struct(centrality().alias("x_centrality"), *order, *rest)
    best = boxes.groupBy("image").agg(F.min(key).alias("b"))
    return best.select("image", "b.*").select(*boxes.columns, "x_centrality")


def crop_names(
    boxes: DataFrame,
    order: Sequence[str],
    postfix: str = "cropped",
    labels: dict[int, str] | None = None,
    max_boxes: int = LINE_BOXES,
) -> DataFrame:
    """Add `crop`: image name, postfix, label and running number of the box inside its image."""
    label = F.col("label").cast("string")
    for code, text in (labels or {}).items():
        label = F.when(F.col("label").cast("string") == str(code), F.lit(text)).otherwise(label)
    stem = F.expr("left(image, length(image) - 4)")
    numbered = group_index(boxes, ["image"], order, "_number", max_boxes)
    crop = F.concat_ws("_", stem, F.lit(postfix), label, F.col("_number").cast("string"))
    return numbered.withColumn("crop", F.concat(crop, F.lit(".jpg"))).drop("_number")


def above_score(boxes: DataFrame, threshold: float = 0.25) -> DataFrame:
    return boxes.where(F.col("confidence") >= threshold)


def crop_status(boxes: DataFrame, expand: float = 1.0, smallest: int = 10) -> DataFrame:
    """Add `status` of a crop: `outside` the image, `small`, or `kept`."""
    x0, y0, x1, y1 = (truncate(F.floor(F.col(c) / expand)) for c in CORNERS)
    outside = (F.col("ymin") > F.col("y_size")) | (F.col("xmin") > F.col("x_size"))
    large = (x1 - x0 > smallest) & (y1 - y0 > smallest)
    return boxes.withColumn(
        "status", F.when(outside, "outside").when(large, "kept").otherwise("small")
    )


def clip(boxes: DataFrame) -> DataFrame:
    """Round half up, clamp to the image, drop boxes that start below it."""

    def near(c: str) -> Column:
        return F.floor(F.col(c) + 0.5)

    clipped = boxes.withColumns(
        {
            "xmin": F.greatest(F.lit(0), near("xmin")).cast("int"),
            "ymin": F.greatest(F.lit(0), near("ymin")).cast("int"),
            "xmax": F.least(F.col("x_size"), near("xmax")).cast("int"),
            "ymax": F.least(F.col("y_size"), near("ymax")).cast("int"),
        }
    )
    return clipped.where((F.col("ymin") <= F.col("y_size")) & (F.col("xmax") <= F.col("x_size")))


def assemble_detections(images: DataFrame) -> DataFrame:
    """One row per detection from `image_path, x_size, y_size, predictions`.

    `predictions` is an array of structs `xmin, ymin, xmax, ymax, label, confidence`.
    """
    path = F.rtrim("image_path", F.lit("\n"))
    return images.select(
        basename(F.col("image_path")).alias("image"),
        path.alias("image_path"),
        F.inline("predictions"),
        "x_size",
        "y_size",
    ).select("image", "image_path", *CORNERS, "label", "confidence", "x_size", "y_size")


def written_codes(codes: DataFrame) -> DataFrame:
    """The dictionary as a table of known size, broadcast by Spark only when it is small."""
    return materialize(codes, "class-codes")
