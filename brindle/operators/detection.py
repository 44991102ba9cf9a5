"""Detection boxes: suppression, anchors, and coordinate transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.boxes import CORNERS, centre_corners, centre_size, corners, iou, size_iou, truncate
from brindle.operators.grouping import hot_groups, match_keys, unit_hash
from brindle.session import materialize

# Candidates of one group handled together; larger groups go through rounds of this many.
SUPPRESSION_ROWS = 256


def _candidate(df: DataFrame, keys: Sequence[str], score: str) -> tuple[list[str], Column]:
    """Columns of a candidate and the struct that sorts best candidates first."""
    rest = [c for c in df.columns if c not in {*keys, score, *CORNERS}]
    return rest, F.struct((-F.col(score)).alias("rank"), *CORNERS, *rest)


def _overlaps(kept: Column, box: Column, threshold: float) -> Column:
    return F.exists(
        kept, lambda k: F.coalesce(iou(corners(k), corners(box)), F.lit(0.0)) > threshold
    )


def _greedy(candidates: Column, kind: str, threshold: float, max_boxes: int) -> Column:
    """Walk candidates from best to worst, keeping each that overlaps no kept one."""
    return F.aggregate(
        F.sort_array(candidates),
        F.array().cast(f"array<{kind}>"),
        lambda kept, box: F.when(
            (F.size(kept) < max_boxes) & ~_overlaps(kept, box, threshold),
            F.concat(kept, F.array(box)),
        ).otherwise(kept),
    )


def non_max_suppression(
    boxes: DataFrame,
    keys: Sequence[str] = ("image", "label"),
    score: str = "confidence",
    score_threshold: float = 0.25,
    iou_threshold: float = 0.45,
    max_boxes: int = 20,
    group_rows: int = SUPPRESSION_ROWS,
) -> DataFrame:
    """Greedy suppression per group, best scores first, ties by the box.

    A box is dropped when its overlap with a kept, better one is above `iou_threshold`; at most
    `max_boxes` are kept per group. Exact copies of a row count once.

    Groups of up to `group_rows` candidates are walked in one aggregation. For a larger group only
    the best `group_rows` candidates are gathered; the rows left over are compared, where they lie,
    with the boxes kept so far. Every round keeps at least one box of each remaining group, so
    `max_boxes` rounds settle any group exactly.
    """
    keys = list(keys)
    columns = boxes.columns
    alive = boxes.where(F.col(score) >= score_threshold)
    rest, candidate = _candidate(alive, keys, score)
    packed = alive.select(*keys, candidate.alias("box"))
    kind = packed.schema["box"].dataType.simpleString()

    def unpack(kept: DataFrame) -> DataFrame:
        return kept.select(*keys, F.explode("kept").alias("box")).select(
            *keys, (-F.col("box.rank")).alias(score), *[f"box.{c}" for c in (*CORNERS, *rest)]
        ).select(*columns)

    def settle(group: DataFrame) -> DataFrame:
        return group.groupBy(*keys).agg(
            _greedy(F.collect_set("box"), kind, iou_threshold, max_boxes).alias("kept")
        )

    hot = materialize(hot_groups(packed, keys, group_rows).select(*keys), "hot-groups")
    if hot.isEmpty():
        return unpack(settle(packed))

    result = unpack(settle(match_keys(packed, hot, keys, "left_anti")))
    best = Window.partitionBy(*keys).orderBy("box")
    left = match_keys(packed, hot, keys, "left_semi").dropDuplicates()
    left = materialize(left.withColumn("found", F.lit(0)), "suppression")
    for _ in range(max_boxes):
        head = left.withColumn("place", F.row_number().over(best)).where(F.col("place") <= group_rows)
        step = (
            head.groupBy(*keys)
            .agg(
                F.max("found").alias("before"),
                F.max("box").alias("last"),
                _greedy(F.collect_list("box"), kind, iou_threshold, max_boxes).alias("kept"),
            )
            .withColumn("kept", F.slice("kept", F.lit(1), F.lit(max_boxes) - F.col("before")))
            .withColumn("total", F.col("before") + F.size("kept"))
        )
        step = materialize(step, "suppression-step")
        result = result.unionByName(unpack(step))
        open_groups = step.where(F.col("total") < max_boxes).drop("before")
        beyond = match_keys(left.drop("found"), open_groups, keys, "inner").where(F.col("box") > F.col("last"))
        clear = ~_overlaps(F.col("kept"), F.col("box"), iou_threshold)
        left = materialize(
            beyond.where(clear).select(*keys, "box", F.col("total").alias("found")), "suppression"
        )
        if left.isEmpty():
            break
    return result


def anchor_array(anchors: Sequence[tuple[float, float]]) -> Column:
    """A handful of anchors as a literal, so that no join is needed."""
    return F.array(
        *[
            F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("w"), F.lit(float(h)).alias("h"))
            for i, (w, h) in enumerate(anchors)
        ]
    )


def best_anchor(w: Column, h: Column, anchors: Sequence[tuple[float, float]]) -> Column:
    """Struct `iou, minus_id` of the best same-centre overlap; the first anchor wins a tie."""
    return F.array_max(
        F.transform(
            anchor_array(anchors),
            lambda a: F.struct(
                size_iou(w, h, a["w"], a["h"]).alias("iou"), (-a["id"]).alias("minus_id")
            ),
        )
    )


def box_sizes(boxes: DataFrame) -> DataFrame:
    """`w, h, n`: how often each whole-number box size occurs.

    All that clustering needs; its size follows the number of sizes, not of boxes.
    """
    w = truncate(F.col("xmax")) - truncate(F.col("xmin"))
    h = truncate(F.col("ymax")) - truncate(F.col("ymin"))
    return boxes.groupBy(w.alias("w"), h.alias("h")).agg(F.count(F.lit(1)).alias("n"))


def first_centres(sizes: DataFrame, k: int, seed: int) -> list[tuple[int, int]]:
    """`k` distinct sizes in the order of a hash."""
    drawn = unit_hash(F.lit(seed), F.col("w"), F.col("h"))
    return [(r["w"], r["h"]) for r in sizes.orderBy(drawn, "w", "h").limit(k).collect()]


def cluster_anchors(
    boxes: DataFrame, k: int = 9, seed: int = 0, max_rounds: int = 1000
) -> list[tuple[int, int]]:
    """`k` anchors: medians of the boxes nearest by same-centre overlap, sorted by width.

    Centres are whole numbers, an empty cluster keeps its centre, and rounds end when no centre
    moves; it is an error if they still do after `max_rounds`. Only the centres are held on the
    driver.
    """
    sizes = materialize(box_sizes(boxes), "box-sizes")
    centres = first_centres(sizes, k, seed)
    if len(centres) < k:
        raise ValueError(f"fewer than {k} distinct box sizes")
    for _ in range(max_rounds):
        nearest = -best_anchor(F.col("w"), F.col("h"), centres)["minus_id"]
        middle = [F.percentile(c, F.lit(0.5), F.col("n")).cast("int").alias(c) for c in ("w", "h")]
        moved = {r["c"]: (r["w"], r["h"]) for r in sizes.groupBy(nearest.alias("c")).agg(*middle).collect()}
        new = [moved.get(i, centre) for i, centre in enumerate(centres)]
        if new == centres:
            return sorted(centres)
        centres = new
    raise RuntimeError(f"the centres still move after {max_rounds} rounds")


def average_iou(boxes: DataFrame, anchors: Sequence[tuple[float, float]]) -> DataFrame:
    """Mean over all boxes of the overlap with the best anchor."""
    best = best_anchor(F.col("w"), F.col("h"), anchors)["iou"]
    return box_sizes(boxes).select("n", best.alias("iou")).agg(
        (F.sum(F.col("iou") * F.col("n")) / F.sum("n")).alias("avg_iou")
    )


# Anchors of each output layer and the size of its grid cells.
LAYER_ANCHORS = {3: [[6, 7, 8], [3, 4, 5], [0, 1, 2]], 2: [[3, 4, 5], [1, 2, 3]]}
LAYER_CELL = [32, 16, 8]


def assign_anchors(
    boxes: DataFrame,
    anchors: Sequence[tuple[float, float]],
    input_size: tuple[int, int] = (416, 416),
) -> DataFrame:
    """Layer, anchor slot and grid cell of every box of `image, xmin, ..., code`.

    Gives `image, layer, j, i, slot, x, y, w, h, code` with the box as shares of the input height
    and width. Boxes without width are left out.
    """
    high, wide = input_size
    layers = LAYER_ANCHORS[len(anchors) // 3]
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    placed = boxes.where(w > 0).select(
        "image",
        "code",
        (F.floor((F.col("xmin") + F.col("xmax")) / 2) / wide).alias("x"),
        (F.floor((F.col("ymin") + F.col("ymax")) / 2) / high).alias("y"),
        (w / wide).alias("w"),
        (h / high).alias("h"),
        (-best_anchor(w, h, anchors)["minus_id"]).alias("anchor"),
    )
    homes = F.array(
        *[
            F.struct(
                F.lit(layer).alias("layer"),
                F.lit(slot).alias("slot"),
                F.lit(anchor).alias("anchor_id"),
                F.lit(wide // LAYER_CELL[layer]).alias("across"),
                F.lit(high // LAYER_CELL[layer]).alias("down"),
            )
            for layer, ids in enumerate(layers)
            for slot, anchor in enumerate(ids)
        ]
    )
    home = F.explode(F.filter(homes, lambda m: m["anchor_id"] == F.col("anchor")))
    return placed.withColumn("home", home).select(
        "image",
        "home.layer",
        F.floor(F.col("y") * F.col("home.down")).cast("int").alias("j"),
        F.floor(F.col("x") * F.col("home.across")).cast("int").alias("i"),
        "home.slot",
        "x",
        "y",
        "w",
        "h",
        "code",
    )


def target_cells(assigned: DataFrame) -> DataFrame:
    """One row per target cell: the box written last and all class codes seen, as `classes`.

    Boxes of a cell count in the order of their columns.
    """
    cell = ["image", "layer", "j", "i", "slot"]
    box = ["x", "y", "w", "h"]
    return (
        assigned.groupBy(*cell)
        .agg(F.max(F.struct(*box)).alias("b"), F.sort_array(F.collect_set("code")).alias("classes"))
        .select(*cell, *[f"b.{c}" for c in box], "classes")
    )


def first_boxes(boxes: DataFrame, order: Sequence[str], max_boxes: int = 20) -> DataFrame:
    """At most `max_boxes` boxes per image, in `order`; limited before the shuffle too."""
    place = F.row_number().over(Window.partitionBy("image").orderBy(*order))
    return boxes.withColumn("_place", place).where(F.col("_place") <= max_boxes).drop("_place")


def _fit(x_size: Column, y_size: Column, input_size: tuple[int, int]) -> tuple[Column, ...]:
    """Scale and left and top padding of an image fitted into the input."""
    high, wide = input_size
    scale = F.least(wide / x_size, high / y_size)
    dx = F.floor((wide - truncate(x_size * scale)) / 2)
    dy = F.floor((high - truncate(y_size * scale)) / 2)
    return scale, dx, dy


def letterbox(boxes: DataFrame, input_size: tuple[int, int] = (416, 416)) -> DataFrame:
    """Whole-number boxes in the coordinates of the padded input."""
    scale, dx, dy = _fit(F.col("x_size"), F.col("y_size"), input_size)
    return boxes.withColumns(
        {c: truncate(F.col(c) * scale + (dx if c[0] == "x" else dy)) for c in CORNERS}
    )


def unletterbox(boxes: DataFrame, input_size: tuple[int, int] = (416, 416)) -> DataFrame:
    """`x, y, w, h` as shares of the padded input back to corners in the image."""
    high, wide = input_size
    ratio = F.least(high / F.col("y_size"), wide / F.col("x_size"))
    new_w, new_h = F.bround(F.col("x_size") * ratio), F.bround(F.col("y_size") * ratio)
    x = (F.col("x") - (wide - new_w) / 2 / wide) * (wide / new_w)
    y = (F.col("y") - (high - new_h) / 2 / high) * (high / new_h)
    box = centre_corners(x, y, F.col("w") * (wide / new_w), F.col("h") * (high / new_h))
    size = {"x": F.col("x_size"), "y": F.col("y_size")}
    return boxes.withColumns({c: v * size[c[0]] for c, v in zip(CORNERS, box)})


def input_shares(boxes: DataFrame, input_size: tuple[int, int] = (416, 416)) -> DataFrame:
    """Corners in input coordinates to centre and size as shares of the input."""
    high, wide = input_size
    x, y, w, h = centre_size(*corners())
    return boxes.withColumns({"x": x / wide, "y": y / high, "w": w / wide, "h": h / high})


def draw_augmentation(
    images: DataFrame, input_size: tuple[int, int] = (416, 416), jitter: float = 0.3, seed: int = 0
) -> DataFrame:
    """Random resize, shift and flip per image: `nw, nh, dx, dy, flip` are added.

    Draws are hashes of the image name and the seed, so a recomputed task repeats them.
    """
    high, wide = input_size

    def rand(what: str, low=0.0, top=1.0) -> Column:
        return unit_hash(F.lit(seed), F.lit(what), F.col("image")) * (top - low) + low

    aspect = (
        F.lit(wide / high) * rand("wider", 1 - jitter, 1 + jitter) / rand("higher", 1 - jitter, 1 + jitter)
    )
    drawn = images.withColumns({"_aspect": aspect, "_scale": rand("scale", 0.25, 2.0)})
    narrow, ratio = F.col("_aspect") < 1, F.col("_aspect")
    whole_w, whole_h = truncate(F.col("_scale") * wide), truncate(F.col("_scale") * high)
    nw = F.when(narrow, truncate(whole_h * ratio)).otherwise(whole_w)
    nh = F.when(narrow, whole_h).otherwise(truncate(whole_w / ratio))
    place = F.struct(
        nw.alias("nw"),
        nh.alias("nh"),
        truncate(rand("across") * (wide - nw)).alias("dx"),
        truncate(rand("down") * (high - nh)).alias("dy"),
        (rand("flip") < 0.5).alias("flip"),
    )
    # inline keeps later filters on the moved boxes from repeating the draws
    return drawn.select(*images.columns, F.inline(F.array(place)))


def augment(
    boxes: DataFrame,
    order: Sequence[str],
    input_size: tuple[int, int] = (416, 416),
    max_boxes: int = 20,
) -> DataFrame:
    """Boxes resized, shifted, flipped and clipped by their image's draws.

    Boxes of at most one pixel across or down are dropped, then each image keeps `max_boxes`.
    Expects the columns of `draw_augmentation` next to the box.
    """
    high, wide = input_size
    moved = boxes.withColumns(
        {
            "_x0": truncate(F.col("xmin") * F.col("nw") / F.col("x_size") + F.col("dx")),
            "_x1": truncate(F.col("xmax") * F.col("nw") / F.col("x_size") + F.col("dx")),
            "_y0": truncate(F.col("ymin") * F.col("nh") / F.col("y_size") + F.col("dy")),
            "_y1": truncate(F.col("ymax") * F.col("nh") / F.col("y_size") + F.col("dy")),
        }
    )
    flipped = moved.withColumns(
        {
            "_x0": F.when(F.col("flip"), wide - F.col("_x1")).otherwise(F.col("_x0")),
            "_x1": F.when(F.col("flip"), wide - F.col("_x0")).otherwise(F.col("_x1")),
        }
    )
    clipped = flipped.withColumns(
        {
            "_x0": F.greatest(F.col("_x0"), F.lit(0)),
            "_y0": F.greatest(F.col("_y0"), F.lit(0)),
            "_x1": F.least(F.col("_x1"), F.lit(wide)),
            "_y1": F.least(F.col("_y1"), F.lit(high)),
        }
    ).where((F.col("_x1") - F.col("_x0") > 1) & (F.col("_y1") - F.col("_y0") > 1))
    kept = first_boxes(clipped, order, max_boxes)
    return kept.withColumns(
        {"xmin": F.col("_x0"), "xmax": F.col("_x1"), "ymin": F.col("_y0"), "ymax": F.col("_y1")}
    ).drop("_x0", "_x1", "_y0", "_y1")
