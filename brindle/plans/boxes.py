"""Box queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.functions.boxes import CATEGORY_RUNS, CORNERS, compact_category, corners, iou
from brindle.functions.text import rebase_path
from brindle.operators import boxes as ops, detection
from brindle.plans.inputs import (
    ANCHORS,
    BOX_ORDER,
    BOXES_SQL,
    boxes,
    raw_boxes,
    table,
    unit_sql,
    with_sql,
)
from brindle.session import materialize
from brindle.sources import annotations
from brindle.sources.text import literal_table

INPUT = (416, 416)
CLUSTERS, SEED = 6, 0
SQL_ROUNDS = 25  # the SQL counterpart cannot stop by itself; further rounds change nothing


def written_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct boxes, written once for operators that look at them twice."""
    return materialize(boxes(spark, sf_dir), "boxes")


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct boxes with a class code by first appearance."""
    codes = ops.written_codes(ops.class_codes(raw_boxes(spark, sf_dir), ["image", *BOX_ORDER]))
    return ops.encode(boxes(spark, sf_dir), codes)


def _rounded_lines(spark, sf_dir):
    written = materialize(ops.rounded(encoded(spark, sf_dir)), "encoded-boxes")
    return ops.training_lines(written, BOX_ORDER, "/data")


def _codes(spark, sf_dir):
    return encoded(spark, sf_dir).groupBy("label", "code").agg(F.count(F.lit(1)).alias("n"))


def _lines(spark, sf_dir):
    return _rounded_lines(spark, sf_dir)


def _line_parse(spark, sf_dir):
    lines = _rounded_lines(spark, sf_dir).select(F.col("line").alias("value"))
    return annotations.parse_training_lines(lines)


def _prediction_lines(spark, sf_dir):
    return ops.prediction_lines(written_boxes(spark, sf_dir), BOX_ORDER)


def _coco_lines(spark, sf_dir):
    """Training lines of the boxes of COCO documents."""
    found = materialize(_coco(spark, sf_dir), "coco-boxes")
    return ops.training_lines(found, [*CORNERS, "code"])


def _voc_lines(spark, sf_dir):
    """Training lines of XML documents by their full path; images without a box have a bare line."""
    found = materialize(_voc(spark, sf_dir), "voc-boxes")
    path = F.concat(F.lit("/data/voc/"), "image")
    lines = ops.training_lines(found.withColumn("path", path), [*CORNERS, "code"], path_column="path")
    return ops.add_bare_images(lines, raw_boxes(spark, sf_dir).select(path.alias("image")))


def _central(spark, sf_dir):
    found = ops.central_box(boxes(spark, sf_dir), BOX_ORDER)
    return found.withColumn("x_centrality", F.round("x_centrality", 9))


def _crops(spark, sf_dir):
    complete = ops.drop_incomplete(written_boxes(spark, sf_dir))
    return ops.crop_names(complete, BOX_ORDER).select("image", "crop")


def _filter(spark, sf_dir):
    return ops.crop_status(ops.above_score(boxes(spark, sf_dir)))


def _rebase(spark, sf_dir):
    paths = raw_boxes(spark, sf_dir).select("image").distinct()
    path = F.concat(F.lit("C:\\home\\me\\catalog\\pics\\"), "image")
    return paths.select("image", rebase_path(path, "catalog", "/mnt/lake").alias("path"))


def _category(spark, sf_dir):
    ids = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 95).alias("category"))
    return ids.groupBy("category", compact_category(F.col("category")).alias("code")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _iou(spark, sf_dir):
    """Overlap of every box with the most central box of its image."""
    all_boxes = written_boxes(spark, sf_dir)
    central = ops.central_box(all_boxes, BOX_ORDER).select("image", F.struct(*CORNERS).alias("central"))
    pairs = all_boxes.join(materialize(central, "central-boxes"), "image")
    overlap = iou(corners(), corners(F.col("central")))
    return pairs.select("image", *BOX_ORDER, F.round(overlap, 6).alias("iou"))


def _assign(spark, sf_dir):
    found = detection.target_cells(detection.assign_anchors(encoded(spark, sf_dir), ANCHORS, INPUT))
    return found.select(
        "image", "layer", "j", "i", "slot",
        *[F.round(c, 9).alias(c) for c in "xywh"],
        F.array_join(F.transform("classes", lambda c: c.cast("string")), ",").alias("classes"),
    )


def _letterbox(spark, sf_dir):
    return detection.letterbox(detection.first_boxes(boxes(spark, sf_dir), BOX_ORDER), INPUT)


def _unletterbox(spark, sf_dir):
    shares = detection.input_shares(boxes(spark, sf_dir), INPUT)
    found = detection.unletterbox(shares, INPUT)
    return found.select("image", "label", "confidence", *[F.round(c, 6).alias(c) for c in CORNERS])


def _asset(spark, sf_dir):
    """One annotation asset per row with the box and the same box half as large."""

    def region(scale: float):
        left, top, right, bottom = corners()
        return F.struct(
            F.lit("r").alias("id"),
            F.lit("RECTANGLE").alias("type"),
            F.array("label").alias("tags"),
            F.struct(
                ((bottom - top) * scale).alias("height"),
                ((right - left) * scale).alias("width"),
                left.alias("left"),
                top.alias("top"),
            ).alias("boundingBox"),
        )

    size = F.struct(F.col("x_size").alias("width"), F.col("y_size").alias("height"))
    asset = F.struct(
        F.lit("jpg").alias("format"),
        F.col("image").alias("name"),
        F.concat(F.lit("file:/data/"), "image").alias("path"),
        size.alias("size"),
    )
    value = F.to_json(F.struct(asset.alias("asset"), F.array(region(1.0), region(0.5)).alias("regions")))
    return annotations.parse_assets(raw_boxes(spark, sf_dir).select(value.alias("value")))


def _coco(spark, sf_dir):
    left, top, right, bottom = corners()

    def annotation(shift: int):
        return F.struct(
            F.regexp_extract("image", r"(\d+)", 1).cast("long").alias("image_id"),
            (F.ascii("label") + shift).alias("category_id"),
            F.array(left, top, right - left, bottom - top).alias("bbox"),
        )

    value = F.to_json(F.struct(F.array(annotation(0), annotation(7)).alias("annotations")))
    return annotations.parse_coco(raw_boxes(spark, sf_dir).select(value.alias("value")), "train/")


def _voc(spark, sf_dir):
    def tag(name: str, column: str):
        return F.concat(F.lit(f"<{name}>"), F.floor(column).cast("string"), F.lit(f"</{name}>"))

    def item(difficult: str):
        return F.concat(
            F.lit("<object><name>"), "label", F.lit(f"</name><difficult>{difficult}</difficult><bndbox>"),
            *[tag(c, c) for c in CORNERS], F.lit("</bndbox></object>"),
        )

    value = F.concat(F.lit("<annotation>"), item("0"), item("1"), item("0"), F.lit("</annotation>"))
    documents = raw_boxes(spark, sf_dir).select("image", value.alias("value"))
    return annotations.parse_voc(documents, ["A", "R"], keep=["image"])


def _relative_xml(spark, sf_dir):
    def tag(name: str, value):
        return F.concat(F.lit(f"<{name}>\n"), value.cast("string"), F.lit(f"\n</{name}>\n"))

    share = {c: F.col(c) / 512 for c in CORNERS}
    # the x tags of this format hold the vertical coordinate
    value = F.concat(
        F.lit("<object>\n"),
        tag("x", share["ymin"]), tag("y", share["xmin"]), tag("x", share["ymax"]), tag("y", share["xmax"]),
        tag("label", F.lit("3")), tag("labelname", F.col("label")),
        F.lit("</object>\n<object>\n"),
        tag("x", share["ymin"] / 2), tag("y", share["xmin"] / 2),
        tag("x", share["ymax"] / 2), tag("y", share["xmax"] / 2),
        tag("label", F.lit("4")), tag("labelname", F.concat(F.lit("half "), "label")),
        F.lit("</object>\n"),
    )
    documents = raw_boxes(spark, sf_dir).select("image", "x_size", "y_size", value.alias("value"))
    found = annotations.parse_relative_xml(documents)
    return found.select("image", *[F.round(c, 6).alias(c) for c in CORNERS], "label", "code")


def _detections(spark, sf_dir):
    """Predictions held as arrays per image file, one row per prediction out."""

    def prediction(shift: int):
        values = [F.floor(F.col(c) + shift).cast("int").alias(c) for c in CORNERS]
        return F.struct(*values, F.ascii("label").alias("label"), F.col("confidence"))

    images = raw_boxes(spark, sf_dir).select(
        F.concat(F.lit("/data/pics/"), "image", F.lit("\n")).alias("image_path"),
        "x_size",
        "y_size",
        F.array(prediction(0), prediction(3)).alias("predictions"),
    )
    return ops.assemble_detections(images)


def _nms(spark, sf_dir):
    return detection.non_max_suppression(raw_boxes(spark, sf_dir))


def _anchors(spark, sf_dir):
    found = detection.cluster_anchors(boxes(spark, sf_dir), CLUSTERS, SEED)
    return literal_table(spark, [(i, w, h) for i, (w, h) in enumerate(found)], "id int, w int, h int")


def _avg_iou(spark, sf_dir):
    found = detection.average_iou(boxes(spark, sf_dir), ANCHORS)
    return found.withColumn("avg_iou", F.round("avg_iou", 9))


def _anchor_fit(spark, sf_dir):
    """Boxes and their mean overlap with the best of the anchors just found."""
    written = materialize(boxes(spark, sf_dir), "boxes")
    found = detection.average_iou(written, detection.cluster_anchors(written, CLUSTERS, SEED))
    return found.select(F.lit(CLUSTERS).alias("n_anchors"), F.round("avg_iou", 9).alias("avg_iou"))


def _augment(spark, sf_dir):
    whole = ops.rounded(boxes(spark, sf_dir))
    drawn = detection.draw_augmentation(whole.select("image").distinct(), INPUT, seed=SEED)
    return detection.augment(whole.join(drawn, "image"), BOX_ORDER, INPUT).select("image", *CORNERS, "label", "confidence")


def _sql(query: str, *ctes: str, recursive: bool = False) -> str:
    return with_sql(BOXES_SQL, *ctes, query=query, recursive=recursive)


_ORDER = ", ".join(BOX_ORDER)
_CODES = f"""
codes as (select label, cast(row_number() over (order by r) - 1 as int) as code
          from (select label, min(r) as r from
                (select label, row_number() over (order by image, {_ORDER}) as r from boxes)
                group by label)),
encoded as (select * from boxes join codes using (label))"""
_ROUNDED = "cast(round_even({c}, 0) as int)"
_CENTRAL = f"""
central as (select *, abs((xmin + xmax) / 2 / x_size - 0.5::double) as x_centrality from boxes
            qualify row_number() over (partition by image
              order by abs((xmin + xmax) / 2 / x_size - 0.5::double), {_ORDER}) = 1)"""


def _iou_sql(a: str, b: str) -> str:
    inter = (
        f"greatest(least({a}.xmax, {b}.xmax) - greatest({a}.xmin, {b}.xmin), 0) * "
        f"greatest(least({a}.ymax, {b}.ymax) - greatest({a}.ymin, {b}.ymin), 0)"
    )
    area = "({0}.xmax - {0}.xmin) * ({0}.ymax - {0}.ymin)".format
    return f"({inter} / ({area(a)} + {area(b)} - {inter}))"


def _size_iou_sql(w: str, h: str, cw: str, ch: str) -> str:
    inter = f"least({w}, {cw}) * least({h}, {ch})"
    return f"({inter} / cast({w} * {h} + {cw} * {ch} - {inter} as double))"


_ANCHORS = "anchors as (select * from (values " + ", ".join(
    f"({i}, {w}, {h})" for i, (w, h) in enumerate(ANCHORS)
) + ") a(id, aw, ah))"

_LINES = f"""
placed as (select *, (row_number() over (partition by image order by {_ORDER}) - 1) // {ops.LINE_BOXES} as part
           from encoded),
lines as (select image, part, '/data/' || image || ' ' || string_agg(
            {" || ',' || ".join(_ROUNDED.format(c=c) for c in CORNERS)} || ',' || code, ' ' order by {_ORDER}) as line
          from placed group by image, part)"""

_ASSIGN = f"""
nearest as (
  select image, code, floor((xmin + xmax) / 2) / 416 as x, floor((ymin + ymax) / 2) / 416 as y,
         (xmax - xmin) / 416 as w, (ymax - ymin) / 416 as h, id
  from encoded, anchors
  qualify row_number() over (partition by image, {_ORDER}, x_size, y_size
    order by {_size_iou_sql("(xmax - xmin)", "(ymax - ymin)", "aw", "ah")} desc, id) = 1),
placed as (select *, 2 - id // 3 as layer, id % 3 as slot, 13 * cast(pow(2, 2 - id // 3) as int) as cells from nearest),
cells as (select *, cast(floor(y * cells) as int) as j, cast(floor(x * cells) as int) as i from placed)"""

_NMS = f"""
found as (
  select *, row_number() over (partition by image, label order by confidence desc, {_ORDER}, x_size, y_size) as r
  from boxes where confidence >= 0.25),
walk as (
  select image, label, 1 as r, [{{'xmin': xmin, 'ymin': ymin, 'xmax': xmax, 'ymax': ymax,
         'confidence': confidence, 'x_size': x_size, 'y_size': y_size}}] as kept
  from found where r = 1
  union all
  select f.image, f.label, f.r,
         case when len(w.kept) < 20 and len(list_filter(w.kept, lambda k: {_iou_sql("k", "f")} > 0.45)) = 0
              then list_append(w.kept, {{'xmin': f.xmin, 'ymin': f.ymin, 'xmax': f.xmax, 'ymax': f.ymax,
                   'confidence': f.confidence, 'x_size': f.x_size, 'y_size': f.y_size}})
              else w.kept end
  from walk w join found f on f.image = w.image and f.label = w.label and f.r = w.r + 1)"""


def _anchors_sql(query: str) -> str:
    """A query on the sizes `s` and the anchors `found(id, w, h)` that the rounds of clustering end with."""
    ctes = [
        "s as (select cast(trunc(xmax) as int) - cast(trunc(xmin) as int) as w, "
        "cast(trunc(ymax) as int) - cast(trunc(ymin) as int) as h from boxes)",
        f"c0 as (select row_number() over (order by {unit_sql(SEED, 'w', 'h')}, w, h) - 1 as id, w as cw, h as ch "
        f"from (select distinct w, h from s) qualify id < {CLUSTERS})",
    ]
    for i in range(SQL_ROUNDS):
        ctes.append(
            f"n{i} as (select w, h, id from (select distinct w, h from s), c{i} "
            f"qualify row_number() over (partition by w, h order by {_size_iou_sql('w', 'h', 'cw', 'ch')} desc, id) = 1)"
        )
        ctes.append(
            f"m{i} as (select id, cast(trunc(median(w)) as int) as mw, cast(trunc(median(h)) as int) as mh "
            f"from s join n{i} using (w, h) group by id)"
        )
        ctes.append(
            f"c{i + 1} as (select id, coalesce(mw, cw) as cw, coalesce(mh, ch) as ch "
            f"from c{i} left join m{i} using (id))"
        )
    ctes.append(
        f"found as (select cast(row_number() over (order by cw, ch) - 1 as int) as id, cw as w, ch as h from c{SQL_ROUNDS})"
    )
    return _sql(query, *ctes)


def _draw(what: str, low: float = 0.0, top: float = 1.0) -> str:
    return f"({unit_sql(SEED, repr(what), 'image')} * {top - low!r}::double + {low!r}::double)"


_AUGMENT = f"""
drawn as (
  select *, {_draw("wider", 0.7, 1.3)} / {_draw("higher", 0.7, 1.3)} as aspect, {_draw("scale", 0.25, 2.0)} as scale
  from (select image, {", ".join(f"{_ROUNDED.format(c=c)} as {c}" for c in CORNERS)}, label, confidence, x_size, y_size from boxes)),
sized as (
  select *, case when aspect < 1 then cast(trunc(cast(trunc(scale * 416) as int) * aspect) as int)
                 else cast(trunc(scale * 416) as int) end as nw,
         case when aspect < 1 then cast(trunc(scale * 416) as int)
              else cast(trunc(cast(trunc(scale * 416) as int) / aspect) as int) end as nh
  from drawn),
moved as (
  select *, cast(trunc({_draw("across")} * (416 - nw)) as int) as dx,
         cast(trunc({_draw("down")} * (416 - nh)) as int) as dy, {_draw("flip")} < 0.5 as flip
  from sized),
placed as (
  select *, cast(trunc(xmin * nw / x_size + dx) as int) as x0, cast(trunc(xmax * nw / x_size + dx) as int) as x1,
         cast(trunc(ymin * nh / y_size + dy) as int) as y0, cast(trunc(ymax * nh / y_size + dy) as int) as y1
  from moved),
clipped as (
  select image, xmin, ymin, xmax, ymax, label, confidence,
         greatest(case when flip then 416 - x1 else x0 end, 0) as x0,
         least(case when flip then 416 - x0 else x1 end, 416) as x1,
         greatest(y0, 0) as y0, least(y1, 416) as y1
  from placed)"""

_FIT = (
    "least(416 / x_size, 416 / y_size) as scale, "
    "(416 - cast(trunc(x_size * least(416 / x_size, 416 / y_size)) as int)) // 2 as dx, "
    "(416 - cast(trunc(y_size * least(416 / x_size, 416 / y_size)) as int)) // 2 as dy"
)
_LETTER = f"""
fitted as (select *, {_FIT} from boxes
           qualify row_number() over (partition by image order by {_ORDER}) <= 20)"""
_UNLETTER = """
shares as (
  select image, label, confidence, x_size, y_size, (xmin + xmax) / 2 / 416 as x, (ymin + ymax) / 2 / 416 as y,
         (xmax - xmin) / 416 as w, (ymax - ymin) / 416 as h,
         round_even(x_size * least(416 / x_size, 416 / y_size), 0) as nw,
         round_even(y_size * least(416 / x_size, 416 / y_size), 0) as nh
  from boxes),
back as (
  select image, label, confidence, x_size, y_size, (x - (416 - nw) / 2 / 416) * (416 / nw) as x,
         (y - (416 - nh) / 2 / 416) * (416 / nh) as y, w * (416 / nw) as w, h * (416 / nh) as h
  from shares)"""


def _category_sql(column: str) -> str:
    cases = " ".join(
        f"when {column} between {first} and {last} then {column} - {shift}"
        for first, last, shift in CATEGORY_RUNS
    )
    return f"case {cases} else {column} end"


def _coco_sql(shift: int) -> str:
    return (
        "select 'train/' || lpad(regexp_extract(image, '(\\d+)', 1), 12, '0') || '.jpg' as image, "
        "cast(trunc(xmin) as int) as xmin, cast(trunc(ymin) as int) as ymin, "
        "cast(trunc(xmin) as int) + cast(trunc(xmax - xmin) as int) as xmax, "
        "cast(trunc(ymin) as int) + cast(trunc(ymax - ymin) as int) as ymax, "
        f"{_category_sql(f'(ascii(label) + {shift})')} as code from raw_boxes"
    )


_VOC = (
    "select image, cast(floor(xmin) as int) as xmin, cast(floor(ymin) as int) as ymin, "
    "cast(floor(xmax) as int) as xmax, cast(floor(ymax) as int) as ymax, "
    "case label when 'A' then 0 else 1 end as code from raw_boxes where label in ('A', 'R')"
)


def _detections_sql(shift: int) -> str:
    places = ", ".join(f"cast(floor({c} + {shift}) as int) as {c}" for c in CORNERS)
    return (
        f"select image, '/data/pics/' || image as image_path, {places}, ascii(label) as label, "
        "confidence, x_size, y_size from raw_boxes"
    )


def _relative_sql(divisor: int, label: str, code: str) -> str:
    places = ", ".join(
        f"round({c} / 512 / {divisor} * {'x_size' if c[0] == 'x' else 'y_size'}, 6) as {c}" for c in CORNERS
    )
    return f"select image, {places}, {label} as label, '{code}' as code from raw_boxes"


def _plain_lines_sql(rows: str) -> str:
    corners_and_code = ", ".join([*CORNERS, "code"])
    return (
        f"select image, part, image || ' ' || string_agg({corners_and_code.replace(', ', " || ',' || ")}, ' ' "
        f"order by {corners_and_code}) as line from (select *, (row_number() over (partition by image "
        f"order by {corners_and_code}) - 1) // {ops.LINE_BOXES} as part from ({rows})) group by image, part"
    )


QUERIES = {
    "box_dedupe": (lambda spark, sf_dir: ops.dedupe(raw_boxes(spark, sf_dir)), _sql("select * from boxes")),
    "box_encode": (_codes, _sql("select label, code, count(*) as n from encoded group by label, code", _CODES)),
    "box_round": (
        lambda spark, sf_dir: ops.rounded(boxes(spark, sf_dir)),
        _sql(
            "select image, " + ", ".join(f"{_ROUNDED.format(c=c)} as {c}" for c in CORNERS)
            + ", label, confidence, x_size, y_size from boxes"
        ),
    ),
    "box_lines": (_lines, _sql("select '/data/' || image as image, part, line from lines", _CODES, _LINES)),
    "box_coco_lines": (_coco_lines, _sql(_plain_lines_sql(f"{_coco_sql(0)} union all {_coco_sql(7)}"))),
    "box_voc_lines": (
        _voc_lines,
        _sql(
            _plain_lines_sql(_VOC.replace("select image", "select '/data/voc/' || image as image") + " union all "
                             + _VOC.replace("select image", "select '/data/voc/' || image as image"))
            + " union all select distinct '/data/voc/' || image, cast(0 as bigint), '/data/voc/' || image from raw_boxes "
            "where image not in (select image from raw_boxes where label in ('A', 'R'))"
        ),
    ),
    "box_line_parse": (
        _line_parse,
        _sql(
            "select '/data/' || image as image, "
            + ", ".join(f"{_ROUNDED.format(c=c)} as {c}" for c in CORNERS)
            + ", code from encoded",
            _CODES,
        ),
    ),
    "box_prediction_lines": (
        _prediction_lines,
        _sql(
            "select image, part, image || ' ' || string_agg("
            + " || ',' || ".join([*CORNERS, "label", "confidence"])
            + f", ' ' order by {_ORDER}) as line from (select *, (row_number() over (partition by image "
            f"order by {_ORDER}) - 1) // {ops.LINE_BOXES} as part from boxes) group by image, part"
        ),
    ),
    "box_central": (
        _central,
        _sql(
            f"select image, {_ORDER}, x_size, y_size, round(x_centrality, 9) as x_centrality from central",
            _CENTRAL,
        ),
    ),
    "box_crop_names": (
        _crops,
        _sql(
            "select image, left(image, length(image) - 4) || '_cropped_' || label || '_' || "
            f"(row_number() over (partition by image order by {_ORDER}) - 1) || '.jpg' as crop from boxes"
        ),
    ),
    "box_filter": (
        _filter,
        _sql(
            "select *, case when ymin > y_size or xmin > x_size then 'outside' "
            "when floor(xmax) - floor(xmin) > 10 and floor(ymax) - floor(ymin) > 10 then 'kept' "
            "else 'small' end as status from boxes where confidence >= 0.25"
        ),
    ),
    "box_clip": (
        lambda spark, sf_dir: ops.clip(boxes(spark, sf_dir)),
        _sql(
            "select image, cast(greatest(0, floor(xmin + 0.5)) as int) as xmin, "
            "cast(greatest(0, floor(ymin + 0.5)) as int) as ymin, "
            "cast(least(x_size, floor(xmax + 0.5)) as int) as xmax, "
            "cast(least(y_size, floor(ymax + 0.5)) as int) as ymax, label, confidence, x_size, y_size "
            "from boxes where greatest(0, floor(ymin + 0.5)) <= y_size"
        ),
    ),
    "box_rebase": (
        _rebase,
        _sql("select distinct image, '/mnt/lake/catalog/pics/' || image as path from boxes"),
    ),
    "box_category": (
        _category,
        f"select category, {_category_sql('category')} as code, count(*) as n "
        "from (select l_partkey % 95 as category from lineitem) group by 1, 2",
    ),
    "box_iou": (
        _iou,
        _sql(
            f"select b.image, {', '.join('b.' + c for c in BOX_ORDER)}, round({_iou_sql('b', 'c')}, 6) as iou "
            "from boxes b join central c using (image)",
            _CENTRAL,
        ),
    ),
    "box_anchor_assign": (
        _assign,
        _sql(
            "select image, layer, j, i, slot, round(x, 9) as x, round(y, 9) as y, round(w, 9) as w, "
            "round(h, 9) as h, (select string_agg(distinct c2.code, ',' order by c2.code) from cells c2 "
            "where (c2.image, c2.layer, c2.j, c2.i, c2.slot) = (c.image, c.layer, c.j, c.i, c.slot)) as classes "
            "from cells c qualify row_number() over (partition by image, layer, j, i, slot "
            "order by c.x desc, c.y desc, c.w desc, c.h desc) = 1",
            _CODES, _ANCHORS, _ASSIGN,
        ),
    ),
    "box_letterbox": (
        _letterbox,
        _sql(
            "select image, "
            + ", ".join(
                f"cast(trunc({c} * scale + {'dx' if c[0] == 'x' else 'dy'}) as int) as {c}" for c in CORNERS
            )
            + ", label, confidence, x_size, y_size from fitted",
            _LETTER,
        ),
    ),
    "box_unletterbox": (
        _unletterbox,
        _sql(
            "select image, label, confidence, round((x - w / 2) * x_size, 6) as xmin, "
            "round((y - h / 2) * y_size, 6) as ymin, round((x + w / 2) * x_size, 6) as xmax, "
            "round((y + h / 2) * y_size, 6) as ymax from back",
            _UNLETTER,
        ),
    ),
    "box_assets": (
        _asset,
        _sql(
            " union all ".join(
                "select image, 'file:/data/' || image as image_path, xmin, ymin, "
                f"xmin + (xmax - xmin) * {k} as xmax, ymin + (ymax - ymin) * {k} as ymax, label, x_size, y_size "
                "from raw_boxes"
                for k in ("1.0::double", "0.5::double")
            )
        ),
    ),
    "box_coco": (_coco, _sql(_coco_sql(0) + " union all " + _coco_sql(7))),
    "box_voc": (_voc, _sql(f"{_VOC} union all {_VOC}")),
    "box_relxml": (
        _relative_xml,
        _sql(_relative_sql(1, "label", "3") + " union all " + _relative_sql(2, "'half ' || label", "4")),
    ),
    "box_detections": (_detections, _sql(_detections_sql(0) + " union all " + _detections_sql(3))),
    "box_nms": (
        _nms,
        _sql(
            "select image, label, k.xmin, k.ymin, k.xmax, k.ymax, k.confidence, k.x_size, k.y_size from ("
            "select image, label, unnest(kept) as k from walk "
            "qualify row_number() over (partition by image, label order by r desc) = 1)",
            _NMS, recursive=True,
        ),
    ),
    "box_kmeans": (_anchors, _anchors_sql("select id, w, h from found")),
    "box_kmeans_iou": (
        _anchor_fit,
        _anchors_sql(
            f"select {CLUSTERS} as n_anchors, round(avg(best), 9) as avg_iou from (select max("
            + _size_iou_sql("b.w", "b.h", "f.w", "f.h")
            + ") as best from (select row_number() over () as r, w, h from s) b, found f group by r)"
        ),
    ),
    "box_avg_iou": (
        _avg_iou,
        _sql(
            "select round(avg(best), 9) as avg_iou from (select max("
            + _size_iou_sql("w", "h", "aw", "ah")
            + ") as best from (select row_number() over () as r, cast(trunc(xmax) as int) - cast(trunc(xmin) as int) as w, "
            "cast(trunc(ymax) as int) - cast(trunc(ymin) as int) as h from boxes), anchors group by r)",
            _ANCHORS,
        ),
    ),
    "box_augment": (
        _augment,
        _sql(
            "select image, x0 as xmin, y0 as ymin, x1 as xmax, y1 as ymax, label, confidence from clipped "
            "where x1 - x0 > 1 and y1 - y0 > 1 "
            f"qualify row_number() over (partition by image order by {_ORDER}) <= 20",
            _AUGMENT,
        ),
    ),
}
