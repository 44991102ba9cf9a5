"""Boxes, suppression, anchors and grouping helpers against plain Python."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.functions.boxes import compact_category, corners, iou, numbered_name, round_half_even
from brindle.functions.text import basename, rebase_path
from brindle.operators import boxes as ops, detection
from brindle.operators.grouping import global_index, group_index

SCHEMA = "image string, xmin double, ymin double, xmax double, ymax double, label string, confidence double"
ORDER = ["xmin", "ymin", "xmax", "ymax", "label", "confidence"]


def draw(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for image, n in sizes.items():
        for _ in range(n):
            x, y = rng.randint(0, 60), rng.randint(0, 60)
            rows.append(
                (image, float(x), float(y), float(x + rng.randint(1, 40)), float(y + rng.randint(1, 40)),
                 rng.choice("ab"), rng.randint(0, 20) / 20)
            )
    return rows


def overlap(a, b):
    wide = max(0.0, min(a[2], b[2]) - max(a[0], b[0]))
    high = max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - wide * high
    return wide * high / union if union else 0.0


def suppressed(rows, threshold, most, score=0.25):
    groups = defaultdict(set)
    for r in rows:
        if r[6] >= score:
            groups[r[0], r[5]].add(r)
    kept = []
    for group in groups.values():
        best = []
        for r in sorted(group, key=lambda r: (-r[6], r[1:5])):
            if len(best) < most and all(overlap(k[1:5], r[1:5]) <= threshold for k in best):
                best.append(r)
        kept += best
    return sorted(kept)


@pytest.mark.parametrize("group_rows", [256, 5])
@pytest.mark.parametrize("threshold,most", [(0.45, 20), (0.1, 3), (0.9, 8)])
def test_suppression(spark, group_rows, threshold, most):
    rows = draw(1, {"hot": 300, "one": 1, "few": 9})
    df = spark.createDataFrame(rows + rows[:20], SCHEMA).repartition(6)
    found = detection.non_max_suppression(
        df, iou_threshold=threshold, max_boxes=most, group_rows=group_rows
    )
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect())) == suppressed(rows, threshold, most)


def test_iou(spark):
    df = spark.createDataFrame([((0.0, 0.0, 2.0, 2.0), (1.0, 1.0, 3.0, 3.0)), ((0.0,) * 4, (1.0,) * 4)],
        "a struct<xmin:double,ymin:double,xmax:double,ymax:double>, b struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    got = [r[0] for r in df.select(iou(corners(F.col("a")), corners(F.col("b")))).collect()]
    assert got[0] == pytest.approx(1 / 7) and got[1] is None


def kmedians(sizes, centres, rounds):
    """Whole-number medians by same-centre overlap."""
    centres = np.array(centres)
    for _ in range(rounds):
        inter = np.minimum(sizes[:, None], centres[None]).prod(axis=2)
        share = inter / (sizes.prod(axis=1)[:, None] + centres.prod(axis=1)[None] - inter)
        near = share.argmax(axis=1)
        new = centres.copy()
        for c in range(len(centres)):
            if (near == c).any():
                new[c] = np.median(sizes[near == c], axis=0)
        if (new == centres).all():
            break
        centres = new
    return sorted(map(tuple, centres.tolist())), share.max(axis=1).mean()


def test_anchor_clusters(spark):
    rows = draw(5, {"i": 400})
    df = spark.createDataFrame(rows, SCHEMA)
    first = detection.first_centres(detection.box_sizes(df), 5, 3)
    sizes = np.array([(int(r[3]) - int(r[1]), int(r[4]) - int(r[2])) for r in rows])
    wanted, mean = kmedians(sizes, first, 100)
    got = detection.cluster_anchors(df, 5, 3)
    assert got == wanted
    assert detection.average_iou(df, got).first()[0] == pytest.approx(mean)
    with pytest.raises(ValueError):
        detection.cluster_anchors(df.limit(1), 5)


def test_group_index_hot_and_cold(spark):
    rows = draw(2, {"hot": 200, "a": 7, "b": 1})
    df = spark.createDataFrame(rows, SCHEMA).dropDuplicates()
    plain = sorted(map(tuple, group_index(df, ["image"], ORDER).collect()))
    split = sorted(map(tuple, group_index(df.repartition(5), ["image"], ORDER, max_rows=20).collect()))
    assert plain == split
    hot = sorted(r[-1] for r in plain if r[0] == "hot")
    assert hot == list(range(len(hot)))


def test_global_index(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("v")).repartition(6)
    assert all(r["v"] == r["idx"] for r in global_index(df, ["v"]).collect())


def test_null_keys_are_groups(spark):
    """Also when they are the large ones."""
    rows = [(None, float(i)) for i in range(200)] + [("a", float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    for most in (1000, 20):
        found = group_index(df, ["k"], ["v"], max_rows=most).collect()
        assert sorted((str(r["k"]), r["v"], r["idx"]) for r in found) == sorted((str(k), v, int(v)) for k, v in rows)
    boxes = [(None, *r[1:]) for r in draw(5, {"x": 80})]
    df = spark.createDataFrame(boxes, SCHEMA)
    plain, rounds = (
        sorted(map(str, detection.non_max_suppression(df, group_rows=n).collect())) for n in (256, 5)
    )
    assert plain == rounds and plain


def test_lines_in_parts_are_the_whole_line(spark):
    from brindle.sources.annotations import parse_training_lines

    rows = draw(3, {"hot.jpg": 120, "a.jpg": 4})
    df = ops.rounded(spark.createDataFrame(rows, SCHEMA).dropDuplicates()).withColumn("code", F.lit(1))

    def lists(most):
        found = defaultdict(list)
        for r in ops.training_lines(df, ORDER, max_boxes=most).orderBy("image", "part").collect():
            name, *boxes = r["line"].split(" ")
            assert name == r["image"] and len(boxes) <= most
            assert r["part"] == len(found[name]) // most
            found[name] += boxes
        return found

    assert lists(25) == lists(1000)
    lines = ops.training_lines(df.withColumn("p", F.concat(F.lit("/x/"), "image")), ORDER, path_column="p")
    assert {r["image"] for r in lines.collect()} == {"/x/hot.jpg", "/x/a.jpg"}
    names = spark.createDataFrame([("/x/a.jpg",), ("/x/none.jpg",)], "image string")
    bare = ops.add_bare_images(lines, names).where("image = '/x/none.jpg'").collect()
    assert [(r["part"], r["line"]) for r in bare] == [(0, "/x/none.jpg")]
    back = parse_training_lines(ops.training_lines(df, ORDER, max_boxes=25).select(F.col("line").alias("value")))
    want = df.select("image", "xmin", "ymin", "xmax", "ymax", "code")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))


def test_crop_labels_by_code_or_text(spark):
    for label, kind in ((0, "int"), ("0", "string"), ("cat", "string")):
        df = spark.createDataFrame([("pic.jpg", 1.0, label)], f"image string, xmin double, label {kind}")
        crop = ops.crop_names(df, ["xmin"], labels={0: "house"}).first()["crop"]
        assert crop == f"pic_cropped_{'cat' if label == 'cat' else 'house'}_0.jpg"


def test_anchors_that_never_settle_are_an_error(spark):
    rows = draw(6, {f"i{k}": 40 for k in range(5)})
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(RuntimeError):
        detection.cluster_anchors(df, 9, max_rounds=1)


def test_codes_by_first_appearance(spark):
    df = spark.createDataFrame([(2, "cat"), (1, "dog"), (3, "ant"), (4, "dog")], "pos int, label string")
    codes = {r["label"]: r["code"] for r in ops.class_codes(df, ["pos"]).collect()}
    assert codes == {"dog": 0, "cat": 1, "ant": 2}
    assert {r["code"] for r in ops.encode(df, ops.class_codes(df, ["pos"])).collect()} == {0, 1, 2}


def test_scalars(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-0.5,)], "v double")
    assert [r[0] for r in df.select(round_half_even(F.col("v"))).collect()] == [2, 4, 0]
    df = spark.createDataFrame([(1,), (13,), (12,), (70,), (90,)], "c int")
    assert [r[0] for r in df.select(compact_category(F.col("c"))).collect()] == [0, 11, 12, 61, 79]
    assert df.select(numbered_name("f/", F.col("c"))).first()[0] == "f/000000000001.jpg"
    df = spark.createDataFrame([("C:\\a\\repo\\x\\y.jpg\n",), ("/z/other.jpg",)], "p string")
    got = df.select(rebase_path(F.col("p"), "repo/", "/m"), basename(F.lit("/q/r.jpg\n"))).collect()
    assert got[0][0] == "/m/repo/x/y.jpg\n" and got[0][1] == "r.jpg" and got[1][0] is None


def test_letterbox_and_back(spark):
    df = spark.createDataFrame([("i", 10.0, 20.0, 110.0, 60.0, 400, 200)],
        "image string, xmin double, ymin double, xmax double, ymax double, x_size int, y_size int")
    got = detection.letterbox(df, (416, 416)).first()
    # scale 1.04, 104 rows of padding above
    assert tuple(got)[1:5] == (10, 124, 114, 166)
    shares = detection.input_shares(detection.letterbox(df, (416, 416)), (416, 416))
    back = detection.unletterbox(shares, (416, 416)).first()
    assert tuple(back)[1:5] == pytest.approx((10, 20, 110, 60), abs=1.0)


def test_augmented_boxes_stay_inside(spark):
    rows = [(*r, 80, 90) for r in draw(4, {f"i{k}": 30 for k in range(10)})]
    df = spark.createDataFrame(rows, SCHEMA + ", x_size int, y_size int")
    drawn = detection.draw_augmentation(df, seed=9)
    assert drawn.groupBy("image").agg(F.countDistinct("nw", "nh", "dx", "dy", "flip").alias("n")).where("n > 1").isEmpty()
    found = detection.augment(drawn, ORDER)
    for r in found.collect():
        assert 0 <= r["xmin"] < r["xmax"] <= 416 and 0 <= r["ymin"] < r["ymax"] <= 416
    assert found.groupBy("image").count().agg(F.max("count")).first()[0] <= 20
    again = detection.augment(detection.draw_augmentation(df.repartition(7), seed=9), ORDER)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))


def test_two_layer_anchors(spark):
    df = spark.createDataFrame([("i", 0.0, 0.0, 80.0, 80.0, 0), ("i", 5.0, 5.0, 5.0, 9.0, 0)],
        "image string, xmin double, ymin double, xmax double, ymax double, code int")
    tiny = [(10, 14), (23, 27), (37, 58), (81, 82), (135, 169), (344, 319)]
    got = detection.assign_anchors(df, tiny).collect()
    # the fourth anchor belongs to both layers
    assert sorted((r["layer"], r["slot"]) for r in got) == [(0, 0), (1, 2)]
    assert {(r["layer"], r["i"], r["j"]) for r in got} == {(0, 1, 1), (1, 2, 2)}
