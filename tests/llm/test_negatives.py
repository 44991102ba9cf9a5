import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import negatives
from brindle.llm.negatives import Anchor, Bucket

SCHEMA = "id long, label long, v array<long>"


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_force(rows, every=100, positives=5, most=10, percent=(30, 90)):
    found = []
    for at, (i, label, v) in enumerate(rows):
        if i % every:
            continue
        scores = [(-dot(v, w), j, k) for k, (j, _, w) in enumerate(rows)]
        same = sorted(s for s in scores if rows[s[2]][1] == label and s[2] != at)[:positives]
        other = sorted(s for s in scores if rows[s[2]][1] != label)
        for score, j, _ in same:
            fits = [s for s in other if percent[0] * -score <= 100 * -s[0] <= percent[1] * -score][:most]
            found += [(i, j, r, s[1], -score, -s[0]) for r, s in enumerate(fits, 1)]
    return sorted(found)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clashing = df.selectExpr("*", "1 as place", "2 as norm", "'x' as score", "3 as part", "4 as `group`")
    return sorted(tuple(r) for r in negatives.mine_negatives(clashing, **kw).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_random_vectors_in_small_cells(spark, seed):
    rng = np.random.default_rng(seed)
    length = rng.exponential(40, 700) + 1
    vectors = (rng.normal(size=(700, 8)) * length[:, None]).astype(int).tolist()
    labels = np.where(rng.random(700) < 0.4, 0, rng.integers(0, 6, 700)).tolist()
    rows = list(zip(range(700), labels, vectors))
    wanted = brute_force(rows, every=20)
    assert len(wanted) > 500
    assert mined(spark, rows, every=20, group_rows=90, part_anchors=7) == wanted
    assert mined(spark, rows, every=20) == wanted


def test_ties_repeats_zeros_and_short_vectors(spark):
    rows = [(i, i % 3, [i % 5, 7, -(i % 2)][: 1 + i % 3]) for i in range(60)]
    rows += [(0, 0, [1, 2]), (0, 1, [1, 2]), (7, 1, [1, 7, -1]), (7, 1, [1, 7, -1]), (-10, 2, [0, 0, 0]), (70, 2, []), (80, 9, [50, 50, 50])]
    rows += [(90, 4, [-5, 1]), (91, 4, [5, 0])]
    for kw in (dict(every=10), dict(every=10, group_rows=4, part_anchors=2), dict(every=1, positives=2, negatives=3)):
        brute = {("most" if k == "negatives" else k): v for k, v in kw.items() if k not in ("group_rows", "part_anchors")}
        assert mined(spark, rows, **kw) == brute_force(rows, **brute)
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1])]) == mined(spark, [(100, 1, [1])]) == []


def test_which_rows_take_part(spark):
    rows = [
        (1, [0.5, -0.001], 1),
        (2, [0.5, None], 1),
        (3, [0.5, math.nan], 1),
        (4, [math.inf, 1.0], 1),
        (5, None, 1),
        (6, [1.0, 1.0], None),
        (None, [1.0, 1.0], 1),
        (7, [], 2),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("v", F.lit("clash"))
    assert [tuple(r) for r in negatives.whole_vectors(df).orderBy("id").collect()] == [(1, 1, [128, -1]), (7, 2, [])]


def test_large_numbers_are_exact(spark):
    big = 1 << 30
    rows = [(0, 0, [big, 1]), (1, 0, [big, 3]), (2, 0, [big, 2]), (3, 1, [big // 2, 5]), (4, 1, [big // 2, 4])]
    assert mined(spark, rows) == brute_force(rows)


def test_pruned_rows_score_less():
    """Whatever a bucket leaves out scores less than asked for; of rows of one length it leaves out most."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    vectors = centres[rng.integers(0, 20, 400)] + 0.2 * rng.normal(size=(400, 16))
    vectors = (1000 * vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.int64)
    bucket = Bucket(np.arange(400), np.arange(400), np.zeros(400, np.int64), vectors)
    verified = []
    for a, share in itertools.product(range(0, 400, 10), (0.0, 0.8, 0.9, 1.0)):
        anchor = Anchor(vectors[a])
        scores = vectors @ vectors[a]
        least = share * scores.max()
        rows = anchor.candidates(bucket, least)
        assert set(np.flatnonzero(scores >= least)) <= set(rows)
        verified.append(len(rows) if share else 0)
        assert anchor.candidates(bucket, anchor.norm * bucket.longest * 1.01) is None
    assert np.mean(verified) < 100
