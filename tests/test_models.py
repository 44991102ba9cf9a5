"""Regression, ratings and components against direct computation and library models."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import PCA as MlPca
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD
from pyspark.sql import functions as F

from brindle.functions.arrays import array_std, fold_block, fold_period, gradient_summand, rescale
from brindle.functions.color import polar_rgb
from brindle.functions.text import half_even_key, percent_label
from brindle.operators import moments, pca, ratings, regression
from brindle.operators.grouping import hash_split

RATED = "user int, item int, rating double"


def test_rating_error_toys(spark):
    predicted = [(1, 1, 5.0), (1, 2, 3.0), (1, 3, 4.0), (2, 1, 3.0), (2, 2, 2.0), (2, 3, 4.0)]
    actual = [(1, 2, 3.0), (1, 3, 5.0), (2, 1, 5.0), (2, 2, 1.0)]
    p, a = spark.createDataFrame(predicted, RATED), spark.createDataFrame(actual, RATED)
    p2 = spark.createDataFrame([(2, 2, 5.0), (1, 2, 5.0)], RATED)
    assert ratings.rating_error(p, a).first()["rmse"] == pytest.approx(1.22474487139)
    assert ratings.rating_error(p2, a).first()["rmse"] == pytest.approx(3.16227766017)
    assert ratings.rating_error(a, a).first()["rmse"] == 0.0


def test_rating_error_repeats_multiply(spark):
    p = spark.createDataFrame([(1, 1, 1.0), (1, 1, 2.0)], RATED)
    a = spark.createDataFrame([(1, 1, 3.0), (1, 1, 5.0), (1, 1, 4.0)], RATED)
    n, rmse = ratings.rating_error(p, a).first()
    assert n == 6
    assert rmse == pytest.approx(math.sqrt(sum((x - y) ** 2 for x in (1, 2) for y in (3, 5, 4)) / 6))


def test_als_beats_the_mean_and_skips_unknown_users(spark):
    rows = [(u, i, float(1 + (u + i) % 5)) for u in range(30) for i in range(20) if (u * i) % 3]
    rated = spark.createDataFrame(rows, RATED)
    model = ratings.train_als(rated, 8)
    error = ratings.rating_error(ratings.predict_pairs(model, rated), rated).first()["rmse"]
    values = np.array([r[2] for r in rows])
    assert error < values.std()
    assert ratings.predict_pairs(model, spark.createDataFrame([(99, 1)], "user int, item int")).isEmpty()


def test_recommendations_are_unrated(spark):
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(40) for i in range(15)]
    rated = spark.createDataFrame(rows, RATED)
    titles = spark.createDataFrame([(i, f"t{i}") for i in range(15)], "item int, title string")
    mine = spark.createDataFrame([(100, 1, 5.0), (100, 2, 1.0)], RATED)
    counts = ratings.counts_and_averages(rated)
    found = ratings.recommend(rated, mine, 100, titles, counts, rank=4, min_ratings=39, k=20).collect()
    assert len(found) == 13
    assert not {"t1", "t2"} & {r["title"] for r in found}
    assert [r["prediction"] for r in found] == sorted((r["prediction"] for r in found), reverse=True)


def test_title_order(spark):
    df = spark.createDataFrame([(3.0625, "b"), (4.0, "a")], "r double, t string")
    keys = [r[0] for r in df.select(half_even_key(F.col("r"), F.col("t"))).collect()]
    assert keys == ["3.062 b", "4.000 a"]


def test_percent_label(spark):
    df = spark.createDataFrame([(6.99,), (7.0,), (90.5,)], "v double")
    assert [r[0] for r in df.select(percent_label(F.col("v"))).collect()] == ["", "7%", "90%"]


def points(spark, rows):
    return spark.createDataFrame(rows, "label double, features array<double>")


def test_rmse_toy(spark):
    df = spark.createDataFrame([(3.0, 1.0), (1.0, 2.0), (2.0, 2.0)], "l double, p double")
    got = df.agg(regression.rmse(F.col("l"), F.col("p"))).first()[0]
    assert got == pytest.approx(1.29099, abs=1e-5)


def test_gradient_toys(spark):
    def summand(w, y, x):
        df = points(spark, [(y, x)])
        return df.select(gradient_summand(F.col("label"), F.col("features"), w)).first()[0]

    assert summand([1, 1, 1], 2.0, [3.0, 1.0, 4.0]) == [18, 6, 24]
    assert summand([0.24, 1.2, -1.4], 3.0, [-1.4, 4.2, 2.1]) == pytest.approx([1.7304, -5.1912, -2.5956])


def test_prediction_toy(spark):
    df = points(spark, [(2.0, [1.0, 0.5]), (1.5, [0.5, 0.5])])
    got = [tuple(r) for r in regression.predict(df, [1.0, 1.5]).collect()]
    assert got == [(2.0, 1.75), (1.5, 1.25)]


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(7)
    x = rng.random((400, 3))
    y = x @ np.array([1.0, -2.0, 3.0]) + 0.5 + rng.normal(0, 0.1, 400)
    df = points(spark, [(float(b), [float(v) for v in a]) for a, b in zip(x, y)])
    return x, y, df.withColumn("split", F.lit(0)).cache()


def test_gradient_descent_scans(line):
    x, y, df = line
    model, errors = regression.gradient_descent(regression.split_moments(df)[0], 50)
    w = np.zeros(3)
    for i in range(50):
        assert errors[i] == pytest.approx(math.sqrt(((y - x @ w) ** 2).mean()))
        w -= (x.T @ (x @ w - y)) / (len(y) * math.sqrt(i + 1))
    assert model.weights == pytest.approx(w)


@pytest.mark.parametrize("reg", [0.1, 1.0, 1e-5])
def test_regularized_descent_is_the_library_model(spark, line, reg):
    x, y, df = line
    wanted = LinearRegressionWithSGD.train(
        spark.sparkContext.parallelize([LabeledPoint(b, a) for a, b in zip(x, y)], 4),
        iterations=500, step=1.0, miniBatchFraction=1.0, initialWeights=np.zeros(3),
        regParam=reg, regType="l2", intercept=True,
    )
    got = regression.regularized_descent(regression.split_moments(df)[0], reg)
    assert got.weights == pytest.approx(wanted.weights.toArray(), abs=1e-9)
    assert got.intercept == pytest.approx(wanted.intercept, abs=1e-9)


def test_grid_search_keeps_the_first_on_a_tie(line):
    m = regression.split_moments(line[2])[0]
    errors, best, model = regression.grid_search(m, m, 0.1, (0.1, 1.0))
    assert best == 0.1 and len(errors) == 3
    assert model.error(m) == pytest.approx(min(e for _, e in errors))


def test_model_error_is_the_scanned_error(line):
    x, y, df = line
    model = regression.LinearModel(np.array([1.0, 0.5, -1.0]), 0.25)
    wanted = math.sqrt(((y - (x @ model.weights + 0.25)) ** 2).mean())
    assert model.error(regression.split_moments(df)[0]) == pytest.approx(wanted)


@pytest.mark.parametrize("d", [3, 20])
def test_moments(spark, d):
    values = np.random.default_rng(d).normal(1000.0, 0.5, (300, d))
    df = spark.createDataFrame([(v.tolist(),) for v in values], "v array<double>").repartition(5)
    m = moments.moments(df.unionByName(df.limit(1).select(F.lit(None).cast("array<double>").alias("v"))), "v")
    assert m.n == 300
    assert m.mean == pytest.approx(values.mean(axis=0))
    assert m.covariance == pytest.approx(np.cov(values.T, bias=True), abs=1e-9)


def test_moments_by_part(spark):
    values = np.random.default_rng(1).random((100, 15))
    df = spark.createDataFrame([(i % 3, v.tolist()) for i, v in enumerate(values)], "p int, v array<double>")
    found = moments.moments_by(df, "v", F.col("p"))
    assert sorted(found) == [0, 1, 2]
    for p, m in found.items():
        some = values[np.arange(100) % 3 == p]
        assert m.outer == pytest.approx(some.T @ some)


def test_pca_is_the_library_pca(spark):
    df = pca.gaussian_points(spark, 500, 50.0, 1.0, 0.9).select("id", "p")
    model = pca.pca(df, "p", 2)
    wanted = MlPca(k=2, inputCol="v", outputCol="s").fit(df.select(array_to_vector("p").alias("v")))
    assert np.abs(model.components) == pytest.approx(np.abs(wanted.pc.toArray()))
    assert model.eigenvalues / model.eigenvalues.sum() == pytest.approx(wanted.explainedVariance.toArray())
    rows = pca.scores(df, "p", model, keep=["id", "p"]).collect()
    assert np.array([r["scores"] for r in rows]) == pytest.approx(np.array([r["p"] for r in rows]) @ model.components)
    assert 0.6 < model.covariance[0, 1] < 1.2


def test_scores_of_null_arrays(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [3.0, 5.0])], "id int, p array<double>")
    got = {r["id"]: r["scores"] for r in pca.scores(df, "p", pca.pca(df, "p", 1), keep=["id"]).collect()}
    assert got[2] is None and len(got[1]) == 1


def test_series_functions(spark):
    values = [float(v) for v in range(1, 13)]
    df = spark.createDataFrame([(values,), ([0.0, 0.0],)], "a array<double>")
    a = F.col("a")
    std, scaled, period, block = df.select(
        array_std(a), rescale(a), fold_period(a, 4), fold_block(a, 4)
    ).first()
    v = np.array(values)
    assert std == pytest.approx(v.std())
    assert scaled == pytest.approx((v - v.mean()) / v.mean())
    assert period == (np.tile(np.eye(4), 3) @ v).tolist()
    assert block == (np.kron(np.eye(3), np.ones(4)) @ v).tolist()
    assert df.select(rescale(a)).collect()[1][0] is None


def test_colors(spark):
    import colorsys

    rng = np.random.default_rng(3)
    rows = [(float(a), float(b)) for a, b in rng.normal(0, 0.3, (50, 2))]
    df = spark.createDataFrame(rows, "a double, b double")
    for a, b, *rgb in df.select("a", "b", *polar_rgb(F.col("a"), F.col("b"), 1.0)).collect():
        phi = ((math.atan2(-a, -b) + math.pi / 2) % (2 * math.pi)) / (2 * math.pi)
        wanted = [min(1.0, c) for c in colorsys.hsv_to_rgb(phi, 1.0, math.hypot(a, b))]
        assert rgb == pytest.approx(wanted)


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000)
    first = {r["id"]: r["split"] for r in hash_split(df, ["id"], [6, 2, 2]).collect()}
    again = {r["id"]: r["split"] for r in hash_split(df.repartition(7), ["id"], [6, 2, 2]).collect()}
    assert first == again
    shares = np.bincount(list(first.values())) / 2000
    assert shares == pytest.approx([0.6, 0.2, 0.2], abs=0.05)


@pytest.mark.parametrize("d", [4, 14])
def test_moments_leave_malformed_vectors_out(spark, d):
    rng = np.random.default_rng(d)
    good = rng.normal(size=(60, d))
    rows = [(0, [float(v) for v in r]) for r in good]
    first = [float(v) for v in good[0]]
    bad = [(0, None), (0, first[:-1]), (0, first + [9.0]), (0, [None, *first[1:]]), (0, []), (0, first[1:]), (0, first + [1.0])]
    df = spark.createDataFrame(bad[:3] + rows + bad[3:], "part int, v array<double>").repartition(5)
    assert tuple(moments.vector_status(df, "v").first()) == (len(rows) + len(bad), len(rows), len(bad))
    found = moments.moments(df, "v")
    assert found.n == len(rows)
    assert found.mean == pytest.approx(good.mean(axis=0))
    assert found.covariance == pytest.approx(np.cov(good.T, bias=True))
    by_part = moments.moments_by(df, "v", F.col("part"))[0]
    assert by_part.outer == pytest.approx(good.T @ good)
    scored = pca.scores(df, "v", pca.pca(df, "v", 2), keep=("part",))
    assert scored.where("scores is null").count() == len(bad)


def test_draws_tell_nulls_apart(spark):
    from brindle.operators.grouping import unit_hash

    rows = [("a", None), (None, "a"), (None, None), ("a", ""), ("", "a")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(unit_hash(F.col("x"), F.col("y")).alias("u")).distinct().count() == len(rows)


def test_cross_validation_is_the_closed_ridge_solution(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = x @ np.array([1.0, -2.0, 0.5]) + rng.normal(size=300) + 3
    rows = [(int(k // 2), float(b), [float(v) for v in a]) for k, (a, b) in enumerate(zip(x, y))]
    points = spark.createDataFrame(rows, "key long, label double, features array<double>")
    regs = [2.0, 0.1, 0.0]
    found = regression.cross_validated(points, 3, regs, ["key"], folds=3)
    folds = [r.fold for r in hash_split(points, ["key"], [1.0] * 3, 7, "fold").orderBy("key").select("key", "fold").distinct().orderBy("key").collect()]
    fold = np.repeat(folds, 2)

    def ridge(a, b, reg):
        near = a - a.mean(0)
        left = near.T @ near / len(b) + reg / b.std() * np.eye(3)
        w = np.linalg.solve(left, near.T @ (b - b.mean()) / len(b))
        return w, b.mean() - a.mean(0) @ w

    wanted = []
    for reg in regs:
        errors = []
        for f in range(3):
            w, c = ridge(x[fold != f], y[fold != f], reg)
            errors.append(np.sqrt(np.mean((x[fold == f] @ w + c - y[fold == f]) ** 2)))
        wanted.append(np.mean(errors))
    assert found.avgMetrics == pytest.approx(wanted)
    w, c = ridge(x, y, regs[int(np.argmin(wanted))])
    assert found.bestModel.stages[-1].coefficients.toArray() == pytest.approx(w)
    assert regression.library_error(found, points, 3) == pytest.approx(np.sqrt(np.mean((x @ w + c - y) ** 2)))


def test_gaussian_draws_do_not_depend_on_partitions(spark):
    def drawn(df):
        return sorted((r.id, *r.p) for r in pca.correlated_pairs(df, ["id"], 50.0, 4.0, 3.0).select("id", "p").collect())

    ids = spark.range(4000)
    once = drawn(ids)
    assert drawn(ids.repartition(13)) == once == drawn(ids.orderBy(F.desc("id")))
    points = np.array([r[1:] for r in once])
    assert points.mean(0) == pytest.approx([50, 50], abs=0.15)
    assert np.cov(points.T) == pytest.approx(np.array([[4.0, 3.0], [3.0, 4.0]]), abs=0.25)
    assert len({r[1] for r in once}) == 4000


def test_wide_vectors_are_filtered_in_their_batches(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(loc=1e6, size=(50, 20))
    rows = [([float(v) for v in r],) for r in good]
    bad = [(None,), ([],), ([1.0] * 19,), ([1.0] * 19 + [None],), ([1.0] * 21,)]
    df = spark.createDataFrame(rows + bad, "v array<double>").repartition(4)
    m = moments.moments(df, "v")
    assert m.n == 50
    assert m.covariance == pytest.approx(np.cov(good.T, bias=True), rel=1e-6, abs=1e-9)


def test_given_folds_need_no_python_per_row(spark):
    """The folds are the hashed ones, and no row goes through Python to be put into them."""
    from pyspark.ml.tuning import CrossValidator

    from brindle.operators import regression

    rows = [(i, i % 3) for i in range(30)]
    data = spark.createDataFrame(rows, "label long, fold int")
    folds = regression._GivenFolds(numFolds=3, foldCol="fold")._kFold(data)
    for i, (train, validation) in enumerate(folds):
        assert sorted(r.label for r in validation.collect()) == [k for k, f in rows if f == i]
        assert sorted(r.label for r in train.collect()) == [k for k, f in rows if f != i]
        assert "Python" not in train._jdf.queryExecution().toString()
    assert issubclass(regression._GivenFolds, CrossValidator)
