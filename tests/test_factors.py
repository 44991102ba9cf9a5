"""Factors of many users against plain NumPy, and trained ones against the library."""

import os

import numpy as np
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.ml.recommendation import ALS

from brindle.operators import als, factors, ratings
from brindle.plans import ratings as plans
from brindle.session import materialize

SF = "/root/testdata/sf0.001"


def brute_force(users, items, rated, k):
    found = []
    for u, x in users:
        scores = sorted((-float(np.dot(x, y)), i) for i, y in items if (u, i) not in rated)
        found += [(u, r, i, round(-s, 9)) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def tables(spark, users, items, rated):
    return (
        spark.createDataFrame(users, "user int, features array<float>"),
        spark.createDataFrame(items, "item int, features array<float>"),
        spark.createDataFrame(rated, "user int, item int"),
    )


def found(*args, **kw):
    return sorted((r.user, r.rank, r.item, round(r.score, 9)) for r in factors.top_items(*args, **kw).collect())


@pytest.mark.parametrize("blocks", [{}, {"block_items": 30, "part_users": 10}, {"block_items": 3, "part_users": 1000}])
def test_top_items_in_blocks(spark, blocks):
    rng = np.random.default_rng(8)
    users = [(u, [float(v) for v in rng.integers(-4, 5, 3)]) for u in range(40)]
    items = [(i, [float(v * (i % 9 + 1)) for v in rng.integers(-3, 4, 3)]) for i in range(100)]  # many ties
    rated = {(int(u), int(i)) for u, i in zip(rng.integers(0, 45, 600), rng.integers(0, 110, 600))}
    rated |= {(7, i) for i in range(95)} | {(8, i) for i in range(100)}  # nearly and quite everything
    wanted = brute_force(users, items, rated, 12)
    assert len([r for r in wanted if r[0] == 7]) <= 5 and not [r for r in wanted if r[0] == 8]
    assert found(*tables(spark, users, items, [*rated, (0, 1), (0, 1)]), k=12, **blocks) == sorted(
        brute_force(users, items, rated | {(0, 1)}, 12)
    )


def test_short_blocks_are_left_out(spark):
    """Blocks of items too short to matter do not change what the first block gave."""
    items = [(i, [100.0 - i, 0.0]) for i in range(20)] + [(i, [0.001, 0.0]) for i in range(20, 400)]
    args = tables(spark, [(1, [1.0, 0.0])], items, [(1, 0)])
    assert [r[2] for r in found(*args, k=3, block_items=20)] == [1, 2, 3]


def test_cells_meet_in_separate_partitions(spark):
    """Both sides of a cell are dealt to the same of many partitions."""
    rng = np.random.default_rng(3)
    users = [(u, rng.normal(size=2).tolist()) for u in range(60)]
    items = [(i, rng.normal(size=2).tolist()) for i in range(80)]
    args = tables(spark, users, items, [(1, 2)])
    users, items = ([(r[0], list(r[1])) for r in t.collect()] for t in args[:2])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(*args, k=4, block_items=9, part_users=11)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute_force(users, items, {(1, 2)}, 4)


def test_no_users_items_or_ratings(spark):
    users, items, rated = tables(spark, [(1, [1.0])], [(2, [1.0])], [(1, 2)])
    assert found(users.where("false"), items, rated) == []
    assert found(users, items.where("false"), rated) == []
    assert found(users, items, rated) == []
    assert found(users, items, rated.where("false")) == [(1, 1, 2, 1.0)]


def test_solved_users(spark):
    rng = np.random.default_rng(2)
    items = [(i, rng.normal(size=4).tolist()) for i in range(30)]
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, 6, 200), rng.integers(0, 33, 200), rng.integers(1, 6, 200))]
    known = dict(items)
    rated = spark.createDataFrame(rows, "user int, item int, rating double")
    solved = factors.solve_users(rated, spark.createDataFrame(items, "item int, features array<double>"), 4, 0.2)
    for row in solved.collect():
        mine = [(known[i], r) for u, i, r in rows if u == row.user and i in known]
        x, y = np.array([m[0] for m in mine]), np.array([m[1] for m in mine])
        assert row.n == len(mine) and row.residual < 1e-9
        assert row.features == pytest.approx(np.linalg.solve(x.T @ x + 0.2 * len(mine) * np.eye(4), x.T @ y).tolist())


def test_trained_factors_solve_their_equations_and_wrong_ones_do_not(spark):
    train = plans.written_parts(spark, SF)[0]
    users, items = ratings.factors_of(ratings.train_als(train, 4))
    off = factors.factor_residuals(train, users, items, 4).agg({"residual": "max"}).first()[0]
    assert off < 1e-4
    wrong = users.selectExpr("user", "transform(features, x -> x * 1.1f) as features")
    assert factors.factor_residuals(train, wrong, items, 4).agg({"residual": "min"}).first()[0] > 0.01


def test_recommendations_for_every_supplier_equal_brute_force(spark):
    train = plans.written_parts(spark, SF)[0]
    users, items = ratings.factors_of(ratings.train_als(train, 4))
    rated = plans.ratings(spark, SF)
    counts = ratings.counts_and_averages(rated)
    many = {r.item: r.n for r in counts.collect() if r.n > 25}
    table = ratings.recommend_all(users, items, train, plans.titles(spark, SF), counts, 25, 20, block_items=50)
    got = sorted((r.user, r["rank"], r.item, round(r.prediction, 9)) for r in table.collect())
    known = [(r.item, r.features) for r in items.collect() if r.item in many]
    pairs = {(r.user, r.item) for r in train.collect()}
    wanted = brute_force([(r.user, r.features) for r in users.collect()], known, pairs, 20)
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in wanted])


def test_errors_of_all_ranks_come_from_one_pass(spark, monkeypatch):
    """The error of every rank is that of its predictions; pairs are not predicted rank by rank."""
    rng = np.random.default_rng(4)
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, 30, 900), rng.integers(0, 40, 900), rng.integers(1, 6, 900))]
    train = spark.createDataFrame(rows[:600], "user int, item int, rating double")
    # repeated pairs, unknown keys and a missing rating
    more = [*rows[600:], rows[700], (*rows[701][:2], 1.0), (99, 1, 3.0), (1, 99, 2.0), (3, 4, None)]
    validation = spark.createDataFrame(more, "user int, item int, rating double")
    predict = ratings.predict_pairs
    monkeypatch.setattr(ratings, "predict_pairs", lambda *a: pytest.fail("predicted rank by rank"))
    found = ratings.rank_search(train, validation, (2, 3))
    assert [f[0] for f in found] == [2, 3]
    for _, error, model in found:
        predicted = predict(model, validation.select("user", "item").distinct())
        assert error == pytest.approx(ratings.rating_error(predicted, validation).first()["rmse"], rel=1e-6)
    assert [f[1] for f in ratings.rank_search(train, validation.where("user = 99"), (2,))] == [None]


def library_model(rated, rank, blocks, iterations=5):
    return ALS(
        userCol="user", itemCol="item", ratingCol="rating", rank=rank, maxIter=iterations, regParam=0.1, seed=5,
        numUserBlocks=blocks, numItemBlocks=blocks, coldStartStrategy="drop",
    ).fit(rated)


@pytest.mark.parametrize("small", [False, True])
def test_trained_model_is_that_of_the_library(spark, monkeypatch, small):
    """Also with many blocks, and with extreme ids, repeated pairs and unknown ids."""
    if small:
        monkeypatch.setattr(als, "BLOCK_IDS", 7)
    rng = np.random.default_rng(6)
    rows = [(int(u) * 7 - 50, int(i), float(r)) for u, i, r in zip(rng.integers(0, 40, 900), rng.integers(0, 50, 900), rng.normal(size=900))]
    rows += [(2**31 - 1, -(2**31), 4.0), (2**31 - 1, 3, 1.0), (-(2**31), 3, 2.0), rows[0]]
    rated = spark.createDataFrame(rows, "user int, item int, rating double").repartition(3)
    models = als.train(rated, (2, 5), 5, 0.1, 5)
    assert (max(models[0].blocks) > 4) == small
    for model in (*models, ratings.train_als(rated, 2)):
        known = library_model(rated, model.rank, max(10, spark.sparkContext.defaultParallelism))
        for name in ("userFactors", "itemFactors"):
            mine, wanted = ({r.id: list(r.features) for r in getattr(m, name).collect()} for m in (model, known))
            assert mine.keys() == wanted.keys()
            for key in wanted:
                assert mine[key] == pytest.approx(wanted[key], rel=1e-4, abs=1e-5)
        pairs = spark.createDataFrame([r[:2] for r in rows[:80]] + [(9999, 1), (-50, 9999), rows[0][:2]], "user int, item int")
        found = sorted(map(tuple, ratings.predict_pairs(model, pairs).collect()))
        wanted = sorted(map(tuple, known.transform(pairs).selectExpr("user", "item", "double(prediction)").collect()))
        assert [f[:2] for f in found] == [w[:2] for w in wanted] and len(found) == 81
        assert [f[2] for f in found] == pytest.approx([w[2] for w in wanted], rel=1e-4, abs=1e-5)


@pytest.mark.parametrize("row", [(None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan")), (1 << 40, 1, 1.0)])
def test_rows_that_the_library_refuses(spark, row):
    rated = spark.createDataFrame([(1, 2, 3.0), row], "user long, item long, rating double")
    with pytest.raises(SparkRuntimeException):
        ratings.train_als(rated, 2)
    with pytest.raises(ValueError):
        ratings.train_als(rated.where("false"), 2)


def test_iterations_exchange_nothing(spark, monkeypatch):
    """Neither ratings nor factors travel again, however large Spark takes them to be."""
    rng = np.random.default_rng(1)
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, 30, 900), rng.integers(0, 50, 900), rng.integers(1, 6, 900))]
    rated = spark.createDataFrame(rows, "user int, item int, rating double")
    monkeypatch.setattr(als, "LEAST_RATINGS", 300)
    plans_of = {}

    def written(df, name, *by):
        plans_of.setdefault(name, []).append((df.rdd.getNumPartitions(), df._jdf.queryExecution().executedPlan().toString()))
        return materialize(df, name, *by)

    monkeypatch.setattr(als, "materialize", written)
    spark.conf.set("spark.sql.maxSinglePartitionBytes", "1")
    try:
        model = als.train(rated, (3,), 2, 0.1, 5)[0]
        cells = als._cells(rated.withColumnRenamed("rating", "value"), model.blocks, "double")
        met = als._meet(cells, model.users, model.blocks[1], model.items)
        assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString() and met.rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset("spark.sql.maxSinglePartitionBytes")
    steps = plans_of["item-factors"] + plans_of["user-factors"]
    assert len(steps) == 4 and all(n == 3 and "Exchange" not in plan for n, plan in steps)


def test_written_factors_of_former_iterations_are_deleted(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(als, "materialize", lambda *a: kept.append(materialize(*a)) or kept[-1])
    model = als.train(spark.createDataFrame([(1, 2, 3.0), (2, 2, 1.0)], "user int, item int, rating double"), (2,), 4, 0.1, 5)[0]
    there = [t for t in kept if os.path.exists(t._written_to.removeprefix("file:"))]
    assert there == [model.items, model.users] and len(kept) > 8


def test_sums_in_pieces(monkeypatch):
    """Sums do not depend on the pieces in which entries come."""
    for name, value in {"_SUM_ROWS": 13, "_LONG": 3, "_SOLVE_IDS": 4}.items():
        monkeypatch.setattr(als, name, value)
    rng = np.random.default_rng(9)
    own = rng.integers(-2000, 2000, 5000).astype(np.int32)
    own[:800] = 7
    x, rating = rng.normal(size=(5000, 5)).astype(np.float32), rng.normal(size=5000).astype(np.float32)
    sums = als._Sums((2, 3))
    for a, b in ((0, 5), (5, 900), (900, 5000)):
        order = np.argsort(own[a:b], kind="stable") + a
        sums.add(own[order], x[order], rating[order])
    found = sums.solve(0.3)
    assert sums.ids.tolist() == sorted(set(own.tolist())) and len(sums.ids) > 1024
    for at, key in enumerate(sums.ids):
        mine = own == key
        for b, e in ((0, 2), (2, 5)):
            y = x[mine, b:e].astype(float)
            wanted = np.linalg.solve(y.T @ y + 0.3 * mine.sum() * np.eye(e - b), y.T @ rating[mine].astype(float))
            assert found[at, b:e] == pytest.approx(wanted, rel=1e-4, abs=1e-6)


def test_cells_give_back_their_entries():
    rng = np.random.default_rng(2)
    own, other = (rng.integers(-(2**31), 2**31, 500).astype(np.int32) for _ in range(2))
    part, of = (rng.integers(0, n, 500).astype(np.int32) for n in (3, 4))
    value = rng.normal(size=500)
    cells = als._cells_of(part, of, own, other, value)
    assert cells.num_rows == 12
    found = []
    for row in als._rows(cells):
        mine = als._entries(row, np.float64)
        assert (np.diff(mine[0].astype(np.int64)) >= 0).all()
        found += [(row["part"].as_py(), row["of"].as_py(), *map(float, e)) for e in zip(*mine)]
    assert sorted(found) == sorted((int(p), int(o), *map(float, e)) for p, o, *e in zip(part, of, own, other, value))
