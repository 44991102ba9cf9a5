"""Factors of many users at once: normal equations per user, and the best items for every user."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from brindle.operators.grouping import global_index
from brindle.session import materialize

_SLACK = 1e-9  # of rounding in the bound on a score
_CHUNK = 256  # users whose scores against a block of items are held at a time


def normal_equations(ratings: DataFrame, items: DataFrame, d: int) -> DataFrame:
    """`user, n, products, target`: sums of the products `x_i x_j` (row by row, `d * d` of them) and of
    `rating * x` over a user's rated items.

    `ratings(user, item, rating)`, `items(item, features)` with `d` features. Sums are combined before
    the shuffle, so a user who rates much is no hot group; ratings of other items are left out.
    """
    joined = ratings.join(items.select("item", "features"), "item")
    x = [F.col("features")[i].cast("double") for i in range(d)]
    sums = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    targets = [F.sum(F.col("rating") * x[i]).alias(f"t{i}") for i in range(d)]
    found = joined.groupBy("user").agg(F.count(F.lit(1)).alias("n"), *sums, *targets)
    return found.select(
        "user",
        "n",
        F.array(*[F.col(f"p{min(i, j)}_{max(i, j)}") for i in range(d) for j in range(d)]).alias("products"),
        F.array(*[F.col(f"t{i}") for i in range(d)]).alias("target"),
    )


def _square(batch: pa.RecordBatch, column: str, *shape: int) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(batch.num_rows, *shape)


def solve_users(ratings: DataFrame, items: DataFrame, d: int, reg: float = 0.1) -> DataFrame:
    """`user, n, features, residual`: the half step of alternating least squares for fixed item factors.

    The penalty is `reg * n` as in `ratings.train_als`. `residual` is the largest absolute entry of
    the normal equations at the solution.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = _square(batch, "products", d, d), _square(batch, "target", d)
            n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.float64)
            left = left + reg * n[:, None, None] * np.eye(d)
            found = np.linalg.solve(left, right[:, :, None])[:, :, 0]
            off = np.abs((left @ found[:, :, None])[:, :, 0] - right).max(axis=1, initial=0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("user"), batch.column("n"), pa.array(list(found), pa.list_(pa.float64())), pa.array(off)],
                ["user", "n", "features", "residual"],
            )

    equations = normal_equations(ratings, items, d)
    user = equations.schema["user"].dataType.simpleString()
    return equations.mapInArrow(run, f"user {user}, n long, features array<double>, residual double")


def factor_residuals(ratings: DataFrame, users: DataFrame, items: DataFrame, d: int, reg: float = 0.1) -> DataFrame:
    """`user, n, residual`: how far given user factors are from solving their normal equations, as a
    share of the largest entry of the right side."""
    u = [F.col("features")[i].cast("double") for i in range(d)]
    row = [sum((F.col("products")[i * d + j] * u[j] for j in range(d)), reg * F.col("n") * u[i]) for i in range(d)]
    off = F.greatest(F.lit(0.0), *[F.abs(row[i] - F.col("target")[i]) for i in range(d)])
    size = F.greatest(F.lit(1e-12), *[F.abs(F.col("target")[i]) for i in range(d)])
    equations = normal_equations(ratings, items, d).join(users.select("user", "features"), "user")
    return equations.select("user", "n", (off / size).alias("residual"))


def _norm(column: str):
    return F.sqrt(F.aggregate(column, F.lit(0.0), lambda s, x: s + x * x))


def _matrix(table: pa.Table) -> np.ndarray:
    rows = table.column("features").to_pylist()
    return np.array(rows, np.float64).reshape(len(rows), -1) if rows else np.zeros((0, 1))


def _scores(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Inner products, summed in the order of the factors: equal factors have equal scores."""
    total = np.zeros((len(users), len(items)))
    for j in range(items.shape[1]):
        total += users[:, j, None] * items[None, :, j]
    return total


def _best_of_cell(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The `k` best unrated items of a block for every user of a part."""
    items = left.sort_by("place")
    places, ids, x = items.column("place").to_numpy(), items.column("item").to_numpy(), _matrix(items)
    asked = right.filter(pa.compute.is_null(right.column("place"))).sort_by("user")
    rated = right.filter(pa.compute.is_valid(right.column("place")))
    users, u = asked.column("user").to_numpy(), _matrix(asked)
    least = asked.column("least").to_numpy()
    seen_user = rated.column("user").to_numpy()
    at = np.minimum(np.searchsorted(users, seen_user), max(len(users) - 1, 0))
    here = users[at] == seen_user if len(users) else np.zeros(len(seen_user), bool)
    seen_user, seen_item = at[here], np.searchsorted(places, rated.column("place").to_numpy()[here])
    by = np.argsort(seen_user, kind="stable")
    seen_user, seen_item = seen_user[by], seen_item[by]
    found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
    for a in range(0, len(users) if len(ids) else 0, _CHUNK):
        scores = _scores(u[a : a + _CHUNK], x)
        mine = slice(*np.searchsorted(seen_user, [a, a + _CHUNK]))
        scores[seen_user[mine] - a, seen_item[mine]] = -np.inf
        bound = least[a : a + _CHUNK]
        if scores.shape[1] > k:
            bound = np.maximum(bound, -np.partition(-scores, k - 1, axis=1)[:, k - 1])
        who, what = np.nonzero((scores >= bound[:, None]) & (scores > -np.inf))
        order = np.lexsort((ids[what], -scores[who, what], who))
        who, what = who[order], what[order]
        first = np.searchsorted(who, np.arange(len(bound)))
        kept = np.arange(len(who)) - first[who] < k
        found.append((users[who[kept] + a], ids[what[kept]], scores[who[kept], what[kept]]))
    columns = [np.concatenate(c) for c in zip(*found)]
    return pa.table([pa.array(c) for c in columns], names=["user", "item", "score"])


def top_items(
    users: DataFrame,
    items: DataFrame,
    rated: DataFrame,
    k: int = 20,
    block_items: int = 4096,
    part_users: int = 16_384,
) -> DataFrame:
    """`user, rank, item, score`: for every user the `k` items of the largest inner product, exactly.

    `users(user, features)`, `items(item, features)`, both with unique whole-number keys; pairs of
    `rated(user, item)` are left out. Equal scores are ordered by item. Items are dealt into blocks by
    falling length. All users meet the first block; by the inequality of Cauchy and Schwarz a user
    then only meets the blocks that are long enough to beat the `k`-th score found so far. A cell of a
    block and about `part_users` users with their rated items of that block is what a task holds.
    """
    whole = "transform(features, x -> double(x))"
    items = items.select(F.col("item").cast("long").alias("item"), F.expr(whole).alias("features"))
    placed = global_index(items.withColumn("norm", _norm("features")), [F.desc("norm"), "item"], "place")
    placed = materialize(placed.withColumn("block", F.expr(f"place div {block_items}")), "items-by-length")
    lengths = placed.groupBy("block").agg(F.max("norm").alias("norm")).orderBy("block").collect()  # one per block
    users = materialize(
        users.select(
            F.col("user").cast("long").alias("user"),
            F.expr(whole).alias("features"),
        ).withColumn("norm", _norm("features")),
        "users",
    )
    parts = max(1, -(-users.count() // part_users))
    part = F.pmod(F.xxhash64("user"), F.lit(parts)).cast("int").alias("part")  # of the type of `piece` below
    seen = rated.select(F.col("user").cast("long").alias("user"), F.col("item").cast("long").alias("item")).distinct()
    seen = materialize(seen.join(placed.select("item", "place", "block"), "item"), "rated-places")
    seen = seen.select(
        part, F.col("block").alias("of"), "user", F.lit(None).cast("array<double>").alias("features"),
        F.lit(None).cast("double").alias("least"), "place",
    )

    def meet(asked: DataFrame, blocks) -> DataFrame:
        """The best items of the blocks that `asked(of, user, features, least)` names."""
        rows = asked.select(part, "of", "user", "features", "least", F.lit(None).cast("long").alias("place"))
        right = rows.unionByName(seen.where(blocks(F.col("of"))))
        dealt = placed.where(blocks(F.col("block"))).withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        cells = dealt.groupBy("block", "piece").cogroup(right.groupBy("of", "part"))
        return cells.applyInArrow(
            lambda left, right: _best_of_cell(left, right, k), "user long, item long, score double"
        )

    lowest = F.lit(float("-inf"))
    start = users.select(F.lit(0).cast("long").alias("of"), "user", "features", lowest.alias("least"))
    first = materialize(meet(start, lambda b: b == 0), "first-best")
    order = Window.partitionBy("user").orderBy(F.desc("score"), "item")
    if len(lengths) > 1:
        kth = first.groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
        bounds = F.array(*[F.lit(float(r["norm"])) for r in lengths[1:]])
        least = F.when(F.col("n") >= k, F.col("score")).otherwise(lowest)
        open_ = users.join(kth, "user", "left").withColumn("least", least)
        reach = F.size(F.filter(bounds, lambda b: b * F.col("norm") * (1 + _SLACK) >= F.col("least"))).cast("long")
        more = open_.withColumn("reach", reach).where("reach > 0")
        more = more.withColumn("of", F.explode(F.sequence(F.lit(1).cast("long"), F.col("reach"))))
        first = first.unionByName(meet(more, lambda b: b > 0))
    ranked = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("user", "rank", "item", "score")
