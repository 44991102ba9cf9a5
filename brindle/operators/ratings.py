"""Rating analytics and recommendation by alternating least squares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brindle.operators import als
from brindle.operators.factors import top_items

PAIR = ["user", "item"]


def counts_and_averages(ratings: DataFrame) -> DataFrame:
    """`item, n, avg_rating`."""
    return ratings.groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), F.avg("rating").alias("avg_rating")
    )


def top_titles(ratings: DataFrame, titles: DataFrame, min_ratings: int = 500, k: int = 20) -> DataFrame:
    """Best rated titles with more than `min_ratings` ratings.

    Ordered as the text `'%.3f title'`, descending: the average is rounded half to even first.
    """
    rated = counts_and_averages(ratings).where(F.col("n") > min_ratings)
    return (
        rated.join(titles.select("item", "title"), "item")
        .orderBy(F.desc(F.bround("avg_rating", 3)), F.desc("title"), "item")
        .limit(k)
        .select("avg_rating", "title", "n")
    )


def average_pairs(ratings: DataFrame) -> DataFrame:
    """One rating per user and item: the mean."""
    return ratings.groupBy(*PAIR).agg(F.avg("rating").alias("rating"))


def _moments(table: DataFrame, suffix: str) -> DataFrame:
    r = F.col("rating").cast("double")
    return table.groupBy(*PAIR).agg(
        F.count(r).alias(f"n_{suffix}"),
        F.sum(r).alias(f"s_{suffix}"),
        F.sum(r * r).alias(f"q_{suffix}"),
    )


def rating_error(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """RMSE over the join of two rating tables on user and item; repeats multiply.

    Both sides are summed per pair first, so repeated pairs never meet row by row.
    """
    joined = _moments(predicted, "p").join(_moments(actual, "a"), PAIR)
    squares = (
        F.col("n_a") * F.col("q_p")
        - 2 * F.col("s_p") * F.col("s_a")
        + F.col("n_p") * F.col("q_a")
    )
    n = F.sum(F.col("n_p") * F.col("n_a"))
    # rounding may leave a sum of squares just below zero
    total = F.greatest(F.sum(squares), F.lit(0.0))
    return joined.agg(n.alias("n"), F.sqrt(F.try_divide(total, n)).alias("rmse"))


def add_ratings(base: DataFrame, new: DataFrame) -> DataFrame:
    """Bag union of rating tables."""
    return base.select(*PAIR, "rating").unionByName(new.select(*PAIR, "rating"))


def unrated_items(items: DataFrame, ratings: DataFrame, user: int) -> DataFrame:
    """`user, item` for every item the user has not rated."""
    mine = ratings.where(F.col("user") == user).select("item")
    return items.select("item").join(mine, "item", "left_anti").select(
        F.lit(user).cast("int").alias("user"), "item"
    )


def train_als(
    ratings: DataFrame, rank: int, iterations: int = 5, reg: float = 0.1, seed: int = 5
) -> als.FactorModel:
    """Explicit-feedback ALS, the model that the library trains."""
    return als.train(ratings.select(*PAIR, "rating"), [rank], iterations, reg, seed)[0]


def predict_pairs(model: als.FactorModel, pairs: DataFrame) -> DataFrame:
    """`user, item, rating` predicted for pairs; unknown users and items are absent."""
    return als.predict(model, pairs.select(*PAIR))


def rank_search(
    train: DataFrame, validation: DataFrame, ranks: Sequence[int] = (4, 8, 12), iterations: int = 5, reg: float = 0.1, seed: int = 5
) -> list[tuple[int, float, als.FactorModel]]:
    """Rank, validation RMSE and model for every rank; the best has the smallest error.

    The models are those of `train_als`, trained together; `train` is read more than once, so it should be a
    written table. The error is `rating_error` of `predict_pairs`, for all ranks in one pass.
    """
    models = als.train(train.select(*PAIR, "rating"), ranks, iterations, reg, seed)
    return list(zip(ranks, als.errors(models, validation), models))


def best_rank(found: Sequence[tuple[int, float, als.FactorModel]]) -> int:
    """First rank with the smallest error."""
    return min(found, key=lambda f: f[1])[0]


def recommend(
    train: DataFrame,
    mine: DataFrame,
    user: int,
    titles: DataFrame,
    counts: DataFrame,
    rank: int,
    min_ratings: int = 75,
    k: int = 20,
    **als,
) -> DataFrame:
    """Retrain with the user's own ratings and return the best unrated items.

    `prediction, title, n` of items with more than `min_ratings` ratings in `counts`
    (`counts_and_averages`).
    """
    ratings = add_ratings(train, mine)
    model = train_als(ratings, rank, **als)
    popular = counts.where(F.col("n") > min_ratings).select("item", "n")
    candidates = unrated_items(popular, mine, user)
    return (
        predict_pairs(model, candidates)
        .join(popular, "item")
        .join(titles.select("item", "title"), "item")
        .orderBy(F.desc("rating"), "item")
        .limit(k)
        .select(F.col("rating").alias("prediction"), "title", "n")
    )


def recommend_all(
    users: DataFrame,
    items: DataFrame,
    rated: DataFrame,
    titles: DataFrame,
    counts: DataFrame,
    min_ratings: int = 75,
    k: int = 20,
    **cells,
) -> DataFrame:
    """The best unrated items of every user: `user, rank, item, title, n, prediction`.

    `users(user, features)` and `items(item, features)` are factors, as `train_als` gives them or any
    others. Of items with more than `min_ratings` ratings in `counts` (`counts_and_averages`), those
    that the user has in `rated` are left out.
    """
    popular = counts.where(F.col("n") > min_ratings).select(F.col("item").cast("long").alias("item"), "n")
    known = items.select(F.col("item").cast("long").alias("item"), "features").join(popular.select("item"), "item")
    named = popular.join(titles.select(F.col("item").cast("long").alias("item"), "title"), "item")
    found = top_items(users, known, rated, k, **cells)
    return found.join(named, "item").select("user", "rank", "item", "title", "n", F.col("score").alias("prediction"))


def factors_of(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    """`user, features` and `item, features` of a trained model."""
    return (
        model.userFactors.select(F.col("id").alias("user"), "features"),
        model.itemFactors.select(F.col("id").alias("item"), "features"),
    )
