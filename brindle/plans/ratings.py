"""Rating queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.operators import factors, ratings as ops
from brindle.operators.grouping import hash_split
from brindle.plans.inputs import RATINGS_SQL, ratings, solution_sql, spread_table, table, titles, unit_sql, with_sql
from brindle.session import materialize
from brindle.sources.records import complete_counts, parse_ratings, parse_titles
from brindle.sources.text import literal_table

MIN_RATINGS = 25
RANKS = (4, 8, 12)
REG = 0.1
SPLIT_WEIGHTS, SPLIT_SEED = [6, 2, 2], 0

NEW_USER = 1_000_000_000
NEW_RATINGS = [(NEW_USER, item, float(1 + item % 5)) for item in range(10)]


def new_ratings(spark: SparkSession) -> DataFrame:
    return literal_table(spark, NEW_RATINGS, "user int, item int, rating double")


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One averaged rating per pair, with a 60/20/20 split."""
    return hash_split(ops.average_pairs(ratings(spark, sf_dir)), ops.PAIR, SPLIT_WEIGHTS, SPLIT_SEED)


def written_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Training, validation and test ratings of a split written once."""
    written = materialize(splits(spark, sf_dir), "rating-splits")
    return [written.where(F.col("split") == i).drop("split") for i in range(len(SPLIT_WEIGHTS))]


def _ingest(spark, sf_dir):
    source = spread_table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_quantity", "l_orderkey")
    lines = source.select(
        F.concat_ws(
            "::",
            F.col("l_suppkey").cast("string"),
            F.col("l_partkey").cast("string"),
            (F.col("l_quantity").cast("int") % 5 + 1).cast("string"),
            F.col("l_orderkey").cast("string"),
        ).alias("value")
    )
    return parse_ratings(lines).withColumnRenamed("user", "user_id")


def _titles_ingest(spark, sf_dir):
    lines = table(spark, sf_dir, "part").select(
        F.concat_ws(
            "::",
            F.col("p_partkey").cast("string"),
            F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")),
            F.concat_ws("|", "p_brand", "p_type"),
        ).alias("value")
    )
    return parse_titles(lines).withColumn("genres", F.array_join("genres", ","))


def _ingest_status(spark, sf_dir):
    """Rating lines, those of the seventh position of an order once more with a word for the rating."""
    source = spread_table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_quantity", "l_orderkey", "l_linenumber")
    ids = [F.col(c).cast("string") for c in ("l_suppkey", "l_partkey")]
    good = F.concat_ws("::", *ids, (F.col("l_quantity").cast("int") % 5 + 1).cast("string"), F.col("l_orderkey").cast("string"))
    bad = F.concat_ws("::", *ids, F.lit("good"), F.col("l_orderkey").cast("string"))
    lines = F.when(F.col("l_linenumber") == 7, F.array(good, bad)).otherwise(F.array(good))
    return complete_counts(parse_ratings(source.select(F.explode(lines).alias("value"))))


def _titles_status(spark, sf_dir):
    """Title lines, those of size 1 once more without their number."""
    parts = table(spark, sf_dir, "part")
    rest = [F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")), F.concat_ws("|", "p_brand", "p_type")]
    good, bad = F.concat_ws("::", F.col("p_partkey").cast("string"), *rest), F.concat_ws("::", F.lit("no number"), *rest)
    lines = F.when(F.col("p_size") == 1, F.array(good, bad)).otherwise(F.array(good))
    return complete_counts(parse_titles(parts.select(F.explode(lines).alias("value"))), "item", "title")


def _avg(spark, sf_dir):
    found = ops.counts_and_averages(ratings(spark, sf_dir))
    return found.withColumn("avg_rating", F.round("avg_rating", 6))


def _top(spark, sf_dir):
    found = ops.top_titles(ratings(spark, sf_dir), titles(spark, sf_dir), MIN_RATINGS)
    return found.withColumn("avg_rating", F.round("avg_rating", 6))


def _rmse(spark, sf_dir):
    rated = ratings(spark, sf_dir)
    mean = ops.counts_and_averages(rated).select("item", F.col("avg_rating").alias("rating"))
    predicted = rated.select(*ops.PAIR).join(materialize(mean, "item-means"), "item")
    return ops.rating_error(predicted, rated).withColumn("rmse", F.round("rmse", 6))


def _union(spark, sf_dir):
    both = ops.add_ratings(ratings(spark, sf_dir), new_ratings(spark))
    return both.groupBy("user").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("rating"), 6).alias("sum_rating")
    ).withColumnRenamed("user", "user_id")


def _unrated(spark, sf_dir):
    found = ops.unrated_items(titles(spark, sf_dir), ratings(spark, sf_dir), user=7)
    return found.withColumnRenamed("user", "user_id")


def _split_counts(spark, sf_dir):
    return splits(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def _als_predict(spark, sf_dir):
    train, validation, _ = written_parts(spark, sf_dir)
    return ops.predict_pairs(ops.train_als(train, RANKS[0]), validation)


def _rank_search(spark, sf_dir):
    train, validation, _ = written_parts(spark, sf_dir)
    found = ops.rank_search(train, validation, RANKS)
    best = ops.best_rank(found)
    rows = [(rank, float(error), rank == best) for rank, error, _ in found]
    return literal_table(spark, rows, "rank int, rmse double, best boolean")


def _test_error(spark, sf_dir):
    train, _, test = written_parts(spark, sf_dir)
    model = ops.train_als(train, RANKS[-1])
    return ops.rating_error(test, ops.predict_pairs(model, test))


def _best_rank(train, validation) -> int:
    return ops.best_rank(ops.rank_search(train, validation, RANKS))


def _my_test_error(spark, sf_dir):
    """Error on the test part of the best rank, trained with the own ratings too."""
    train, validation, test = written_parts(spark, sf_dir)
    model = ops.train_als(ops.add_ratings(train, new_ratings(spark)), _best_rank(train, validation))
    return ops.rating_error(test, ops.predict_pairs(model, test))


def _als_pairs(spark, sf_dir):
    """The pairs that a model rates: those whose user and item it was trained on."""
    train, validation, _ = written_parts(spark, sf_dir)
    predicted = ops.predict_pairs(ops.train_als(train, RANKS[0]), validation)
    return predicted.where("rating is not null").select(F.col("user").alias("user_id"), "item")


def _recommend(spark, sf_dir):
    rated = ratings(spark, sf_dir)
    train, validation, _ = written_parts(spark, sf_dir)
    return ops.recommend(
        train,
        new_ratings(spark),
        NEW_USER,
        titles(spark, sf_dir),
        ops.counts_and_averages(rated),
        _best_rank(train, validation),
        min_ratings=MIN_RATINGS,
    )


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fixed factors of every part: 1 and two scattered shares."""
    item = F.col("item")
    return titles(spark, sf_dir).select(
        "item", F.array(F.lit(1.0), item * 37 % 101 / F.lit(101.0), item * 53 % 89 / F.lit(89.0)).alias("features")
    )


def solved_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors.solve_users(ratings(spark, sf_dir), item_factors(spark, sf_dir), 3, REG)


def _user_factors(spark, sf_dir):
    found = solved_users(spark, sf_dir).select(
        F.col("user").alias("user_id"), "n", *[F.round(F.col("features")[i], 6).alias(f"f{i + 1}") for i in range(3)],
        F.round("residual", 3).alias("residual"),
    )
    return found


def _recommend_all(spark, sf_dir):
    """Every supplier's best unrated parts by solved factors."""
    rated = ratings(spark, sf_dir)
    found = ops.recommend_all(
        solved_users(spark, sf_dir), item_factors(spark, sf_dir), rated, titles(spark, sf_dir),
        ops.counts_and_averages(rated), MIN_RATINGS,
    )
    return found.withColumnRenamed("user", "user_id").withColumn("prediction", F.round("prediction", 6))


def _als_normal(spark, sf_dir):
    """How far the factors of the trained model are from solving each user's normal equations."""
    train = written_parts(spark, sf_dir)[0]
    users, items = ops.factors_of(ops.train_als(train, RANKS[0], reg=REG))
    found = factors.factor_residuals(train, users, items, RANKS[0], REG)
    return found.select(F.col("user").alias("user_id"), "n", F.round("residual", 3).alias("residual"))


def _als_recommend_all(spark, sf_dir):
    """The recommendations of the trained model for every supplier, summed up: how many there are, how
    many of them are rated or seldom rated, and whether predictions fall."""
    train = written_parts(spark, sf_dir)[0]
    users, items = ops.factors_of(ops.train_als(train, RANKS[0], reg=REG))
    counts = ops.counts_and_averages(ratings(spark, sf_dir))
    found = materialize(
        ops.recommend_all(users, items, train, titles(spark, sf_dir), counts, MIN_RATINGS), "recommended"
    )
    seen = train.select(F.col("user").cast("long").alias("user"), F.col("item").cast("long").alias("item"), F.lit(1).alias("seen"))
    rows = F.sort_array(F.collect_list(F.struct("rank", "prediction")))
    falls = F.forall(F.sequence(F.lit(1), F.size("rows") - 1), lambda i: F.get("rows", i - 1)["prediction"] >= F.get("rows", i)["prediction"])
    summed = found.join(seen, ["user", "item"], "left").groupBy(F.col("user").alias("user_id")).agg(
        F.count(F.lit(1)).alias("n_items"), F.count("seen").alias("n_rated"),
        F.count_if(F.col("n") <= MIN_RATINGS).alias("n_seldom"), rows.alias("rows"),
    )
    return summed.withColumn("ordered", (F.size("rows") < 2) | falls).drop("rows")


def _sql(query: str) -> str:
    return with_sql(RATINGS_SQL, query=query)


_DRAW = unit_sql(SPLIT_SEED, "user_id", "item")
_SPLIT_SQL = f"case when {_DRAW} < {0 + 6 / 10!r}::double then 0 when {_DRAW} < {6 / 10 + 2 / 10!r}::double then 1 else 2 end"

_FACTORS = ["x1", "x2", "x3"]
_LEFT = [
    [f"s{min(i, j)}{max(i, j)}" + (f" + {REG!r}::double * n" if i == j else "") for j in range(3)] for i in range(3)
]
_FACTOR_SQL = (
    "factors as (select item, 1.0::double as x1, item * 37 % 101 / 101.0::double as x2, "
    "item * 53 % 89 / 89.0::double as x3 from titles), "
    "sums as (select user_id, count(*) as n, "
    + ", ".join(f"sum({_FACTORS[i]} * {_FACTORS[j]}) as s{i}{j}" for i in range(3) for j in range(i, 3))
    + ", " + ", ".join(f"sum(rating * {x}) as t{i}" for i, x in enumerate(_FACTORS))
    + " from ratings join factors using (item) group by user_id), "
    "solved as (select user_id, n, "
    + ", ".join(f"{f} as f{i + 1}" for i, f in enumerate(solution_sql(_LEFT, ["t0", "t1", "t2"]))) + " from sums), "
    "popular as (select item, count(*) as n from ratings group by item "
    f"having count(*) > {MIN_RATINGS}) "
)
_TRAIN_SQL = f"train as (select user_id, item from (select distinct user_id, item, {_SPLIT_SQL} as split from ratings) where split = 0) "

QUERIES = {
    "cf_user_factors": (
        _user_factors,
        with_sql(RATINGS_SQL, _FACTOR_SQL, query=(
            "select user_id, n, round(f1, 6) as f1, round(f2, 6) as f2, round(f3, 6) as f3, 0.0::double as residual from solved"
        )),
    ),
    "cf_recommend_all": (
        _recommend_all,
        with_sql(RATINGS_SQL, _FACTOR_SQL, query=(
            "select cast(user_id as bigint) as user_id, cast(row_number() over best as int) as rank, cast(item as bigint) as item, title, n, "
            "round(score, 6) as prediction from (select s.user_id, f.item, t.title, p.n, "
            "f1 * x1 + f2 * x2 + f3 * x3 as score from solved s, factors f join popular p using (item) "
            "join titles t using (item) where not exists (select 1 from ratings r where r.user_id = s.user_id and r.item = f.item)) "
            "window best as (partition by user_id order by score desc, item) qualify row_number() over best <= 20"
        )),
    ),
    "cf_als_normal": (
        _als_normal,
        with_sql(RATINGS_SQL, _TRAIN_SQL, query="select user_id, count(*) as n, 0.0::double as residual from train group by user_id"),
    ),
    "cf_als_recommend_all": (
        _als_recommend_all,
        with_sql(RATINGS_SQL, _TRAIN_SQL, query=(
            "select cast(u.user_id as bigint) as user_id, least(20, count(*)) as n_items, cast(0 as bigint) as n_rated, cast(0 as bigint) as n_seldom, true as ordered "
            "from (select distinct user_id from train) u, "
            f"(select item from ratings where item in (select item from train) group by item having count(*) > {MIN_RATINGS}) p "
            "where not exists (select 1 from train t where t.user_id = u.user_id and t.item = p.item) group by u.user_id"
        )),
    ),
    "cf_ingest": (
        _ingest,
        "select cast(l_suppkey as int) as user_id, cast(l_partkey as int) as item, "
        "cast(1 + cast(l_quantity as int) % 5 as double) as rating, l_orderkey as ts from lineitem",
    ),
    "cf_titles_ingest": (
        _titles_ingest,
        _sql("select cast(p_partkey as int) as item, p_name || ' ' || p_partkey as title, "
             "p_brand || ',' || p_type as genres from part"),
    ),
    "cf_ingest_status": (
        _ingest_status,
        "select count(*) + count(*) filter (where l_linenumber = 7) as n_read, count(*) as n_ok, "
        "count(*) filter (where l_linenumber = 7) as n_bad from lineitem",
    ),
    "cf_titles_status": (
        _titles_status,
        "select count(*) + count(*) filter (where p_size = 1) as n_read, count(*) as n_ok, "
        "count(*) filter (where p_size = 1) as n_bad from part",
    ),
    "cf_avg": (
        _avg,
        _sql("select item, count(*) as n, round(avg(rating), 6) as avg_rating from ratings group by item"),
    ),
    "cf_top_titles": (
        _top,
        _sql(
            "select round(avg_rating, 6) as avg_rating, title, n from (select item, count(*) as n, "
            f"avg(rating) as avg_rating from ratings group by item having count(*) > {MIN_RATINGS}) "
            "join titles using (item) order by round_even(avg_rating, 3) desc, title desc, item limit 20"
        ),
    ),
    "cf_rmse": (
        _rmse,
        _sql(
            "select count(*) as n, round(sqrt(avg(pow(p.rating - a.rating, 2))), 6) as rmse "
            "from (select user_id, item, m.rating from ratings join "
            "(select item, avg(rating) as rating from ratings group by item) m using (item)) p "
            "join ratings a using (user_id, item)"
        ),
    ),
    "cf_union": (
        _union,
        _sql(
            "select user_id, count(*) as n, round(sum(rating), 6) as sum_rating from ("
            "select user_id, rating from ratings union all "
            f"select {NEW_USER}, cast(1 + i % 5 as double) from range(10) t(i)) group by user_id"
        ),
    ),
    "cf_unrated": (
        _unrated,
        _sql("select 7 as user_id, item from titles where item not in "
             "(select item from ratings where user_id = 7)"),
    ),
    "cf_split_counts": (
        _split_counts,
        _sql(
            f"select case when h < {0 + 6 / 10!r}::double then 0 when h < {6 / 10 + 2 / 10!r}::double "
            "then 1 else 2 end as split, count(*) as n "
            f"from (select distinct {unit_sql(SPLIT_SEED, 'user_id', 'item')} as h, user_id, item "
            "from ratings) group by 1"
        ),
    ),
    "cf_als_predict": (_als_predict, None),
    "cf_als_pairs": (
        _als_pairs,
        _sql(
            f"select user_id, item from (select *, {_SPLIT_SQL} as split from "
            f"(select distinct user_id, item from ratings)) where split = 1 "
            f"and user_id in (select user_id from (select user_id, {_SPLIT_SQL} as split from ratings) where split = 0) "
            f"and item in (select item from (select item, {_SPLIT_SQL} as split from ratings) where split = 0)"
        ),
    ),
    "cf_my_test_error": (_my_test_error, None),
    "cf_rank_search": (_rank_search, None),
    "cf_test_error": (_test_error, None),
    "cf_recommend": (_recommend, None),
}
