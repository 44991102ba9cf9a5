"""Time-series and principal-component queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brindle.operators import pca as ops
from brindle.operators.moments import moments, vector_status
from brindle.plans.inputs import SERIES_LENGTH, SERIES_PERIOD, SERIES_SQL, series, table, unit_sql, with_sql
from brindle.sources.records import complete_counts, parse_series
from brindle.sources.text import literal_table

SPREAD = 0.1245
GAUSS_SEED, GAUSS_MEAN, GAUSS_COV = 142, 50.0, 0.9


def _gaussian(spark, sf_dir):
    """A correlated pair of variance 1 for every customer."""
    keys = table(spark, sf_dir, "customer").select("c_custkey")
    drawn = ops.correlated_pairs(keys, ["c_custkey"], GAUSS_MEAN, 1.0, GAUSS_COV, GAUSS_SEED)
    return drawn.select("c_custkey", *[F.round(F.col("p")[i], 6).alias(f"p{i + 1}") for i in range(2)])


def _cells(df: DataFrame, digits: int = 6) -> DataFrame:
    """`x, y, i, v` with the elements of `ts` as rows."""
    long = df.select("x", "y", F.posexplode_outer("ts").alias("i", "v")).where("i is not null")
    return long.select("x", "y", F.col("i").cast("long").alias("i"), F.round("v", digits).alias("v"))


def _ingest(spark, sf_dir):
    lines = series(spark, sf_dir).select(
        F.concat_ws(
            " ",
            F.col("x").cast("string"),
            F.col("y").cast("string"),
            F.array_join(F.transform("ts", lambda v: v.cast("string")), " "),
        ).alias("value")
    )
    return _cells(parse_series(lines), 9)


def _status(spark, sf_dir):
    """Series of the first column once more with a letter for their first value."""
    values = F.array_join(F.transform("ts", lambda v: v.cast("string")), " ")
    head = F.concat_ws(" ", F.col("x").cast("string"), F.col("y").cast("string"))
    good, bad = F.concat_ws(" ", head, values), F.concat_ws(" ", head, F.lit("v"), values)
    lines = F.when(F.col("x") == 0, F.array(good, bad)).otherwise(F.array(good))
    return complete_counts(parse_series(series(spark, sf_dir).select(F.explode(lines).alias("value"))))


def _ragged_mean(spark, sf_dir):
    """Mean of the well-formed series among shortened, lengthened and holed ones."""
    v = F.col("ts")
    shapes = (
        F.when(F.col("y") == 0, F.array(v, F.slice(v, 1, SERIES_LENGTH - 1)))
        .when(F.col("y") == 1, F.array(v, F.concat(v, F.array(F.lit(1.0)))))
        .when(F.col("y") == 2, F.array(v, F.concat(F.array(F.lit(None).cast("double")), F.slice(v, 2, SERIES_LENGTH - 1))))
        .otherwise(F.array(v))
    )
    rows = series(spark, sf_dir).select(F.explode(shapes).alias("ts"))
    status = vector_status(rows, "ts").first()
    total = float(moments(rows, "ts").mean.sum())
    return literal_table(
        spark, [(status["n_read"], status["n_bad"], round(total, 6))], "n_read long, n_bad long, total double"
    )


def _minmax(spark, sf_dir):
    found = ops.extremes(series(spark, sf_dir), "ts")
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


def _varying(spark, sf_dir):
    return ops.varying(series(spark, sf_dir), "ts", SPREAD).select("x", "y")


def _mean(spark, sf_dir):
    found = ops.element_means(series(spark, sf_dir), "ts", SERIES_LENGTH)
    return found.withColumn("mean", F.round("mean", 9))


def _cov(spark, sf_dir):
    found = ops.covariance_table(series(spark, sf_dir), "ts")
    return found.withColumn("cov", F.round("cov", 9))


def _eigen(spark, sf_dir):
    """Sum and sum of squares of all eigenvalues: the trace and squared norm of the covariance."""
    values = ops.pca(series(spark, sf_dir), "ts", 3).eigenvalues
    rows = [(len(values), round(float(values.sum()), 6), round(float((values**2).sum()), 6))]
    return literal_table(spark, rows, "n int, total double, squares double")


def _eigenvalues(spark, sf_dir):
    model = ops.pca(ops.rescaled(series(spark, sf_dir)), "ts", 3)
    return literal_table(
        spark, [(i, float(v)) for i, v in enumerate(model.eigenvalues)], "i int, eigenvalue double"
    )


def _score_norms(spark, sf_dir):
    """Scores on all components keep the norm of every series."""
    data = series(spark, sf_dir)
    scored = ops.scores(data, "ts", ops.pca(data, "ts", SERIES_LENGTH))
    norm = F.sqrt(F.aggregate("scores", F.lit(0.0), lambda acc, v: acc + v * v))
    return scored.select("x", "y", F.round(norm, 6).alias("norm"))


def _scores(spark, sf_dir):
    data = ops.rescaled(series(spark, sf_dir))
    scored = ops.scores(data, "ts", ops.pca(data, "ts", 3))
    return scored.select("x", "y", *[F.round(F.col("scores")[i], 6).alias(f"pc{i + 1}") for i in range(3)])


def _half(parity: int):
    """Sum of every other element."""
    return F.aggregate(F.filter("ts", lambda v, i: i % 2 == parity), F.lit(0.0), lambda s, v: s + v)


def _points(spark, sf_dir):
    """Points of two measures of the whole series."""
    return series(spark, sf_dir).select("x", "y", F.array(_half(0), _half(1)).alias("p"))


def _line(spark, sf_dir):
    data = _points(spark, sf_dir)
    found = ops.project_on_line(data, "p", ops.pca(data, "p", 2))
    return found.select(F.round("x1", 6).alias("x1"), F.round("x2", 6).alias("x2"))


def _line_ends(spark, sf_dir):
    lines = ops.component_lines(ops.pca(_points(spark, sf_dir), "p", 2), 5.0)
    rows = [(i + 1, *[round(v, 6) for v in line]) for i, line in enumerate(lines)]
    return literal_table(
        spark, rows, "component int, x1_start double, x2_start double, x1_end double, x2_end double"
    )


def _color(spark, sf_dir):
    centre = SERIES_LENGTH / 2
    plane = _points(spark, sf_dir).withColumn("scores", F.transform("p", lambda v: (v - centre) * 2))
    found = ops.color_map(plane, 2.0)
    return found.select("x", "y", *[F.round(c, 6).alias(c) for c in "rgb"])


def _grid(spark, sf_dir):
    """Blocks of four columns, so that the table keeps its width at any number of columns."""
    plane = series(spark, sf_dir).select(
        "y", F.floor(F.col("x") / 4).alias("block"), (F.col("x") % 4).alias("x"), F.round(F.col("ts")[0], 6).alias("v")
    )
    found = ops.grid(plane, "v", range(4), ("y", "block"))
    return found.withColumnsRenamed({str(x): f"x{x}" for x in range(4)})


def _pipeline(how):
    def run(spark, sf_dir):
        found = ops.series_pipeline(series(spark, sf_dir), how, SERIES_PERIOD)[1]
        return found.select("x", "y", *[F.round(c, 6).alias(c) for c in "rgb"])

    return run


def _sql(query: str, *ctes: str) -> str:
    return with_sql(SERIES_SQL, *ctes, query=query)


_COV = """
cov as (select a.i, b.i as j, covar_pop(a.v, b.v) as cov
        from cells a join cells b using (vec_id) group by a.i, b.i)"""
_RESCALED = """
means as (select vec_id, avg(v) as m from cells group by vec_id),
scaled as (select vec_id, x, y, i, (v - m) / m as v from cells join means using (vec_id))"""
_PLANE = """
p as (select vec_id, list_sum(list_filter(ts, lambda v, i: i % 2 = 1)) as a,
             list_sum(list_filter(ts, lambda v, i: i % 2 = 0)) as b from series),
s as (select avg(a) as ma, avg(b) as mb, var_pop(a) as va, var_pop(b) as vb, covar_pop(a, b) as c from p),
e as (select *, (va + vb) / 2 + sqrt(pow((va - vb) / 2, 2) + c * c) as l1,
             (va + vb) / 2 - sqrt(pow((va - vb) / 2, 2) + c * c) as l2 from s)"""
def _hsv(scores: str, scale: float) -> str:
    """Table `rgb` of unclipped colours from a query `x, y, b0, b1`."""
    return f"""
hsv as (select x, y, h * 6 - floor(h * 6) as f, cast(floor(h * 6) as int) % 6 as k,
               {scale!r}::double * sqrt(b0 * b0 + b1 * b1) as v
        from (select x, y, b0, b1, (t - floor(t / (2 * pi())) * 2 * pi()) / (2 * pi()) as h
              from (select x, y, b0, b1, atan2(-b0, -b1) + pi() / 2 as t from ({scores})))),
rgb as (select x, y,
  case k when 0 then v when 1 then v * (1 - f) when 2 then 0 when 3 then 0 when 4 then v * f else v end as r,
  case k when 0 then v * f when 1 then v when 2 then v when 3 then v * (1 - f) else 0 end as g,
  case k when 0 then 0 when 1 then 0 when 2 then v * f when 3 then v when 4 then v else v * (1 - f) end as b
  from hsv)"""


_HALVES = """select x, y, (list_sum(list_filter(ts, lambda v, i: i % 2 = 1)) - 32.0::double) * 2 as b0,
       (list_sum(list_filter(ts, lambda v, i: i % 2 = 0)) - 32.0::double) * 2 as b1 from series"""


def _clipped(scale: float) -> str:
    return ", ".join(f"round(greatest(0.0::double, least(1.0::double, {c} * {scale!r}::double)), 6) as {c}" for c in "rgb")


SQUARINGS = 36


def _scores_sql(key: str, k: int) -> list[str]:
    """Tables up to `scores(x, y, b0, b1, ...)` of the rescaled series, folded by `key`.

    A covariance squared over and over, and scaled, becomes the product of its first component with
    itself, whatever the gap to the second; that component is then taken out of the covariance.
    """
    ctes = [
        _RESCALED,
        f"folds as materialized (select vec_id, x, y, {key} as i, sum(v) as v from scaled group by vec_id, x, y, {key})",
        "c0 as materialized (select a.i, b.i as j, covar_pop(a.v, b.v) as c from folds a join folds b using (vec_id) group by a.i, b.i)",
    ]
    for t in range(k):
        last = f"c{t}"
        for n in range(SQUARINGS):
            ctes.append(
                f"m{t}_{n} as materialized (select i, j, c / max(abs(c)) over () as c from (select a.i, b.j, sum(a.c * b.c) as c "
                f"from {last} a join {last} b on a.j = b.i group by a.i, b.j))"
            )
            last = f"m{t}_{n}"
        ctes += [
            f"u{t} as materialized (select i, c / sqrt(sum(c * c) over ()) as v from {last} "
            f"where j = (select j from {last} where i = j order by c desc limit 1))",
            f"v{t} as materialized (select i, v * (select sign(v) from u{t} order by abs(v) desc limit 1) as v from u{t})",
            f"l{t} as materialized (select sum(a.v * c.c * b.v) as l from c{t} c join v{t} a on a.i = c.i join v{t} b on b.i = c.j)",
            f"c{t + 1} as materialized (select c.i, c.j, c.c - l * a.v * b.v as c from c{t} c join v{t} a on a.i = c.i "
            f"join v{t} b on b.i = c.j, l{t})",
        ]
    products = ", ".join(f"sum(f.v * v{t}.v) as b{t}" for t in range(k))
    joins = " ".join(f"join v{t} on v{t}.i = f.i" for t in range(k))
    return [*ctes, f"scores as (select x, y, {products} from folds f {joins} group by vec_id, x, y)"]


def _colors_sql(how: str, key: str) -> str:
    scale = ops.SCALES[how]
    return _sql(f"select x, y, {_clipped(scale)} from rgb", *_scores_sql(key, 2), _hsv("select * from scores", scale))


def _fold_sql(key: str) -> str:
    return _sql(
        f"select x, y, {key} as i, round(sum(v), 6) as v from scaled group by x, y, {key}", _RESCALED
    )


QUERIES = {
    "ts_ingest": (_ingest, _sql("select x, y, i, round(v, 9) as v from cells")),
    "ts_ingest_status": (
        _status,
        _sql("select count(*) + count(*) filter (where x = 0) as n_read, count(*) as n_ok, "
             "count(*) filter (where x = 0) as n_bad from series"),
    ),
    "ts_ragged_mean": (
        _ragged_mean,
        _sql("select (select count(*) + count(*) filter (where y < 3) from series) as n_read, "
             "(select count(*) filter (where y < 3) from series) as n_bad, "
             "(select round(sum(m), 6) from (select avg(v) as m from cells group by i)) as total"),
    ),
    "ts_minmax": (
        _minmax,
        _sql("select round(min(v), 9) as min_value, round(max(v), 9) as max_value from cells"),
    ),
    "ts_std_filter": (
        _varying,
        _sql(
            f"select x, y from cells group by x, y having stddev_pop(v) > {SPREAD}::double"
        ),
    ),
    "ts_rescale": (
        lambda spark, sf_dir: _cells(ops.rescaled(series(spark, sf_dir))),
        _sql("select x, y, i, round(v, 6) as v from scaled", _RESCALED),
    ),
    "ts_fold_time": (
        lambda spark, sf_dir: _cells(ops.folded(ops.rescaled(series(spark, sf_dir)), SERIES_PERIOD, "time")),
        _fold_sql(f"i % {SERIES_PERIOD}"),
    ),
    "ts_fold_block": (
        lambda spark, sf_dir: _cells(ops.folded(ops.rescaled(series(spark, sf_dir)), SERIES_PERIOD, "block")),
        _fold_sql(f"i // {SERIES_PERIOD}"),
    ),
    "pca_mean": (_mean, _sql("select cast(i as int) as i, round(avg(v), 9) as mean from cells group by 1")),
    "pca_cov": (_cov, _sql("select cast(i as int) as i, cast(j as int) as j, round(cov, 9) as cov from cov", _COV)),
    "pca_eigen": (
        _eigen,
        _sql(
            "select 64 as n, round(sum(cov) filter (where i = j), 6) as total, "
            "round(sum(cov * cov), 6) as squares from cov",
            _COV,
        ),
    ),
    "pca_eigenvalues": (_eigenvalues, None),
    "pca_score_norms": (
        _score_norms,
        _sql("select x, y, round(sqrt(sum(v * v)), 6) as norm from cells group by x, y"),
    ),
    "pca_scores": (
        _scores,
        _sql("select x, y, round(b0, 6) as pc1, round(b1, 6) as pc2, round(b2, 6) as pc3 from scores", *_scores_sql("i", 3)),
    ),
    "pca_line": (
        _line,
        _sql(
            "select round(ma + d * c / q, 6) as x1, round(mb + d * (l1 - va) / q, 6) as x2 from ("
            "select *, (a - ma) * c + (b - mb) * (l1 - va) as d, c * c + pow(l1 - va, 2) as q from p, e)",
            _PLANE,
        ),
    ),
    "pca_line_ends": (
        _line_ends,
        _sql(
            "select k as component, round(ma - 5, 6) as x1_start, round(mb - 5 * s, 6) as x2_start, "
            "round(ma + 5, 6) as x1_end, round(mb + 5 * s, 6) as x2_end from ("
            "select 1 as k, ma, mb, (l1 - va) / c as s from e union all "
            "select 2 as k, ma, mb, (l2 - va) / c as s from e)",
            _PLANE,
        ),
    ),
    "pca_color": (
        _color,
        _sql(f"select x, y, {_clipped(2.0)} from rgb", _hsv(_HALVES, 2.0)),
    ),
    "pca_grid": (
        _grid,
        _sql(
            "select y, cast(x // 4 as bigint) as block, "
            + ", ".join(f"max(case when x % 4 = {x} then round(ts[1], 6) end) as x{x}" for x in range(4))
            + " from series group by y, x // 4"
        ),
    ),
    "pca_gaussian": (
        _gaussian,
        "with u as (select c_custkey, sqrt(-2.0::double * ln(1.0::double - "
        f"{unit_sql(GAUSS_SEED, 'c_custkey', '0')})) as r, 2.0::double * pi() * {unit_sql(GAUSS_SEED, 'c_custkey', '1')} as a "
        f"from customer) select c_custkey, round(r * cos(a) + {GAUSS_MEAN}::double, 6) as p1, "
        f"round(r * cos(a) * {GAUSS_COV}::double + r * sin(a) * sqrt(1 - pow({GAUSS_COV}::double, 2)) + {GAUSS_MEAN}::double, 6) as p2 "
        "from u",
    ),
    "pca_series_colors": (_pipeline("series"), _colors_sql("series", "i")),
    "pca_time_colors": (_pipeline("time"), _colors_sql("time", f"i % {SERIES_PERIOD}")),
    "pca_block_colors": (_pipeline("block"), _colors_sql("block", f"i // {SERIES_PERIOD}")),
}
