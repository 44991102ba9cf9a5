"""Linear-regression queries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.operators import regression as ops
from brindle.operators.grouping import hash_split
from brindle.plans.inputs import POINTS_SQL, SPLIT_SEED, SPLIT_WEIGHTS, points, solution_sql, unit_sql, with_sql
from brindle.session import materialize, spread
from brindle.sources.records import complete_counts, parse_points
from brindle.sources.text import literal_table

STEPS = 50
WEIGHTS = [0.5, -1.0, 2.0, 0.25]
REGS = (1.0, 1e-10, 1e-5)
LIBRARY_REGS = (0.3, 0.03, 0.001)
FOLDS, FOLD_SEED = 3, 7


def split_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with labels from zero and a split by order."""
    return ops.shift_labels(hash_split(points(spark, sf_dir), ["key"], SPLIT_WEIGHTS, SPLIT_SEED))


def _ingest(spark, sf_dir):
    lines = spread(points(spark, sf_dir)).select(
        F.concat_ws(",", F.col("label").cast("string"), F.array_join(
            F.transform("features", lambda v: v.cast("string")), ","
        )).alias("value")
    )
    parsed = parse_points(lines)
    return parsed.select(
        "label", *[F.round(F.col("features")[i], 9).alias(f"x{i + 1}") for i in range(4)]
    )


def _ingest_status(spark, sf_dir):
    """Points of the heaviest tax once more without their label."""
    rows = points(spark, sf_dir)
    line = F.concat_ws(",", F.col("label").cast("string"), F.array_join(F.transform("features", lambda v: v.cast("string")), ","))
    bad = F.concat(F.lit("none,"), F.array_join(F.transform("features", lambda v: v.cast("string")), ","))
    lines = rows.select(F.explode(F.when(F.col("features")[3] >= 1.0, F.array(line, bad)).otherwise(F.array(line))).alias("value"))
    return complete_counts(parse_points(lines))


def _baseline(spark, sf_dir):
    found = ops.baseline_errors(split_points(spark, sf_dir))
    return found.withColumn("rmse", F.round("rmse", 6))


def _gradient(spark, sf_dir):
    train = split_points(spark, sf_dir).where(F.col("split") == ops.TRAIN)
    found = ops.gradient(train, WEIGHTS)
    return found.select(*[F.round(c, 3).alias(c) for c in found.columns])


def _predictions(spark, sf_dir):
    data = split_points(spark, sf_dir).where(F.col("split") == ops.VALIDATION)
    found = ops.predict(ops.first_features(data, 2), WEIGHTS[:2])
    return found.withColumn("prediction", F.round("prediction", 6))


def _trace(spark, sf_dir, steps):
    train = ops.split_moments(split_points(spark, sf_dir))[ops.TRAIN]
    errors = ops.gradient_descent(train, steps)[1]
    rows = [(i, round(e, 6), round(math.log(e), 6)) for i, e in enumerate(errors)]
    return literal_table(spark, rows, "step int, rmse double, log_rmse double")


def _descent(spark, sf_dir):
    m = ops.split_moments(split_points(spark, sf_dir))
    model = ops.gradient_descent(m[ops.TRAIN], STEPS)[0]
    row = [round(float(w), 6) for w in model.weights] + [round(model.error(m[ops.VALIDATION]), 6)]
    return literal_table(spark, [tuple(row)], "w1 double, w2 double, w3 double, w4 double, rmse double")


def _regularized(spark, sf_dir):
    m = ops.split_moments(split_points(spark, sf_dir))
    model = ops.regularized_descent(m[ops.TRAIN], 0.1)
    row = [round(float(v), 6) for v in (*model.weights, model.intercept, model.error(m[ops.VALIDATION]))]
    return literal_table(
        spark, [tuple(row)],
        "w1 double, w2 double, w3 double, w4 double, intercept double, rmse double",
    )


def _grid(spark, sf_dir):
    m = ops.split_moments(split_points(spark, sf_dir))
    errors, best, _ = ops.grid_search(m[ops.TRAIN], m[ops.VALIDATION], 0.1, REGS)
    rows = [(float(reg), round(error, 6), reg == best) for reg, error in errors]
    return literal_table(spark, rows, "reg double, rmse double, best boolean")


def _library_search(spark, sf_dir):
    written = materialize(split_points(spark, sf_dir), "points")
    train = written.where(F.col("split") == ops.TRAIN)
    return written, ops.cross_validated(train, 4, LIBRARY_REGS, ["key"], FOLDS, FOLD_SEED)


def _library_grid(spark, sf_dir):
    found = [float(error) for error in _library_search(spark, sf_dir)[1].avgMetrics]
    rows = [(reg, round(error, 6), error == min(found)) for reg, error in zip(LIBRARY_REGS, found)]
    return literal_table(spark, rows, "reg double, rmse double, best boolean")


def _library_fit(spark, sf_dir):
    written, found = _library_search(spark, sf_dir)
    error = ops.library_error(found, written.where(F.col("split") == ops.VALIDATION), 4)
    model = found.bestModel.stages[-1]
    row = [round(float(v), 6) for v in (*model.coefficients, model.intercept, error)]
    return literal_table(spark, [tuple(row)], "w1 double, w2 double, w3 double, w4 double, intercept double, rmse double")


def _sql(query: str, *ctes: str, recursive: bool = False) -> str:
    return with_sql(POINTS_SQL, *ctes, query=query, recursive=recursive)


X = ["x1", "x2", "x3", "x4"]


def _dot(weights) -> str:
    return "(" + " + ".join(f"{w} * {x}" for w, x in zip(weights, X)) + ")"


def _unrolled_sql(steps: int) -> str:
    """Descent that scans the training points at every step."""
    ctes = ["train as (select * from points where split = 0)", "w0 as (select 0.0::double as x1, 0.0::double as x2, 0.0::double as x3, 0.0::double as x4)"]
    for i in range(steps):
        residual = _dot([f"w{i}.{x}" for x in X]).replace("* x", "* t.x") + " - t.label"
        ctes.append(
            f"s{i} as (select count(*) as n, sqrt(avg(pow({residual}, 2))) as rmse, "
            + ", ".join(f"sum(({residual}) * t.{x}) as g_{x}" for x in X)
            + f" from train t, w{i})"
        )
        ctes.append(
            f"w{i + 1} as (select "
            + ", ".join(f"w{i}.{x} - g_{x} / (n * sqrt({i + 1})) as {x}" for x in X)
            + f" from w{i}, s{i})"
        )
    rows = " union all ".join(
        f"select {i} as step, round(rmse, 6) as rmse, round(ln(rmse), 6) as log_rmse from s{i}"
        for i in range(steps)
    )
    return _sql(rows, *ctes)


_NAMES = ["y", *X, "one"]


def _moment_sql() -> str:
    """One row per split with all products of label, features and 1."""
    products = [
        f"sum({a} * {b}) as {a}_{b}" for i, a in enumerate(_NAMES) for b in _NAMES[i:]
    ]
    return (
        "m as (select split, count(*) as n, " + ", ".join(products)
        + " from (select *, label as y, 1.0::double as one from points) group by split)"
    )


def _m(a: str, b: str) -> str:
    return f"{a}_{b}" if _NAMES.index(a) <= _NAMES.index(b) else f"{b}_{a}"


def _rmse_sql(weights: dict[str, str]) -> str:
    """RMSE from the products of table `m` for weights on features and 1."""
    terms = {"y": "-1.0::double", **weights}
    total = " + ".join(f"{terms[a]} * {terms[b]} * m.{_m(a, b)}" for a in terms for b in terms)
    return f"sqrt(greatest({total}, 0) / m.n)"


def _descent_sql() -> str:
    moves = ", ".join(
        f"w.{x} - (" + " + ".join(f"w.{z} * m.{_m(x, z)}" for z in X)
        + f" - m.{_m('y', x)}) / (m.n * sqrt(w.i + 1)) as {x}"
        for x in X
    )
    walk = (
        f"w(i, {', '.join(X)}) as (select 0, 0.0::double, 0.0::double, 0.0::double, 0.0::double union all "
        f"select w.i + 1, {moves} from w, m where m.split = 0 and w.i < {STEPS})"
    )
    rounded = ", ".join(f"round({x}, 6) as w{i + 1}" for i, x in enumerate(X))
    error = _rmse_sql({x: f"w.{x}" for x in X})
    return _sql(
        f"select {rounded}, round({error}, 6) as rmse from w, m where w.i = {STEPS} and m.split = 1",
        _moment_sql(), walk, recursive=True,
    )


def _regularized_sql(regs, select: str) -> str:
    names = [*X, "one"]
    moved = {
        x: f"w.{x} * (1 - w.reg / sqrt(w.i + 1)) - ("
        + " + ".join(f"w.{z} * m.{_m(x, z)}" for z in names)
        + f" - m.{_m('y', x)}) / (m.n * sqrt(w.i + 1))"
        for x in names
    }
    columns = ", ".join(names)
    step = ", ".join(f"{moved[x]} as {x}_new" for x in names)
    far = (
        "sqrt(" + " + ".join(f"pow({x}_new - {x}, 2)" for x in names) + ") < 0.001::double * "
        "greatest(sqrt(" + " + ".join(f"pow({x}_new, 2)" for x in names) + "), 1.0::double)"
    )
    start = ", ".join(["0.0::double"] * 4 + ["1.0::double"])
    walk = (
        f"w(reg, i, done, {columns}) as (select reg, 0, false, {start} from (values "
        + ", ".join(f"({r!r}::double)" for r in regs)
        + f") r(reg) union all select reg, i + 1, i + 1 > 1 and {far}, "
        + ", ".join(f"{x}_new" for x in names)
        + f" from (select w.*, {step} from w, m where m.split = 0 and not w.done and w.i < 500)), "
        "final as (select * from w qualify row_number() over (partition by reg order by i desc) = 1), "
        f"rated as (select w.*, {_rmse_sql({x: f'w.{x}' for x in names})} as rmse "
        "from final w, m where m.split = 1)"
    )
    return _sql(select, _moment_sql(), walk, recursive=True)


_PRODUCTS = [f"{a}_{b}" for i, a in enumerate(_NAMES) for b in _NAMES[i:]]


def _ridge_sql(m: str, reg: str) -> dict[str, str]:
    """Weights and intercept of the penalized equations, from the products of row `m`."""
    mean = {a: f"({m}.{_m(a, 'one')} / {m}.n)" for a in _NAMES}

    def cov(a: str, b: str) -> str:
        return f"({m}.{_m(a, b)} / {m}.n - {mean[a]} * {mean[b]})"

    penalty = f"{reg} / sqrt({cov('y', 'y')})"
    left = [[f"c_{_m(a, b)}" for b in X] for a in X]
    weights = dict(zip(X, solution_sql(left, [f"c_{_m('y', a)}" for a in X])))
    terms = {f"c_{_m(a, b)}": cov(a, b) + (f" + {penalty}" if a == b else "") for i, a in enumerate(X) for b in X[i:]}
    terms |= {f"c_{_m('y', a)}": cov("y", a) for a in X}
    return {
        "terms": ", ".join(f"{term} as {name}" for name, term in terms.items()),
        "weights": ", ".join(f"{w} as w_{x}" for x, w in weights.items()),
        "intercept": f"{mean['y']} - " + " - ".join(f"w_{x} * {mean[x]}" for x in X),
    }


def _library_sql(select: str) -> str:
    """Cross-validation by closed solutions from the products of every fold."""
    draw = unit_sql(FOLD_SEED, "key")
    bounds = [sum([1 / FOLDS] * (i + 1)) for i in range(FOLDS - 1)]
    fold = "case " + " ".join(f"when {draw} < {b!r}::double then {i}" for i, b in enumerate(bounds)) + f" else {FOLDS - 1} end"
    sums = ", ".join(f"sum({p}) as {p}" for p in _PRODUCTS)
    products = ", ".join(f"sum({a} * {b}) as {a}_{b}" for i, a in enumerate(_NAMES) for b in _NAMES[i:])
    regs = ", ".join(f"({r!r}::double)" for r in LIBRARY_REGS)
    ridge, final = _ridge_sql("t", "reg"), _ridge_sql("t", "reg")
    weights = {**{x: f"w_{x}" for x in X}, "one": "w_one"}
    return _sql(
        select,
        f"dealt as (select *, {fold} as fold, label as y, 1.0::double as one from points)",
        f"folds as (select split, fold, count(*) as n, {products} from dealt group by split, fold)",
        f"others as (select f.fold, sum(o.n) as n, {', '.join(f'sum(o.{p}) as {p}' for p in _PRODUCTS)} from folds f "
        "join folds o on f.split = 0 and o.split = 0 and f.fold <> o.fold group by f.fold)",
        f"regs as (select * from (values {regs}) r(reg))",
        f"c as (select t.*, reg, {ridge['terms']} from others t, regs)",
        f"w as (select *, {ridge['weights']} from c)",
        f"wi as (select t.*, {ridge['intercept']} as w_one from w t)",
        f"rated as (select reg, avg({_rmse_sql({k: f'wi.{v}' for k, v in weights.items()})}) as rmse "
        "from wi join folds m on m.split = 0 and m.fold = wi.fold group by reg)",
        f"whole as (select split, sum(n) as n, {sums} from folds group by split)",
        f"fc as (select t.*, reg, {final['terms']} from whole t, (select reg from rated order by rmse limit 1) where split = 0)",
        f"fw as (select *, {final['weights']} from fc)",
        f"best as (select t.*, {final['intercept']} as w_one from fw t)",
    )


QUERIES = {
    "lr_ml_grid": (
        _library_grid,
        _library_sql("select reg, round(rmse, 6) as rmse, rmse = min(rmse) over () as best from rated"),
    ),
    "lr_ml_fit": (
        _library_fit,
        _library_sql(
            "select " + ", ".join(f"round(w_{x}, 6) as w{i + 1}" for i, x in enumerate(X))
            + f", round(w_one, 6) as intercept, round({_rmse_sql({**{x: f'w_{x}' for x in X}, 'one': 'w_one'})}, 6) as rmse "
            "from best, whole m where m.split = 1"
        ),
    ),
    "lr_ingest": (
        _ingest,
        _sql("select label, round(x1, 9) as x1, round(x2, 9) as x2, round(x3, 9) as x3, "
             "round(x4, 9) as x4 from raw_points"),
    ),
    "lr_ingest_status": (
        _ingest_status,
        _sql("select count(*) + count(*) filter (where x4 >= 1) as n_read, count(*) as n_ok, "
             "count(*) filter (where x4 >= 1) as n_bad from raw_points"),
    ),
    "lr_label_range": (
        lambda spark, sf_dir: ops.label_range(points(spark, sf_dir)),
        _sql("select min(label) as min_label, max(label) as max_label from raw_points"),
    ),
    "lr_label_shift": (
        lambda spark, sf_dir: ops.label_counts(ops.shift_labels(points(spark, sf_dir))),
        _sql("select label, count(*) as n from points group by label"),
    ),
    "lr_label_counts": (
        lambda spark, sf_dir: ops.label_counts(points(spark, sf_dir)),
        _sql("select label, count(*) as n from raw_points group by label"),
    ),
    "lr_split_counts": (
        lambda spark, sf_dir: split_points(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n")),
        _sql("select split, count(*) as n from points group by split"),
    ),
    "lr_baseline_rmse": (
        _baseline,
        _sql("select split, round(sqrt(avg(pow(label - (select avg(label) from points where split = 0), 2))), 6) "
             "as rmse from points group by split"),
    ),
    "lr_predictions": (
        _predictions,
        _sql(f"select label, round({WEIGHTS[0]}::double * x1 + ({WEIGHTS[1]}::double) * x2, 6) as prediction "
             "from points where split = 1"),
    ),
    "lr_gradient": (
        _gradient,
        _sql(
            "select " + ", ".join(
                f"round(sum(({_dot([f'({w}::double)' for w in WEIGHTS])} - label) * {x}), 3) as g{i + 1}"
                for i, x in enumerate(X)
            ) + " from points where split = 0"
        ),
    ),
    "lr_gd_trace": (lambda spark, sf_dir: _trace(spark, sf_dir, 5), _unrolled_sql(5)),
    "lr_gd_50": (_descent, _descent_sql()),
    "lr_sgd": (
        _regularized,
        _regularized_sql(
            [0.1],
            "select " + ", ".join(f"round({x}, 6) as w{i + 1}" for i, x in enumerate(X))
            + ", round(one, 6) as intercept, round(rmse, 6) as rmse from rated",
        ),
    ),
    "lr_grid": (
        _grid,
        _regularized_sql(
            [0.1, *REGS],
            "select reg, round(rmse, 6) as rmse, row_number() over (order by rmse, "
            f"list_position([{', '.join(f'{r!r}::double' for r in (0.1, *REGS))}], reg)) = 1 as best from rated",
        ),
    ),
}
