"""Principal components of numeric arrays and of pixel time series."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from brindle.functions.arrays import array_std, fold_block, fold_period, rescale
from brindle.functions.color import polar_rgb
from brindle.operators.grouping import unit_hash
from brindle.operators.moments import moments, well_formed
from brindle.session import materialize


@dataclass(frozen=True)
class Pca:
    """`components` has one column per component; `eigenvalues` holds all, largest first."""

    mean: np.ndarray
    covariance: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray


def pca(df: DataFrame, column: str, k: int = 2) -> Pca:
    """Eigenvectors of the population covariance, which one aggregation brings to the driver.

    The sign of a component is fixed by making its largest entry positive.
    """
    m = moments(df, column)
    values, vectors = np.linalg.eigh(m.covariance)
    order = np.argsort(-values)
    top = vectors[:, order[:k]]
    largest = np.abs(top).argmax(axis=0)
    top = top * np.where(top[largest, np.arange(top.shape[1])] < 0, -1.0, 1.0)
    return Pca(m.mean, m.covariance, top, values[order])


def scores(
    df: DataFrame, column: str, model: Pca, keep: Sequence[str] = ("x", "y"), name: str = "scores"
) -> DataFrame:
    """The columns `keep` and the product of every array with the components, uncentred.

    One matrix product per Arrow batch; an array that is null, of another length or with a null
    element gives null scores.
    """
    components = model.components
    d, k = components.shape
    vector = F.when(well_formed(F.col(column), d), F.col(column)).cast("array<double>")
    source = df.select(*keep, vector.alias("_vector"))
    schema = StructType([*source.schema.fields[:-1], StructField(name, ArrayType(DoubleType()))])

    def product(arrays: pa.Array) -> pa.Array:
        present = arrays.is_valid().to_numpy(zero_copy_only=False)
        values = arrays.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        ends = np.concatenate([[0], np.cumsum(np.where(present, k, 0))])
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array((values @ components).reshape(-1)), mask=pa.array(~present)
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], product(batch.columns[-1])], schema.fieldNames()
            )

    return source.mapInArrow(run, schema)


def element_means(df: DataFrame, column: str, d: int) -> DataFrame:
    """One row `i, mean` per element of an array column of length `d`."""
    means = df.agg(*[F.avg(F.col(column)[i]).alias(f"m{i}") for i in range(d)])
    return means.select(
        F.posexplode(F.array(*[F.col(f"m{i}") for i in range(d)])).alias("i", "mean")
    )


def covariance_table(df: DataFrame, column: str) -> DataFrame:
    """`i, j, cov` of the population covariance."""
    cov = moments(df, column).covariance
    rows = [(i, j, float(cov[i, j])) for i in range(len(cov)) for j in range(len(cov))]
    return df.sparkSession.createDataFrame(rows, "i int, j int, cov double")


def project_on_line(df: DataFrame, column: str, model: Pca) -> DataFrame:
    """Two-dimensional points projected on the first component: `x1, x2`."""
    (a, b), (m1, m2) = model.components[:, 0], model.mean[:2]
    p1, p2 = F.col(column)[0], F.col(column)[1]
    along = ((p1 - float(m1)) * float(a) + (p2 - float(m2)) * float(b)) / float(a * a + b * b)
    return df.select(
        (along * float(a) + float(m1)).alias("x1"), (along * float(b) + float(m2)).alias("x2")
    )


def component_lines(model: Pca, reach: float) -> list[tuple[float, ...]]:
    """Start and end point of the lines along the first two components through the mean."""
    m1, m2 = model.mean[:2]
    slopes = model.components[1, :2] / model.components[0, :2]
    return [
        tuple(float(v) for v in (m1 - reach, m2 - reach * s, m1 + reach, m2 + reach * s))
        for s in slopes
    ]


def extremes(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest element over all arrays."""
    return df.agg(
        F.min(F.array_min(column)).alias("min_value"), F.max(F.array_max(column)).alias("max_value")
    )


def varying(df: DataFrame, column: str, above: float) -> DataFrame:
    """Rows whose array has a population standard deviation above a bound."""
    return df.where(array_std(F.col(column)) > above)


def rescaled(df: DataFrame, column: str = "ts") -> DataFrame:
    return df.withColumn(column, rescale(F.col(column)))


def folded(df: DataFrame, period: int, how: str, column: str = "ts") -> DataFrame:
    """`time` adds up the repetitions of a period, `block` adds up each period."""
    fold = {"time": fold_period, "block": fold_block}[how]
    return df.withColumn(column, fold(F.col(column), period))


def color_map(scored: DataFrame, scale: float, name: str = "scores") -> DataFrame:
    """`x, y, r, g, b` from the first two scores."""
    r, g, b = polar_rgb(F.col(name)[0], F.col(name)[1], scale)
    return scored.select("x", "y", r.alias("r"), g.alias("g"), b.alias("b"))


def grid(df: DataFrame, value: str, xs: Sequence[int], keys: Sequence[str] = ("y",)) -> DataFrame:
    """One row per `y`, or per value of `keys`, with a column per given `x`."""
    return df.groupBy(*keys).pivot("x", list(xs)).agg(F.first(value))


# Colour scale of the three series pipelines.
SCALES = {"series": 1.0, "time": 3.0, "block": 2.0}


def series_pipeline(series: DataFrame, how: str, period: int, k: int = 3) -> tuple[Pca, DataFrame]:
    """Rescale, fold unless `how` is `series`, take components and colour every pixel."""
    data = rescaled(series).where(F.col("ts").isNotNull())
    if how != "series":
        data = folded(data, period, how)
    data = materialize(data, "rescaled-series")  # read by lengths, moments and scores
    model = pca(data, "ts", k)
    return model, color_map(scores(data, "ts", model), SCALES[how])


def standard_pairs(key: Sequence[Column], seed: int) -> tuple[Column, Column]:
    """Two independent standard normal draws per key, by the transform of Box and Muller.

    The uniform draws behind them are hashes of seed and key, so the same key has the same draws in
    every partitioning, order and run.
    """
    radius = F.sqrt(-2.0 * F.log(1.0 - unit_hash(F.lit(seed), *key, F.lit(0))))
    angle = 2.0 * F.pi() * unit_hash(F.lit(seed), *key, F.lit(1))
    return radius * F.cos(angle), radius * F.sin(angle)


def correlated_pairs(
    df: DataFrame, key: Sequence[str], mean: float, variance: float, cov: float, seed: int = 142, name: str = "p"
) -> DataFrame:
    """`df` with a point of two correlated coordinates per key."""
    slope = cov / variance**0.5
    rest = (variance - slope * slope) ** 0.5
    u, v = standard_pairs([F.col(k) for k in key], seed)
    return df.withColumn(name, F.array(u * variance**0.5 + mean, u * slope + v * rest + mean))


def gaussian_points(spark, n: int, mean: float, variance: float, cov: float, seed: int = 142) -> DataFrame:
    """`n` correlated points `p` of two coordinates."""
    return correlated_pairs(spark.range(n), ["id"], mean, variance, cov, seed)
