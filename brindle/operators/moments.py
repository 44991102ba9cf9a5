"""Second moments of numeric vectors: the only data-sized step of regression and PCA."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

# Up to this length the products are plain aggregate expressions; beyond it Arrow batches.
_EXPRESSION_LENGTH = 12
_SCHEMA = "part int, i int, total array<double>"


@dataclass(frozen=True)
class Moments:
    """`n`, the sum and the sum of outer products of vectors, taken around `origin`."""

    n: int
    total: np.ndarray
    outer: np.ndarray
    origin: np.ndarray | float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return self.origin + self.total / self.n

    @property
    def covariance(self) -> np.ndarray:
        """Population covariance, divided by `n`."""
        near = self.total / self.n
        return self.outer / self.n - np.outer(near, near)


def well_formed(vector: Column, d: int) -> Column:
    """Whether an array has `d` elements, none of them null."""
    return F.coalesce((F.size(vector) == d) & ~F.exists(vector, lambda v: v.isNull()), F.lit(False))


def vector_length(df: DataFrame, column: str) -> int:
    """The most frequent length of the arrays, the larger one of a tie."""
    row = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.size(column).alias("d"))
        .count()
        .orderBy(F.desc("count"), F.desc("d"))
        .first()
    )
    if row is None:
        raise ValueError("no vectors")
    return row["d"]


def vector_status(df: DataFrame, column: str, d: int | None = None) -> DataFrame:
    """One row `n_read, n_ok, n_bad`: how many arrays moments are taken of, and how many are left out."""
    good = well_formed(F.col(column), vector_length(df, column) if d is None else d)
    return df.agg(
        F.count(F.lit(1)).alias("n_read"), F.count_if(good).alias("n_ok"), F.count_if(~good).alias("n_bad")
    )


def _expression_moments(df: DataFrame, column: str, d: int, part: Column) -> dict[int, Moments]:
    v = [F.col(column)[i] for i in range(d)]
    sums = [F.sum(v[i]).alias(f"t{i}") for i in range(d)]
    products = [F.sum(v[i] * v[j]).alias(f"o{i}_{j}") for i in range(d) for j in range(i, d)]
    rows = (
        df.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("n"), *sums, *products)
        .collect()
    )
    found = {}
    for row in rows:
        outer = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                outer[i, j] = outer[j, i] = row[f"o{i}_{j}"]
        found[row["part"]] = Moments(row["n"], np.array([row[f"t{i}"] for i in range(d)]), outer)
    return found


def _good_rows(vectors: pa.ListArray, d: int) -> np.ndarray:
    """Which arrays have `d` elements, none of them null: `well_formed` for a batch."""
    size = pa.compute.list_value_length(vectors).fill_null(-1).to_numpy(zero_copy_only=False)
    good = size == d
    values = vectors.flatten()
    if values.null_count:
        owner = pa.compute.list_parent_indices(vectors).to_numpy(zero_copy_only=False)
        good[owner[values.is_null().to_numpy(zero_copy_only=False)]] = False
    return good


def _batch_moments(d: int, origin: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            good = _good_rows(batch.column("v"), d)
            if not good.any():
                continue
            batch = batch.filter(pa.array(good))
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - origin
            ones = np.column_stack([np.ones(len(values)), values])
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            for part in np.unique(parts):
                some = ones[parts == part]
                sums[int(part)] = sums.get(int(part), 0) + some.T @ some
        for part, matrix in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * (d + 1), pa.int32()),
                    pa.array(range(d + 1), pa.int32()),
                    pa.array(list(matrix), pa.list_(pa.float64())),
                ],
                ["part", "i", "total"],
            )

    return run


def _arrow_moments(
    df: DataFrame, column: str, d: int, part: Column, origin: np.ndarray | float = 0.0
) -> dict[int, Moments]:
    """Arrays are computed once and looked at in their batches: a filter before would make Spark
    compute the expression behind `column` again for every use."""
    vectors = df.select(part.cast("int").alias("part"), F.col(column).cast("array<double>").alias("v"))
    rows = (
        vectors
        .mapInArrow(_batch_moments(d, np.broadcast_to(origin, d)), _SCHEMA)
        .select("part", "i", F.posexplode("total").alias("j", "x"))
        .groupBy("part", "i", "j")
        .agg(F.sum("x").alias("x"))
        .collect()  # (d + 1)^2 numbers per part
    )
    full: dict[int, np.ndarray] = {}
    for row in rows:
        full.setdefault(row["part"], np.zeros((d + 1, d + 1)))[row["i"], row["j"]] = row["x"]
    return {p: Moments(int(m[0, 0]), m[0, 1:], m[1:, 1:], origin) for p, m in full.items()}


def moments_by(df: DataFrame, column: str, part: Column, d: int | None = None) -> dict[int, Moments]:
    """Moments of an array column for every value of a small integer column, in one pass.

    `d` is the length of the arrays, by default the most frequent one. Arrays of another length or
    with a null element are left out, whatever `d`; `vector_status` counts them.
    """
    d = vector_length(df, column) if d is None else d
    if d > _EXPRESSION_LENGTH:
        return _arrow_moments(df, column, d, part)
    return _expression_moments(df.where(well_formed(F.col(column), d)), column, d, part)


def moments(df: DataFrame, column: str, d: int | None = None) -> Moments:
    """Moments of an array column in one pass, see `moments_by`.

    Products are taken around the first vector found, which keeps the covariance of data far from
    the origin accurate.
    """
    d = vector_length(df, column) if d is None else d
    first = df.where(well_formed(F.col(column), d)).select(column).first()
    if first is None:
        raise ValueError("no vectors")
    pivot = np.array(first[0], dtype=float)
    if d > _EXPRESSION_LENGTH:
        return _arrow_moments(df, column, d, F.lit(0), pivot)[0]
    near = F.array(*[F.lit(-float(p)) for p in pivot])
    centred = df.where(well_formed(F.col(column), d)).select(F.zip_with(column, near, lambda x, y: x + y).alias("v"))
    return replace(moments_by(centred, "v", F.lit(0), d)[0], origin=pivot)
