"""Column functions on numeric arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, also where the body is a lambda over elements."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)


def array_mean(a: Column) -> Column:
    """Mean of the elements; null for an empty array."""
    return F.try_divide(array_sum(a), F.size(a))


def array_std(a: Column) -> Column:
    """Population standard deviation of the elements."""
    squares = let(
        array_mean(a),
        lambda mean: F.aggregate(a, F.lit(0.0), lambda acc, v: acc + (v - mean) * (v - mean)),
    )
    return F.sqrt(F.try_divide(squares, F.size(a)))


def rescale(a: Column) -> Column:
    """`(v - mean) / mean` for every element; a null array when the mean is zero."""
    return let(
        array_mean(a), lambda mean: F.when(mean != 0, F.transform(a, lambda v: (v - mean) / mean))
    )


def fold_period(a: Column, period: int) -> Column:
    """Sum over repetitions: element `j` of the result adds `a[j], a[period + j], ...`."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(period - 1)),
        lambda j: F.aggregate(
            F.sequence(F.lit(0), (F.size(a) / period).cast("int") - 1),
            F.lit(0.0),
            lambda acc, k: acc + F.get(a, k * period + j),
        ),
    )


def fold_block(a: Column, period: int) -> Column:
    """Sum inside blocks: element `b` of the result adds the `period` values of block `b`."""
    return F.transform(
        F.sequence(F.lit(0), (F.size(a) / period).cast("int") - 1),
        lambda b: array_sum(F.slice(a, b * period + 1, F.lit(period))),
    )


def dot(features: Column, weights: Sequence[float]) -> Column:
    """`weights . features`, written out so that it compiles to straight arithmetic."""
    return reduce(add, [features[i] * F.lit(float(w)) for i, w in enumerate(weights)])


def gradient_summand(label: Column, features: Column, weights: Sequence[float]) -> Column:
    """`(w . x - y) x` of one labelled point."""
    residual = dot(features, weights) - label
    return F.transform(features, lambda v: v * residual)


def map_dot(a: Column, b: Column) -> Column:
    """Dot product of two sparse vectors held as maps."""
    return F.aggregate(
        F.map_entries(a),
        F.lit(0.0),
        lambda acc, e: acc + e["value"] * F.coalesce(F.try_element_at(b, e["key"]), F.lit(0.0)),
    )


def map_norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.map_values(a), F.lit(0.0), lambda acc, v: acc + v * v))


def map_cosine(a: Column, b: Column) -> Column:
    """Cosine of two sparse vectors; null when one of them is empty."""
    return F.try_divide(map_dot(a, b), map_norm(a) * map_norm(b))
