"""Group-wise numbering and splitting that hold when one group is very large."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.arrays import let
from brindle.session import materialize

# A group of more rows than this is never handed to a single task. Joins against the few rows kept
# per hot group go through a written table: it is broadcast when small, and otherwise adaptive
# execution may split the hot side.
HOT_ROWS = 1_000_000

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its lower 33 bits


def match_keys(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join with a table of groups where a null key matches a null key; keeps the keys of `df`."""
    other = groups.withColumnsRenamed({k: f"_group_{k}" for k in keys})
    same = [df[k].eqNullSafe(other[f"_group_{k}"]) for k in keys]
    joined = df.join(other, reduce(and_, same), how)
    return joined.drop(*[f"_group_{k}" for k in keys])


def hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys with more than `max_rows` rows and their size. At most `total / max_rows` rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("group_rows"))
        .where(F.col("group_rows") > max_rows)
    )


def global_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx") -> DataFrame:
    """0-based position of every row in the total order, without a single-task window.

    The sorted rows are written once, so that the counts per partition and the final offsets see
    the same partition boundaries; only one row per partition is broadcast.
    """
    placed = materialize(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "global-index"
    )
    placed = placed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + row).alias(name)
    )


def group_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "idx",
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """0-based position of every row inside its group; null keys make a group too.

    Normal groups use a window. Groups above `max_rows` are numbered by a distributed sort.
    """
    keys = list(keys)
    windowed = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1
    hot = materialize(hot_groups(df, keys, max_rows).select(*keys), "hot-groups")
    if hot.isEmpty():
        return df.withColumn(name, windowed)
    cold = match_keys(df, hot, keys, "left_anti").withColumn(name, windowed)
    ranked = global_index(match_keys(df, hot, keys, "left_semi"), [*keys, *order], "_rank")
    first = materialize(ranked.groupBy(*keys).agg(F.min("_rank").alias("_first")), "group-starts")
    warm = match_keys(ranked, first, keys, "inner").withColumn(name, F.col("_rank") - F.col("_first"))
    return cold.unionByName(warm.select(*df.columns, name))


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float],
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Assign every row to one of `len(weights)` splits by a hash of its key.

    Unlike `randomSplit` the outcome depends neither on partitioning nor on recomputation.
    """
    total = float(sum(weights))

    def place(draw: Column) -> Column:
        bound = 0.0
        split: Column | None = None
        for i, weight in enumerate(weights[:-1]):
            bound += weight / total
            hit = draw < F.lit(bound)
            split = F.when(hit, i) if split is None else split.when(hit, i)
        last = F.lit(len(weights) - 1)
        return last if split is None else split.otherwise(last)

    return df.withColumn(name, let(unit_hash(F.lit(seed), *[F.col(k) for k in keys]), place))


def unit_hash(*parts: Column) -> Column:
    """A repeatable draw from [0, 1) per distinct combination of `parts`; null is a value of its own."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\0")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
