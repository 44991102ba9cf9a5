"""Alternating least squares over ratings that are packed once and do not travel again.

Users and items lie in blocks by a hash. The ratings are written twice as compressed cells, one of a user
block and an item block each: by item block, to solve for items, and by user block, to solve for users. A half
step has one task per block that is solved for; it reads the written factors of the other side block after
block, meets each with its cell, and holds only the sums of its own block. So neither ratings nor factors are
exchanged in an iteration, and what an iteration writes are the factors themselves. Models of several ranks
are trained together, over the same cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, functions as F

from brindle.session import free, materialize

# A block has about this many ids and ratings at most; ratings of one id are never parted.
BLOCK_IDS = 1 << 16
BLOCK_RATINGS = 1 << 23
# Fewer ratings than this are not worth a block.
LEAST_RATINGS = 1 << 17
# Ratings that are packed, and that are summed, at a time.
_PACK_ROWS = 1 << 21
_SUM_ROWS = 1 << 18
# More ratings of an id than this are multiplied on their own.
_LONG = 64
# Blocks are solved so many ids at a time.
_SOLVE_IDS = 1 << 12

_CELL = "part int, of int, n long, own binary, other binary, value binary"
_BLOCK = "block int, ids binary, features binary"
_VALUES = {"float": np.float32, "double": np.float64}


@dataclass(frozen=True)
class FactorModel:
    """A trained model: its columns, from `start` on, of the written factors of users and items."""

    rank: int
    start: int
    users: DataFrame
    items: DataFrame
    blocks: tuple[int, int]

    @property
    def userFactors(self) -> DataFrame:
        """`id, features` of every user, as in a model of the library."""
        return _factors(self.users, self.start, self.rank)

    @property
    def itemFactors(self) -> DataFrame:
        """`id, features` of every item."""
        return _factors(self.items, self.start, self.rank)


# --- cells --------------------------------------------------------------------------------------


def _shrunk(values: np.ndarray) -> bytes:
    """Compressed; bytes of the same place lie side by side."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _restored(data: pa.Buffer, n: int, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(n)


def _entries(row: dict, dtype: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own ids in order, the ids of the other side and the values of a cell."""
    n = row["n"].as_py()
    steps = _restored(row["own"].as_buffer(), n, np.int32)
    others = _restored(row["other"].as_buffer(), n, np.int32)
    return np.cumsum(steps, dtype=np.int32), others, _restored(row["value"].as_buffer(), n, dtype)


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i] for name in batch.schema.names}


def _cells_of(part: np.ndarray, of: np.ndarray, own: np.ndarray, other: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    """One row per cell, its entries ordered by own id. Steps between ids may wrap around, as their sum does."""
    cell = part.astype(np.int64) * (int(of.max()) + 1) + of
    order = np.argsort((cell << 32) + own)
    cell = cell[order]
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    rows = []
    for a, b in zip(starts, [*starts[1:], len(order)]):
        at = order[a:b]
        steps = np.diff(own[at], prepend=np.int32(0))
        rows.append((part[at[0]], of[at[0]], b - a, _shrunk(steps), _shrunk(other[at]), _shrunk(value[at])))
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(arrays, ["part", "of", "n", "own", "other", "value"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        return _cells_of(*[rows.column(c).to_numpy() for c in ("part", "of", "own", "other", "value")])

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= _PACK_ROWS:
            yield packed(held)
            held, n = [], 0
    if held:
        yield packed(held)


def _merge(dtype: type) -> Callable[[pa.Table], pa.Table]:
    def run(cell: pa.Table) -> pa.Table:
        if cell.num_rows == 1:
            return cell
        own, other, value = (np.concatenate(c) for c in zip(*[_entries(row, dtype) for row in _rows(cell)]))
        part, of = (np.full(len(own), cell.column(c)[0].as_py(), np.int32) for c in ("part", "of"))
        return pa.Table.from_batches([_cells_of(part, of, own, other, value)])

    return run


def _whole(name: str) -> Column:
    """An id; as in the library, others than whole numbers of 32 bits are refused."""
    column, whole = F.col(name), F.col(name).try_cast("int")
    found = whole.isNotNull() & (whole == column)
    return F.when(found, whole).otherwise(F.raise_error(F.concat(F.lit(f"no whole number of 32 bits as {name}: "), F.coalesce(column.cast("string"), F.lit("null")))))


def _block(column: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def _cells(pairs: DataFrame, blocks: tuple[int, int], kind: str) -> DataFrame:
    """`pairs(user, item, value)` written in cells, in a folder per block of items.

    Ratings are packed where they are read; only compressed cells are exchanged.
    """
    rows = pairs.select(_whole("item").alias("own"), _whole("user").alias("other"), F.col("value").cast(kind).alias("value"))
    rows = rows.select(_block(F.col("own"), blocks[1]).alias("part"), _block(F.col("other"), blocks[0]).alias("of"), "own", "other", "value")
    merged = rows.mapInArrow(_pack, _CELL).groupBy("part", "of").applyInArrow(_merge(_VALUES[kind]), _CELL)
    return materialize(merged, "cells-by-item", "part")


def _turned(cells: DataFrame, kind: str, name: str) -> DataFrame:
    """The same cells written by their other block, with the other ids as their own. None is exchanged."""
    dtype = _VALUES[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                own, other, value = _entries(row, dtype)
                part, of = (np.full(len(own), row[c].as_py(), np.int32) for c in ("part", "of"))
                yield _cells_of(of, part, other, own, value)

    return materialize(cells.mapInArrow(run, _CELL), name, "part")


def _blocks(ratings: DataFrame) -> tuple[int, int, int]:
    """How many ratings there are, and blocks for users and items."""
    count = ratings.agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("user").alias("user"), F.approx_count_distinct("item").alias("item")
    ).first()
    least = min(ratings.sparkSession.sparkContext.defaultParallelism, -(-count["n"] // LEAST_RATINGS))
    users, items = (max(least, -(-count[c] // BLOCK_IDS), -(-count["n"] // BLOCK_RATINGS)) for c in ("user", "item"))
    return count["n"], users, items


def _meet(cells: DataFrame, factors: DataFrame, parts: int, own: DataFrame | None = None) -> DataFrame:
    """Every cell with the factors of the block it names; a partition has the cells of one part.

    The cells of a part are held and the written factors read past them, a row per block, so nothing is
    exchanged: the hint names the only join that Spark never plans an exchange for, whatever the sizes. With
    `own`, the factors of the part itself are there too.
    """
    own = own and own.withColumnsRenamed({"block": "own_block", "ids": "own_ids", "features": "own_features"})

    def of_part(d: int) -> DataFrame:
        mine = cells.where(F.col("part") == d).coalesce(1).hint("shuffle_replicate_nl")
        met = factors.coalesce(1).join(mine, F.col("block") == F.col("of"))
        if own:
            block = own.where(F.col("own_block") == d).coalesce(1).hint("shuffle_replicate_nl")
            met = met.join(block, F.col("part") == F.col("own_block"))
        return met

    return reduce(DataFrame.union, [of_part(d) for d in range(parts)])


# --- half steps ---------------------------------------------------------------------------------


def _features(row: dict, ids: str = "ids", features: str = "features") -> tuple[np.ndarray, np.ndarray]:
    known = np.frombuffer(row[ids].as_buffer(), np.int32)
    return known, np.frombuffer(row[features].as_buffer(), np.float32).reshape(len(known), -1)


class _Sums:
    """Per id of a block and rank, the sums of the products, two by two, of the factors and the rating."""

    def __init__(self, ranks: Sequence[int]) -> None:
        ends = np.cumsum(ranks)
        self.spans = [(int(e - r), int(e)) for r, e in zip(ranks, ends)]
        self.ids, self.places = np.zeros(0, np.int32), np.zeros(0, np.int64)
        # ids lie in the order in which they came; the last is the number of ratings
        self.sums = [np.zeros((1024, r + 1, r + 1)) for r in ranks] + [np.zeros(1024)]
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _places(self, ids: np.ndarray) -> np.ndarray:
        """The places of distinct ids in order; unknown ones get the next."""
        at = np.searchsorted(self.ids, ids)
        known = np.zeros(len(ids), bool)
        inside = at < len(self.ids)
        known[inside] = self.ids[at[inside]] == ids[inside]
        if not known.all():
            n, new = len(self.ids), ~known
            self.places = np.insert(self.places, at[new], np.arange(n, n + new.sum()))
            self.ids = np.insert(self.ids, at[new], ids[new])
            if len(self.ids) > len(self.sums[-1]):
                size = max(len(self.ids), 2 * len(self.sums[-1]))
                for k, old in enumerate(self.sums):
                    self.sums[k] = np.zeros((size, *old.shape[1:]))
                    self.sums[k][:n] = old[:n]
            at = np.searchsorted(self.ids, ids)
        return self.places[at]

    def add(self, own: np.ndarray, factors: np.ndarray, ratings: np.ndarray) -> None:
        """Entries are held until there are enough of them to sum many of an id together."""
        for a in range(0, len(own), _SUM_ROWS):
            self.held.append((own[a : a + _SUM_ROWS], factors[a : a + _SUM_ROWS], ratings[a : a + _SUM_ROWS]))
            if sum(len(h[0]) for h in self.held) >= _SUM_ROWS:
                self._sum()

    def _sum(self) -> None:
        own, factors, ratings = (np.concatenate(c) for c in zip(*self.held))
        self.held = []
        order = np.argsort(own, kind="stable")
        own, factors, ratings = own[order], factors[order], ratings[order]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        lengths = np.diff(starts, append=len(own))
        places = self._places(own[starts])
        self.sums[-1][places] += lengths
        by = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(lengths[by]) > 0, True])
        for sums, (b, e) in zip(self.sums, self.spans):
            rows = np.column_stack([factors[:, b:e], ratings]).astype(np.float64)
            for first, last in zip(edges[:-1], edges[1:]):
                same = by[first:last]
                length = lengths[same[0]]
                if length > _LONG:
                    for i in same:
                        mine = rows[starts[i] : starts[i] + length]
                        sums[places[i]] += mine.T @ mine
                else:  # as many rows per id: together
                    mine = rows[starts[same][:, None] + np.arange(length)]
                    sums[places[same]] += mine.transpose(0, 2, 1) @ mine

    def solve(self, reg: float) -> np.ndarray:
        """The factors of all ids, in the order of the ids."""
        if self.held:
            self._sum()
        found = np.zeros((len(self.ids), self.spans[-1][1]), np.float32)
        for a in range(0, len(self.ids), _SOLVE_IDS):
            places = self.places[a : a + _SOLVE_IDS]
            penalty = reg * self.sums[-1][places, None, None]
            for sums, (b, e) in zip(self.sums, self.spans):
                mine = sums[places]
                left = mine[:, :-1, :-1] + penalty * np.eye(e - b)
                found[a : a + _SOLVE_IDS, b:e] = np.linalg.solve(left, mine[:, :-1, -1:])[:, :, 0]
        return found


def _solver(ranks: Sequence[int], reg: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def solved(part: int, sums: _Sums) -> pa.RecordBatch:
        factors = sums.solve(reg)
        arrays = [pa.array([part], pa.int32()), pa.array([sums.ids.tobytes()]), pa.array([factors.tobytes()])]
        return pa.RecordBatch.from_arrays(arrays, ["block", "ids", "features"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = None, None
        for batch in batches:
            for row in _rows(batch):
                if row["part"].as_py() != part:
                    if sums:
                        yield solved(part, sums)
                    part, sums = row["part"].as_py(), _Sums(ranks)
                own, other, ratings = _entries(row, np.float32)
                ids, features = _features(row)
                sums.add(own, features[np.searchsorted(ids, other)], ratings)
        if sums:
            yield solved(part, sums)

    return run


def _first_factors(users: DataFrame, ranks: Sequence[int], seed: int, blocks: int) -> DataFrame:
    """`block, ids, features`: what the library starts from, which follows from the ids of the users."""
    cores = max(10, users.sparkSession.sparkContext.defaultParallelism)
    users = materialize(users, "users")  # each drawing reads them
    rated = users.select("user", F.col("user").alias("item"), F.lit(0.0).alias("rating"))
    drawn = []
    for i, rank in enumerate(ranks):
        als = ALS(userCol="user", itemCol="item", ratingCol="rating", rank=rank, maxIter=0, seed=seed, numUserBlocks=cores, numItemBlocks=cores)
        drawn.append(als.fit(rated).userFactors.select("id", F.col("features").alias(f"f{i}")))
    joined = reduce(lambda left, right: left.join(right, "id"), drawn)
    rows = joined.select(_block(F.col("id"), blocks).alias("block"), "id", F.concat(*[f"f{i}" for i in range(len(ranks))]).alias("features"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids = table.column("id").to_numpy().astype(np.int32)
        features = table.column("features").combine_chunks().flatten().to_numpy().astype(np.float32)
        columns = [pa.array([table.column("block")[0].as_py()], pa.int32()), pa.array([ids.tobytes()]), pa.array([features.tobytes()])]
        return pa.table(columns, names=["block", "ids", "features"])

    first = materialize(rows.groupBy("block").applyInArrow(pack, _BLOCK), "first-factors")
    free(users)
    return first


def train(ratings: DataFrame, ranks: Sequence[int], iterations: int, reg: float, seed: int) -> list[FactorModel]:
    """A model per rank, as `pyspark.ml` trains it one by one: the same start, the same half steps in double
    precision and factors in single precision, the penalty `reg` times the number of ratings of an id.

    `ratings(user, item, rating)` are read more than once, so they should be a written table.
    """
    n, n_users, n_items = _blocks(ratings)
    if not n or iterations < 1:
        raise ValueError("no ratings to train on" if not n else "no iterations")
    usable = F.abs(F.col("rating").cast("float")) < F.lit(float("inf"))  # greater than which is NaN
    value = F.when(usable, F.col("rating")).otherwise(F.raise_error(F.lit("a rating is null or not a finite number")))
    rated = ratings.select("user", "item", value.alias("value"))
    blocks = n_users, n_items
    by_item = _cells(rated, blocks, "float")
    by_user = _turned(by_item, "float", "cells-by-user")
    users = _first_factors(ratings.select(_whole("user").alias("user")).distinct(), ranks, seed, n_users)
    items = None
    solve = _solver(ranks, reg)
    for _ in range(iterations):
        old = [users] if items is None else [users, items]
        items = materialize(_meet(by_item, users, n_items).mapInArrow(solve, _BLOCK), "item-factors")
        users = materialize(_meet(by_user, items, n_users).mapInArrow(solve, _BLOCK), "user-factors")
        free(*old)
    free(by_item, by_user)
    starts = np.cumsum([0, *ranks])
    return [FactorModel(rank, int(start), users, items, blocks) for rank, start in zip(ranks, starts)]


# --- use of the factors -------------------------------------------------------------------------


def _factors(blocks: DataFrame, start: int, rank: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                ids, features = _features(row)
                mine = np.ascontiguousarray(features[:, start : start + rank]).reshape(-1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * rank), pa.array(mine))
                yield pa.RecordBatch.from_arrays([pa.array(ids), lists], ["id", "features"])

    return blocks.mapInArrow(run, "id int, features array<float>")


def _predicted(row: dict, spans: Sequence[tuple[int, int]]) -> Iterator[tuple[np.ndarray, ...]]:
    """`own, other, value` of the entries of a cell whose ids are known, and their prediction by every span."""
    own, other, value = _entries(row, np.float64)
    (own_ids, own_x), (ids, x) = _features(row, "own_ids", "own_features"), _features(row)
    at, own_at = (np.minimum(np.searchsorted(k, v), len(k) - 1) for k, v in ((ids, other), (own_ids, own)))
    known = np.flatnonzero((ids[at] == other) & (own_ids[own_at] == own))
    for a in range(0, len(known), _SUM_ROWS):
        here = known[a : a + _SUM_ROWS]
        left, right = x[at[here]], own_x[own_at[here]]
        found = [np.einsum("ij,ij->i", left[:, b:e], right[:, b:e]) for b, e in spans]  # of single precision
        yield own[here], other[here], value[here], np.array(found, np.float64)


def predict(model: FactorModel, pairs: DataFrame) -> DataFrame:
    """`user, item, rating` predicted for every row of `pairs(user, item)` whose user and item are known."""
    cells = _cells(pairs.select("user", "item", F.lit(0.0).alias("value")), model.blocks, "double")
    spans = [(model.start, model.start + model.rank)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                for item, user, _, found in _predicted(row, spans):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (user, item, found[0])], ["user", "item", "rating"])

    met = _meet(cells, model.users, model.blocks[1], model.items)
    # written, as each later exchange would plan the parts again
    found = materialize(met.mapInArrow(run, "user int, item int, rating double"), "predicted")
    free(cells)
    return found


def errors(models: Sequence[FactorModel], actual: DataFrame) -> list[float | None]:
    """RMSE over the rated, known pairs of `actual(user, item, rating)` for models trained together, in one pass."""
    rated = actual.where("user is not null and item is not null and rating is not null")
    blocks, spans = models[0].blocks, [(m.start, m.start + m.rank) for m in models]
    cells = _cells(rated.select("user", "item", F.col("rating").alias("value")), blocks, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, squares = 0, np.zeros(len(spans))
        for batch in batches:
            for row in _rows(batch):
                for _, _, value, found in _predicted(row, spans):
                    n += len(value)
                    squares += ((found - value) ** 2).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([squares.tolist()])], ["n", "squares"])

    met = _meet(cells, models[0].users, blocks[1], models[0].items)
    squares = materialize(met.mapInArrow(run, "n long, squares array<double>"), "squares")
    sums = [F.sum(F.col("squares")[i]).alias(f"squares_{i}") for i in range(len(spans))]
    found = squares.agg(F.sum("n").alias("n"), *sums).first()
    free(cells, squares)
    if not found["n"]:
        return [None] * len(models)
    return [float(np.sqrt(found[f"squares_{i}"] / found["n"])) for i in range(len(models))]
