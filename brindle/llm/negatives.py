"""Hard negatives by exact inner-product search with pruning on lengths and on single coordinates.

Rows are sorted by length (norm). A bucket is a run of rows of about equal length with one sorted list
per coordinate. An anchor that needs a score of `t` skips all buckets too short for it. In a longer
one it takes its largest coordinates: the angle between anchor and row bounds what the row may have
there, so each gives a range of a sorted list, and only rows in all ranges are verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from brindle.operators.grouping import global_index
from brindle.session import materialize

BUCKET_ROWS = 2048
FOCUS = 4
_SLACK = 1e-9  # of rounding in the bounds, which are no sums of whole numbers
_EXACT = float(1 << 53)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy())
    matrix = np.zeros((len(lists), width), np.int64)
    matrix[np.arange(width) < size[:, None]] = lists.flatten().to_numpy()
    return matrix


class Bucket:
    """Rows of falling length, with a list per coordinate that is sorted when first asked for."""

    def __init__(self, ids: np.ndarray, places: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.places, self.labels, self.vectors = ids, places, labels, vectors
        self.floats = vectors.astype(np.float64)
        self.largest = float(np.abs(self.floats).max(initial=0.0))
        norms = np.sqrt((self.floats**2).sum(1))
        self.longest = float(norms.max(initial=0.0))
        self.units = self.floats / np.maximum(norms, 1e-300)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows by their share of coordinate `f`, and these shares."""
        if f not in self._lists:
            by = np.argsort(self.units[:, f], kind="stable")
            self._lists[f] = by, self.units[by, f]
        return self._lists[f]

    def feasible(self, unit: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray:
        """Rows whose focus coordinates all allow an angle with the anchor of at least `cosine`."""
        spread = math.acos(min(cosine, 1.0))
        hits = np.zeros(len(self.ids), np.int8)
        for f in focus:
            by, shares = self.sorted_list(int(f))
            angle = math.acos(min(max(float(unit[f]), -1.0), 1.0))
            low = math.cos(min(angle + spread, math.pi)) - _SLACK
            high = math.cos(max(angle - spread, 0.0)) + _SLACK
            hits[by[np.searchsorted(shares, low) : np.searchsorted(shares, high, side="right")]] += 1
        return np.flatnonzero(hits == len(focus))

    def scores(self, rows: np.ndarray, anchor: np.ndarray, largest: float) -> np.ndarray:
        """Whole inner products; by floats where these are exact."""
        if largest * self.largest * len(anchor) < _EXACT:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchor


class Anchor:
    """A vector that looks for rows, with what bounds need."""

    def __init__(self, vector: np.ndarray) -> None:
        self.vector = vector
        floats = vector.astype(np.float64)
        self.largest = float(np.abs(floats).max(initial=0.0))
        self.norm = float(np.sqrt((floats**2).sum()))
        self.unit = floats / max(self.norm, 1e-300)
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:FOCUS]

    def candidates(self, bucket: Bucket, least: float) -> np.ndarray | None:
        """Rows that may score `least` or more; None if no row of this length or less can."""
        if least <= 0:
            return np.arange(len(bucket.ids))
        reach = self.norm * bucket.longest
        if reach * (1 + _SLACK) < least:
            return None
        return bucket.feasible(self.unit, self.focus, least / reach * (1 - _SLACK))


def _best(held: tuple, scores: np.ndarray, ids: np.ndarray, places: np.ndarray, most: int) -> tuple:
    """The first `most` of held and new rows: higher scores, then smaller ids, then earlier rows."""
    scores, ids, places = (np.concatenate(c) for c in zip(held, (scores, ids, places)))
    by = np.lexsort((places, ids, -scores))[:most]
    return scores[by], ids[by], places[by]


_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _last(held: tuple, most: int) -> float:
    return float(held[0][-1]) if len(held[0]) == most else -math.inf


def nearest(anchor: Anchor, buckets: list[Bucket], label: int, place: int, most: int) -> tuple:
    """The `most` best other rows of the label: scores, ids, places."""
    held = _NONE
    for bucket in buckets:
        rows = anchor.candidates(bucket, _last(held, most))
        if rows is None:
            break
        rows = rows[(bucket.labels[rows] == label) & (bucket.places[rows] != place)]
        held = _best(held, bucket.scores(rows, anchor.vector, anchor.largest), bucket.ids[rows], bucket.places[rows], most)
    return held


def within(
    anchor: Anchor, buckets: list[Bucket], label: int, ranges: list[tuple[int, int]], most: int
) -> list[tuple]:
    """For each range of scores, the `most` best rows of other labels in it."""
    held = [_NONE for _ in ranges]
    for bucket in buckets:
        least = min(max(low, _last(h, most)) for (low, _), h in zip(ranges, held))
        rows = anchor.candidates(bucket, least)
        if rows is None:
            break
        rows = rows[bucket.labels[rows] != label]
        scores = bucket.scores(rows, anchor.vector, anchor.largest)
        for i, (low, high) in enumerate(ranges):
            fits = (scores >= low) & (scores <= high)
            held[i] = _best(held[i], scores[fits], bucket.ids[rows[fits]], bucket.places[rows[fits]], most)
    return held


def _buckets(table: pa.Table, width: int) -> list[Bucket]:
    table = table.sort_by("place")
    ids, places, labels = (table.column(c).to_numpy() for c in ("id", "place", "label"))
    vectors = _matrix(table.column("v"), width)
    cuts = range(0, len(ids), BUCKET_ROWS)
    return [Bucket(*(c[a : a + BUCKET_ROWS] for c in (ids, places, labels, vectors))) for a in cuts]


def _anchors(table: pa.Table, width: int) -> Iterator[tuple[dict, Anchor]]:
    rows = table.drop_columns(["v"]).to_pylist()
    for row, vector in zip(rows, _matrix(table.column("v"), width)):
        yield row, Anchor(vector)


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """`id, label, v` of `vectors(vec_id, embedding, label)`: components become `floor(scale * x)`.

    Rows with a null id, label, vector or component, or a component that is not finite, are left out.
    """
    fine = "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = vectors.where("vec_id is not null and label is not null and embedding is not null").where(F.expr(fine))
    return rows.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


def mine_negatives(
    rows: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    percent: tuple[int, int] = (30, 90),
    group_rows: int = 8192,
    part_anchors: int = 16_384,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    Reads `rows(id, label, v array<long>)`; anchors are rows whose id is divisible by `every`. The
    score of two rows is their inner product, which must fit 64 bits; a shorter vector counts as
    filled with zeros. An anchor's positives are its `positives` best other rows of the same label.
    Each gets the `negatives` best rows of other labels whose score is between both `percent` of the
    positive's. Equal scores are ordered by id. Repeated rows are rows of their own; anchors without
    positives and positives without negatives have no rows, nor has an empty table.

    Every anchor meets every group of `group_rows` rows, so `anchors * rows / group_rows` vectors of
    anchors are moved; a cell of one group and about `part_anchors` anchors is what a task holds.
    """
    rows = rows.select("id", "label", "v").withColumn("norm", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    placed = materialize(global_index(rows, [F.desc("norm"), "id"], "place").drop("norm"), "vectors")
    count, width = placed.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(width or 0, 1)
    groups = max(1, -(-count // group_rows))
    anchors = placed.where(F.col("id") % every == 0)
    parts = max(1, -(-anchors.count() // part_anchors))
    grouped = placed.withColumn("group", F.expr(f"place div {group_rows}"))
    cells = grouped.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).groupBy("group", "part")

    def meet(who: DataFrame, run, schema: str) -> DataFrame:
        """`run` on each cell: the anchors of a part against the rows of a group."""
        dealt = who.withColumns(
            {
                "in_part": F.pmod(F.xxhash64("place"), F.lit(parts)).cast("int"),
                "in_group": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))),
            }
        )
        return cells.cogroup(dealt.groupBy("in_group", "in_part")).applyInArrow(run, schema)

    def near(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        buckets, found = _buckets(left, width), []
        for row, anchor in _anchors(right, width):
            held = nearest(anchor, buckets, row["label"], row["place"], positives)
            found += [(row["place"], *(int(x) for x in hit)) for hit in zip(*held)]
        return _table(found, ["place", "score", "positive_id", "positive_place"])

    def far(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        buckets, found = _buckets(left, width), []
        for row, anchor in _anchors(right, width):
            bounds = [(-(-percent[0] * p["score"] // 100), percent[1] * p["score"] // 100) for p in row["positives"]]
            some = [(p, b) for p, b in zip(row["positives"], bounds) if b[0] <= b[1]]
            if some:
                held = within(anchor, buckets, row["label"], [b for _, b in some], negatives)
                for (p, _), hits in zip(some, held):
                    mine = (row["id"], row["place"], p["positive_id"], p["positive_place"], p["score"])
                    found += [(*mine, int(s), int(i)) for s, i in zip(*hits[:2])]
        return _table(found, _FAR)

    by_score = Window.partitionBy("place").orderBy(F.desc("score"), "positive_id", "positive_place")
    pairs = meet(anchors, near, "place long, score long, positive_id long, positive_place long")
    best = pairs.withColumn("at", F.row_number().over(by_score)).where(F.col("at") <= positives)
    held = best.groupBy("place").agg(F.collect_list(F.struct("score", "positive_id", "positive_place")).alias("positives"))
    known = materialize(anchors.join(held, "place"), "anchors")
    hits = materialize(meet(known, far, ", ".join(f"{c} long" for c in _FAR)), "negatives")
    order = Window.partitionBy("anchor_place", "positive_place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


_FAR = ["anchor_id", "anchor_place", "positive_id", "positive_place", "positive_score", "negative_score", "negative_id"]


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)
