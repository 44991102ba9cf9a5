"""Quality classifier: a generalised additive model with pairwise interactions on text measures."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brindle.llm.joins import text_mark, without
from brindle.llm.texts import (
    Texts,
    find_words,
    line_spans,
    lower_ascii,
    per_text,
    ranked,
    slices,
    window_hashes,
    word_hashes,
)
from brindle.session import materialize

MEASURES = (
    "log_bytes",
    "log_words",
    "word_bytes",
    "long_words",
    "short_words",
    "upper_share",
    "digit_share",
    "symbol_share",
    "mark_share",
    "bar_share",
    "stop_share",
    "comma_share",
    "high_share",
    "line_bytes",
    "distinct_words",
    "repeated_runs",
    "next_equal",
    "dup_lines",
)

_CLASS = np.zeros((256, 7), dtype=np.int64)
_CLASS[0x41:0x5B, 0] = 1
_CLASS[0x30:0x3A, 1] = 1
_CLASS[[ord(c) for c in "#*$%&<>"], 2] = 1
_CLASS[[ord(c) for c in "!?"], 3] = 1
_CLASS[ord("|"), 4] = 1
_CLASS[[ord(c) for c in ".;:"], 5] = 1
_CLASS[ord(","), 6] = 1


def measure(texts: Texts) -> np.ndarray:
    """One row of `MEASURES` per text, from its bytes, words and lines; an empty text has zeros."""
    data, offsets = texts.data, texts.offsets
    n, size = len(offsets) - 1, np.diff(offsets)
    words = find_words(data, offsets)
    count = np.diff(words.offsets)
    hashes = word_hashes(lower_ascii(data), words)
    length = words.ends - words.starts
    owner = np.repeat(np.arange(n), count)
    classes = [per_text(_CLASS[:, k][data], offsets) for k in range(_CLASS.shape[1])]
    high = per_text(data >= 0x80, offsets)
    later, _ = ranked(hashes, owner)
    distinct = count - np.bincount(owner[later], minlength=n)
    runs, run_bounds = window_hashes(hashes, words.offsets, 3)
    run_owner = np.repeat(np.arange(n), np.diff(run_bounds))
    again = np.bincount(run_owner[ranked(runs, run_owner)[1]], minlength=n)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])

    lines = line_spans(data, offsets)
    filled = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    line_owner = np.repeat(np.arange(n), np.diff(lines.offsets))[filled]
    line_hash = word_hashes(data, lines)[filled]
    dup_lines = np.bincount(line_owner[ranked(line_hash, line_owner)[0]], minlength=n)
    filled = np.bincount(line_owner, minlength=n)

    some, bytes_ = np.maximum(count, 1), np.maximum(size, 1)
    columns = [
        np.log1p(size),
        np.log1p(count),
        np.bincount(owner, length, n) / some,
        np.bincount(owner, length > 12, n) / some,
        np.bincount(owner, length <= 3, n) / some,
        *(classes[k] / bytes_ for k in range(7)),
        high / bytes_,
        size / np.diff(lines.offsets),
        distinct / some,
        again / np.maximum(np.diff(run_bounds), 1),
        np.bincount(owner, same, n) / some,
        dup_lines / np.maximum(filled, 1),
    ]
    return np.stack(columns, 1)


@dataclass
class AdditiveModel:
    """`intercept + sum of tables[f][bin of f] + sum of pair_tables[p][coarse bins of p]`, as log-odds."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of measures: one addition per table."""
        total = np.full(len(x), self.intercept)
        fine = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]
        for f, table in enumerate(self.tables):
            total += table[fine[f]]
        for (f, g), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[self.coarse[f][fine[f]], self.coarse[g][fine[g]]]
        return 1 / (1 + np.exp(-total))


def _leaf(g: float, h: float) -> float:
    return g / (h + 1.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values per bin of a tree on one feature: the best cut of any part, until there are `leaves`."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], k, a + at + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    values = np.zeros(len(g))
    for a, b in parts:
        values[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return values


def _best_quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of each side of a pair of features: gain, and values per pair of bins."""
    cg = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    ch = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n, m = g.shape
    if n < 2 or m < 2:
        return 0.0, np.zeros_like(g)
    i, j = np.meshgrid(np.arange(1, n), np.arange(1, m), indexing="ij")
    parts = []
    for c in (cg, ch):
        a = c[i, j]
        b, d = c[i, m] - a, c[n, j] - a
        parts.append((a, b, d, c[n, m] - a - b - d))
    gain = sum(x**2 / (y + 1) for x, y in zip(*parts, strict=True)) - cg[n, m] ** 2 / (ch[n, m] + 1)
    at = np.unravel_index(np.argmax(gain), gain.shape)
    values = np.zeros_like(g)
    cut = (int(i[at]), int(j[at]))
    for q, (rows, cols) in enumerate(
        [
            (slice(0, cut[0]), slice(0, cut[1])),
            (slice(0, cut[0]), slice(cut[1], m)),
            (slice(cut[0], n), slice(0, cut[1])),
            (slice(cut[0], n), slice(cut[1], m)),
        ]
    ):
        values[rows, cols] = _leaf(parts[0][q][at], parts[1][q][at])
    return float(gain[at]), values


def fit_additive(
    x: np.ndarray,
    y: np.ndarray,
    bins: int = 32,
    rounds: int = 150,
    leaves: int = 3,
    pairs: int = 6,
    pair_rounds: int = 50,
    rate: float = 0.1,
) -> AdditiveModel:
    """Cyclic boosting: every round gives each feature in turn one shallow tree on the gradient, added
    to its table; then the pairs with the best cuts are boosted in the same way.

    Without rows, or with one class only, the model is the share of label 1, kept off 0 and 1.
    """
    features = x.shape[1]
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    coarse = [(np.arange(len(e) + 1) * 8 // (len(e) + 1)) for e in edges]
    model = AdditiveModel(edges, [np.zeros(len(e) + 1) for e in edges], coarse)
    positive, total = float(y.sum()), len(y)
    share = (positive + 1) / (total + 2)
    model.intercept = float(np.log(share / (1 - share)))
    if not total or positive in (0, total):
        return model
    fine = [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T, strict=True)]
    logit = np.full(total, model.intercept)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(features):
            g, h = gradients()
            size = len(model.tables[f])
            tree = rate * _shallow_tree(np.bincount(fine[f], g, size), np.bincount(fine[f], h, size), leaves)
            model.tables[f] += tree
            logit += tree[fine[f]]

    def squares(f: int, k: int, g: np.ndarray, h: np.ndarray):
        n, m = coarse[f][-1] + 1, coarse[k][-1] + 1
        cell = coarse[f][fine[f]] * m + coarse[k][fine[k]]
        return cell, [np.bincount(cell, v, n * m).reshape(n, m) for v in (g, h)]

    g, h = gradients()
    gains = [
        (_best_quadrants(*squares(f, k, g, h)[1])[0], f, k) for f in range(features) for k in range(f + 1, features)
    ]
    for _, f, k in sorted(gains, key=lambda t: (-t[0], t[1:]))[:pairs]:
        model.pairs.append((f, k))
        model.pair_tables.append(np.zeros((coarse[f][-1] + 1, coarse[k][-1] + 1)))
    for _ in range(pair_rounds):
        for at, (f, k) in enumerate(model.pairs):
            cell, sums = squares(f, k, *gradients())
            values = rate * _best_quadrants(*sums)[1]
            model.pair_tables[at] += values
            logit += values.ravel()[cell]
    return model


def measured(docs: DataFrame) -> DataFrame:
    """`doc_id, mark, measures` per row of `docs(doc_id, text, ...)`; `mark` is that of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            rows = measure(texts)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [texts.rows.column("doc_id"), texts.rows.column("mark"), pa.ListArray.from_arrays(offsets, rows.ravel())],
                names=["doc_id", "mark", "measures"],
            )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    marked = docs.select(ids, text_mark(docs["text"]).alias("mark"), "text")
    return marked.mapInArrow(run, "doc_id long, mark long, measures array<double>")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a row without id counts as 1, so nothing is learnt from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(1))


def train(rows: DataFrame, labels: DataFrame, train_rows: int = 40_000) -> AdditiveModel:
    """A model of `labels(doc_id, quality)` on `rows(doc_id, measures)`.

    Learns from ids whose remainder is not 1, and of these from the `train_rows` with the smallest
    hashes; this bound is what reaches the driver. Several labels of an id are averaged, of several
    texts that of the smallest mark is taken; null labels are left out.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .where(remainder(F.col("doc_id")) != 1)
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("y"))
    )
    known = materialize(known, "quality-labels")
    # the smallest hashes by a bound on them, so that about `train_rows` rows reach the driver
    share = min(1.0, 1.05 * train_rows / max(known.count(), 1))
    draw = F.xxhash64("doc_id")
    known = known.where(draw <= min(int(-(2.0**63) + share * 2.0**64), 2**63 - 1))
    first = rows.join(known, "doc_id").groupBy("doc_id").agg(F.min_by("measures", "mark").alias("measures"), F.first("y").alias("y"))
    sample = (
        first.orderBy(draw, "doc_id")
        .limit(train_rows)
        .select("measures", (F.col("y") >= 0.5).cast("double").alias("y"))
        .toPandas()
    )
    x = np.array(sample["measures"].tolist(), np.float64).reshape(-1, len(MEASURES))
    return fit_additive(x, sample["y"].to_numpy(np.float64))


def _scored(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """`doc_id, mark, score, predicted` per row."""
    rows = materialize(measured(docs), "measures")
    model = train(rows, labels, train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("measures").flatten().to_numpy(zero_copy_only=False)
            score = model.score(flat.reshape(-1, len(MEASURES)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "mark", "score", "predicted"],
            )

    return rows.mapInArrow(run, "doc_id long, mark long, score double, predicted int")


def score_quality(docs: DataFrame, labels: DataFrame, train_rows: int = 40_000) -> DataFrame:
    """`doc_id, held_out, score, predicted` for every row of `docs(doc_id, text, ...)`.

    The score is the probability of quality 1 from the text alone; rows without text are scored as
    empty ones. Repeated rows are scored each. Without usable labels all rows get one score.
    """
    held_out = (remainder(F.col("doc_id")) == 1).alias("held_out")
    return _scored(docs, labels, train_rows).select("doc_id", held_out, "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, train_rows: int = 40_000) -> DataFrame:
    """Rows of `docs` whose predicted quality is 1; rows without id stay, as they cannot be told.

    A row goes by its id and text: of an id with several texts the good ones stay. Repeated rows
    share one decision, null text counts as empty, an empty table stays empty, all columns are kept.
    """
    bad = _scored(docs, labels, train_rows).where("predicted = 0 and doc_id is not null")
    return without(docs, materialize(bad.select("doc_id", "mark").distinct(), "rejected"))
