"""Quality rules and line labels: a linear-chain conditional random field tells content from
boilerplate, and the share of content decides which documents stay."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

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

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!?")] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?:;")] = True

# Bounds of the buckets that each measure of a line falls into.
FEATURES = {
    "words": (2, 4, 8, 16),
    "word_bytes": (3.5, 5, 7, 9),
    "symbols": (1e-9, 0.02, 0.05, 0.1),
    "uppers": (0.1, 0.3, 0.6),
    "digits": (1e-9, 0.05, 0.2),
    "marks": (1e-9, 0.05, 0.1),
    "next_equal": (1e-9, 0.1, 0.3),
    "repeats": (0.5,),
    "ends_sentence": (0.5,),
}
_WIDTHS = [len(bounds) + 1 for bounds in FEATURES.values()]
_BASES = np.concatenate(([0], np.cumsum(_WIDTHS)[:-1]))
_TOTAL = sum(_WIDTHS)


def line_features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of each line that has a word, its words, and where each text's lines begin."""
    data, n = texts.data, len(texts.offsets) - 1
    lines, words = line_spans(data, texts.offsets), find_words(data, texts.offsets)
    first = np.searchsorted(words.starts, lines.starts)
    count = np.searchsorted(words.starts, lines.ends) - first
    filled = count > 0
    owner = np.repeat(np.arange(n), np.diff(lines.offsets))[filled]
    later, _ = ranked(word_hashes(data, lines)[filled], owner)
    starts, ends, first, count = lines.starts[filled], lines.ends[filled], first[filled], count[filled]
    if not len(starts):
        return np.zeros((0, len(FEATURES)), np.int64), count, np.zeros(n + 1, np.int64)
    hashes = word_hashes(lower_ascii(data), words)
    same = np.zeros(len(hashes) + 1, np.int64)
    same[2:] = np.cumsum(hashes[1:] == hashes[:-1])
    size = np.maximum(ends - starts, 1)
    word_bytes = np.concatenate(([0], np.cumsum(words.ends - words.starts)))

    def share(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags[data])))
        return (total[ends] - total[starts]) / size

    columns = {
        "words": count,
        "word_bytes": (word_bytes[first + count] - word_bytes[first]) / count,
        "symbols": share(_SYMBOL),
        "uppers": share(_UPPER),
        "digits": share(_DIGIT),
        "marks": share(_MARK),
        "next_equal": (same[first + count] - same[first + 1]) / count,
        "repeats": later,
        "ends_sentence": _STOP[data[words.ends[first + count - 1] - 1]],
    }
    codes = [
        np.searchsorted(bounds, np.asarray(columns[name], float), side="right") + base
        for (name, bounds), base in zip(FEATURES.items(), _BASES, strict=True)
    ]
    return np.stack(codes, 1), count, np.searchsorted(owner, np.arange(n + 1))


class LineField:
    """A linear-chain conditional random field over two labels, 0 boilerplate and 1 content."""

    def __init__(self):
        self.weights = np.zeros((_TOTAL, 2))
        self.moves = np.zeros((2, 2))
        self.start = np.zeros(2)

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        return self.weights[codes].sum(axis=1)

    def fit(
        self,
        sequences: list[np.ndarray],
        truths: list[np.ndarray],
        weights: list[float],
        chained: bool = True,
        steps: int = 120,
        rate: float = 0.1,
        penalty: float = 1.0,
    ) -> LineField:
        """Weighted maximum likelihood of the lines' labels by gradient steps with momentum.

        Forward and backward sums run over all sequences at once, one line further at a time. Without
        `chained`, moves between labels stay even, so lines are told apart by their features alone.
        """
        order = sorted((i for i, s in enumerate(sequences) if len(s)), key=lambda i: -len(sequences[i]))
        if not order:
            return self
        lengths = np.array([len(sequences[i]) for i in order])
        total = lengths.sum()
        codes = np.concatenate([sequences[i] for i in order])
        truth = np.concatenate([truths[i] for i in order]).astype(np.int64)
        weight = np.array([weights[i] for i in order], np.float64)
        begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        alive = [int((lengths > t).sum()) for t in range(lengths[0])]
        line_weight = np.repeat(weight, lengths)
        inner = np.ones(total, bool)
        inner[begins] = False
        seen = np.zeros((2, 2))
        at = np.flatnonzero(inner)
        np.add.at(seen, (truth[at - 1], truth[at]), line_weight[at])
        state = [np.zeros_like(p) for p in (self.weights, self.moves, self.start)]
        square = [np.zeros_like(p) for p in (self.weights, self.moves, self.start)]
        for step in range(1, steps + 1):
            emit = self.emissions(codes)
            forward = np.zeros((total, 2))
            forward[begins] = self.start + emit[begins]
            for t in range(1, lengths[0]):
                at = begins[: alive[t]] + t
                forward[at] = np.logaddexp.reduce(forward[at - 1][:, :, None] + self.moves, axis=1) + emit[at]
            norm = np.logaddexp.reduce(forward[begins + lengths - 1], axis=1)
            backward = np.zeros((total, 2))
            pair_sum = np.zeros((2, 2))
            for t in range(lengths[0] - 1, 0, -1):
                at = begins[: alive[t]] + t
                ahead = self.moves + (emit[at] + backward[at])[:, None, :]
                pair = np.exp(forward[at - 1][:, :, None] + ahead - norm[: alive[t], None, None])
                pair_sum += (pair * weight[: alive[t], None, None]).sum(axis=0)
                backward[at - 1] = np.logaddexp.reduce(ahead, axis=2)
            chance = np.exp(forward + backward - np.repeat(norm, lengths)[:, None])
            gap = (np.eye(2)[truth] - chance) * line_weight[:, None]
            change = np.zeros_like(self.weights)
            for column in codes.T:
                for label in (0, 1):
                    change[:, label] += np.bincount(column, gap[:, label], _TOTAL)
            first = gap[begins].sum(axis=0) * chained
            moves = (seen - pair_sum - penalty * self.moves) * chained
            for i, (p, g) in enumerate(
                ((self.weights, change - penalty * self.weights), (self.moves, moves), (self.start, first))
            ):
                g = g / weight.sum()
                state[i] = 0.9 * state[i] + 0.1 * g
                square[i] = 0.99 * square[i] + 0.01 * g * g
                p += rate * (state[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-8)
        return self

    def viterbi(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The likeliest labels of all lines; sequence `i` is `codes[begins[i]:begins[i + 1]]`.

        All sequences advance together, the longest first, so those that end drop off the tail.
        """
        lengths = np.diff(begins)
        by = np.argsort(-lengths, kind="stable")
        by = by[lengths[by] > 0]
        labels = np.zeros(len(codes), np.int8)
        if not len(by):
            return labels
        starts, lengths = begins[by], lengths[by]
        alive = len(by) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
        emit = self.emissions(codes)
        best = self.start + emit[starts]
        came = np.zeros((len(codes), 2), np.int8)
        final = np.zeros((len(by), 2))
        for t in range(lengths[0]):
            k = int(alive[t])
            if t:
                ended = int(alive[t - 1])
                final[k:ended] = best[k:ended]
                options = best[:k, :, None] + self.moves
                came[starts[:k] + t] = options.argmax(axis=1)
                best = options.max(axis=1) + emit[starts[:k] + t]
        final[: len(best)] = best
        now = final.argmax(axis=1).astype(np.int8)
        for t in range(lengths[0] - 1, -1, -1):
            k = int(alive[t])
            at = starts[:k] + t
            labels[at] = now[:k]
            now[:k] = came[at, now[:k]]
        return labels


def fit_lines(docs: DataFrame, labels: DataFrame, train_rows: int = 3000, train_bytes: int = 20_000) -> LineField:
    """A field learnt from `labels(doc_id, quality)`.

    Lines of documents of quality 1 count as content. Documents of quality 0 hold content too: a
    first fit without moves takes all their lines for boilerplate, and those that it still calls
    content count as content in the second one. Uses the `train_rows` labelled documents of smallest hash whose text has at most `train_bytes`;
    these bounds are what reaches the driver. Without both labels it calls every line content.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
        .withColumnRenamed("doc_id", "_id")
    )
    sizes = docs.where(F.octet_length("text").between(1, train_bytes)).select("doc_id").distinct()
    known = materialize(known, "line-labels")
    draw = F.xxhash64("_id")
    share = 4 * train_rows / max(known.count(), 1)
    while True:  # small hashes only, so that a task sorts few ids; more of them where many texts are too long
        below = known.where(draw <= min(int(-(2.0**63) + share * 2.0**64), 2**63 - 1))
        chosen = sizes.join(below, sizes["doc_id"] == below["_id"]).orderBy(draw, "_id").limit(train_rows)
        chosen = materialize(chosen.select("_id", "y"), "chosen")
        if share >= 1 or chosen.count() == train_rows:
            break
        share *= 8
    rows = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_id"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            codes, _, begins = line_features(texts)
            flat = pa.array(codes.astype(np.int16).ravel())
            lists = pa.ListArray.from_arrays(pa.array((begins * len(FEATURES)).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays(
                [texts.rows.column("doc_id"), lists, texts.rows.column("y")], names=["doc_id", "codes", "y"]
            )

    found = rows.mapInArrow(run, "doc_id long, codes array<short>, y int").toPandas().sort_values("doc_id", kind="stable")
    sequences = [np.asarray(c, np.int64).reshape(-1, len(FEATURES)) for c in found["codes"]]
    y = found["y"].to_numpy(np.int64)
    if len(set(y[[len(s) > 0 for s in sequences]].tolist())) < 2:
        return LineField()
    lines = np.array([len(s) for s in sequences])
    weights = np.where(y == 1, 0.5 / lines[y == 1].sum(), 0.5 / lines[y == 0].sum()) * lines.sum()
    truths = [np.full(len(s), label) for s, label in zip(sequences, y, strict=True)]
    first = LineField().fit(sequences, truths, weights, chained=False)
    truths = [
        truth if label else first.emissions(s).argmax(axis=1) for s, truth, label in zip(sequences, truths, y, strict=True)
    ]
    return LineField().fit(sequences, truths, weights)


def label_lines(docs: DataFrame, field: LineField) -> DataFrame:
    """`doc_id, labels` per row of `docs(doc_id, text, ...)`: 1 for each line of content, 0 for
    boilerplate; lines without a word are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            codes, _, begins = line_features(texts)
            lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(field.viterbi(codes, begins)))
            yield pa.RecordBatch.from_arrays([texts.rows.column("doc_id"), lists], names=["doc_id", "labels"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, labels array<tinyint>"
    )


def rate_documents(docs: DataFrame, field: LineField, min_share: float = 0.5) -> DataFrame:
    """`doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_lines, n_content_lines, content_share` for every row of `docs(doc_id, text, ...)`.

    Words are `[^\\x20\\x09-\\x0D]+`. `base_failed`: under 50 words, or more than half of them in
    3-word windows that the text has twice or more. Other documents stay if at least `min_share` of
    their words are in lines that the field labels content. A null, empty or blank text has zeros,
    fails and has no share. Repeated rows and rows without id are rated each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            data, offsets = texts.data, texts.offsets
            n = len(offsets) - 1
            words = find_words(data, offsets)
            count = np.diff(words.offsets)
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            chars = np.concatenate(([0], np.cumsum(points[words.ends] - points[words.starts])))
            runs, bounds = window_hashes(word_hashes(data, words), words.offsets, 3)
            run_owner = np.repeat(np.arange(n), np.diff(bounds))
            _, twice = ranked(runs, run_owner)
            begins = words.offsets[:-1][run_owner[twice]] + np.flatnonzero(twice) - bounds[run_owner[twice]]
            covered = np.zeros(len(words.starts) + 3, bool)
            for i in range(3):
                covered[begins + i] = True
            repeat = per_text(covered, words.offsets)
            lines = line_spans(data, offsets)
            filled = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
            owner = np.repeat(np.arange(n), np.diff(lines.offsets))[filled]
            later, _ = ranked(word_hashes(data, lines)[filled], owner)
            codes, line_words, line_begins = line_features(texts)
            content = field.viterbi(codes, line_begins) == 1
            good = per_text(np.where(content, line_words, 0), line_begins)
            share = good / np.maximum(count, 1)
            failed = (count < 50) | (100 * repeat > 50 * count)
            columns = {
                "doc_id": texts.rows.column("doc_id"),
                "n_words": pa.array(count),
                "word_chars": pa.array(chars[words.offsets[1:]] - chars[words.offsets[:-1]]),
                "n_symbols": pa.array(per_text(_SYMBOL[data], offsets)),
                "n_dup_lines": pa.array(np.bincount(owner[later], minlength=n)),
                "n_repeat_words": pa.array(repeat),
                "base_failed": pa.array(failed),
                "kept": pa.array(~failed & (share >= min_share)),
                "n_lines": pa.array(np.diff(line_begins)),
                "n_content_lines": pa.array(per_text(content, line_begins)),
                "content_share": pa.array(share, mask=count == 0),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        run,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double",
    )
