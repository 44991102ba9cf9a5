"""Sampled segmentations of texts into vocabulary pieces, and their lossless decoding."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from brindle.llm.texts import Texts, Words, mix, slices, word_hashes

_SPACE, _BREAK = 0x20, 0x0A
_SLICE_BYTES = 1 << 20
_DECODED_PIECES = 1 << 18


def extended(hashes: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Hashes of byte strings that are one byte longer."""
    return mix(hashes * np.uint64(0x9E3779B97F4A7C15) + byte + np.uint64(1))


class PieceTable:
    """Pieces of a vocabulary as bytes, their log-weights, and which byte strings begin a piece."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        if size > 1 << 16:
            raise ValueError(f"a vocabulary of {size} pieces: the lattices number them in 16 bits")
        raw, self.byte_ids = {}, np.zeros(256, np.int64)
        for i in range(size):
            if model.is_byte(i):
                self.byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                raw[i] = model.id_to_piece(i).replace("▁", " ").encode()
        # merge ranks stand in for frequencies: the piece of rank r weighs like 1 / (r + 2)
        ranks = np.array([max(0.0, -model.get_score(i)) if i in raw else size for i in range(size)])
        self.weights = -alpha * np.log(np.minimum(ranks, size) + 2.0)
        by_byte = {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
        self.bytes_of = [raw.get(i, by_byte.get(i, b"")) for i in range(size)]
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.lengths)))
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.separable = all(b"\n" not in b and b" " not in b.lstrip(b" ") for b in raw.values())
        prefixes: dict[bytes, int] = {}
        for i, b in raw.items():
            for end in range(1, len(b)):
                prefixes.setdefault(b[:end], -1)
            prefixes[b] = i
        self.longest = max(map(len, raw.values()), default=0)
        # one table per length: ascending hashes and the piece they are, or -1
        self.tables = {}
        for length in range(1, self.longest + 1):
            keys = [p for p in prefixes if len(p) == length]
            data = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, length)
            hashes = np.zeros(len(keys), np.uint64)
            for column in data.T:
                hashes = extended(hashes, column)
            by = np.argsort(hashes)
            self.tables[length] = (hashes[by], np.array([prefixes[k] for k in keys], np.int64)[by])


@functools.lru_cache(maxsize=2)
def load_pieces(path: str, alpha: float) -> PieceTable:
    return PieceTable(path, alpha)


def spaced(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, each that is not empty behind a space as the library puts it."""
    size = np.diff(texts.offsets)
    ahead = (size > 0).astype(np.int64)
    begins = np.concatenate(([0], np.cumsum(size + ahead)))
    data = np.full(begins[-1], _SPACE, np.uint8)
    at = np.arange(len(texts.data)) + np.repeat(np.cumsum(ahead), size)
    data[at] = texts.data
    return data, begins


def units(data: np.ndarray, begins: np.ndarray, separable: bool) -> Words:
    """Spans that no piece crosses: a run of spaces with what follows, and single line breaks."""
    first = np.zeros(len(data), bool)
    first[begins[:-1][begins[:-1] < begins[1:]]] = True
    if separable:
        space, new_line = data == _SPACE, data == _BREAK
        first[1:] |= (space[1:] & ~space[:-1]) | new_line[:-1]
        first |= new_line
    starts = np.flatnonzero(first)
    return Words(starts, np.append(starts[1:], len(data))[: len(starts)], np.searchsorted(starts, begins))


class Lattices:
    """Lattices of several spans, filtered forward: the pieces that end at each node, and with what
    chance a segmentation up to there ends so.

    Spans are numbered from the longest on; node `d` of span `u` is `base[d] + u`, so all spans step
    through a depth together.
    """

    def __init__(self, table: PieceTable, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.order = np.argsort(starts - ends, kind="stable")
        starts, lengths = starts[self.order], (ends - starts)[self.order]
        deepest = int(lengths[0]) if len(lengths) else 0
        spans_at = len(lengths) - np.searchsorted(lengths[::-1], np.arange(deepest + 1))
        base = np.concatenate(([0], np.cumsum(spans_at)))
        self.spans, self.last = len(lengths), base[lengths] + np.arange(len(lengths))

        owner = np.repeat(np.arange(len(lengths)), lengths)
        depth = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        source, room = starts[owner] + depth, lengths[owner] - depth
        char = data[source]
        width = np.select([char < 0x80, char < 0xC0, char < 0xE0, char < 0xF0], [1, 0, 2, 3], 4)
        alone = np.zeros(len(owner), bool)
        alive, hashes, arcs = np.arange(len(owner)), np.zeros(len(owner), np.uint64), []
        for length in range(1, table.longest + 1):
            fits = room[alive] >= length
            alive = alive[fits]
            if not len(alive):
                break
            hashes = extended(hashes[fits], data[source[alive] + length - 1])
            keys, pieces = table.tables[length]
            found = np.searchsorted(keys, hashes)
            found[found == len(keys)] = 0
            hit = keys[found] == hashes
            alive, hashes, found = alive[hit], hashes[hit], pieces[found[hit]]
            here, piece = alive[found >= 0], found[found >= 0]
            arcs.append((base[depth[here] + length] + owner[here]) << 16 | piece)
            alone[here[width[here] == length]] = True
        # bytes of characters that are no piece
        begins = np.maximum.accumulate(np.where(width > 0, np.arange(len(owner)), 0))
        loose = np.flatnonzero(~alone[begins])
        arcs.append((base[depth[loose] + 1] + owner[loose]) << 16 | table.byte_ids[data[source[loose]]])

        arc = np.sort(np.concatenate(arcs))  # by node, then piece
        end, self.piece = arc >> 16, (arc & 0xFFFF).astype(np.int32)
        at = np.repeat(np.arange(deepest + 1), np.diff(np.searchsorted(end, base)))
        length = table.lengths[self.piece]
        self.begin = base[at - length] + end - base[at]
        weight = table.weights[self.piece]
        alpha = np.full(base[-1], -np.inf)
        alpha[: self.spans] = 0.0
        cut = np.flatnonzero(np.r_[True, end[1:] != end[:-1]]) if len(end) else end
        size = np.diff(np.r_[cut, len(end)])
        chance = np.zeros(len(end))
        steps = np.searchsorted(end, base[1:])
        groups = np.searchsorted(cut, steps)
        for a, b, g, h in zip(steps[:-1].tolist(), steps[1:].tolist(), groups[:-1].tolist(), groups[1:].tolist(), strict=True):
            if a == b:
                continue
            reach = alpha[self.begin[a:b]] + weight[a:b]
            local = cut[g:h] - a
            top = np.maximum.reduceat(reach, local)
            top[~np.isfinite(top)] = 0.0
            mass = np.exp(reach - np.repeat(top, size[g:h]))
            total = np.add.reduceat(mass, local)
            with np.errstate(divide="ignore"):
                alpha[end[cut[g:h]]] = top + np.log(total)
            chance[a:b] = mass / np.repeat(np.where(total > 0, total, 1.0), size[g:h])
        running = np.cumsum(chance)
        before = np.repeat(running[cut] - chance[cut], size) if len(cut) else running
        self.key = end + np.clip(running - before, 0.0, 1.0)
        if len(cut):
            self.key[cut + size - 1] = end[cut] + 1.0  # the last arc of a node takes what rounding left

    def sample(self, which: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of one segmentation per entry of `which`, and how many each has.

        Walks back from the end of every span, all spans together; each step draws the last piece.
        Equal spans walk side by side, so the walk goes through memory in order.
        """
        number = np.empty(self.spans, np.int64)
        number[self.order] = np.arange(self.spans)
        which = number[which]
        active = np.argsort(which, kind="stable")
        state = self.last[which[active]]
        counts = np.zeros(len(which), np.int64)
        taken = []
        while len(active):
            step = np.uint64((len(taken) + 1) * 0xA0761D6478BD642F & (2**64 - 1))
            draw = mix(seeds[active] + step)
            chance = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
            arc = np.searchsorted(self.key, state + chance, side="right")
            taken.append((active, self.piece[arc]))
            counts[active] += 1
            state = self.begin[arc]
            further = state >= self.spans
            active, state = active[further], state[further]
        ends = np.cumsum(counts)
        pieces = np.empty(ends[-1] if len(ends) else 0, np.int32)
        for back, (at, piece) in enumerate(taken):
            pieces[ends[at] - 1 - back] = piece
        return pieces, counts


def encode_sampled(docs: DataFrame, model_path: str, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """Adds `pieces`, a sampled segmentation, to the rows `doc_id, text` of `docs`.

    A segmentation of a text has the product of its pieces' weights as weight and is drawn with its
    share of the sum over all segmentations: sums are filtered forward over the lattice of pieces,
    then pieces are drawn backward. A piece of merge rank r weighs `(r + 2) ** -alpha`; characters
    that are no piece are spelt by bytes. Draws depend on seed, id and place only, so a repeated
    job gives the same pieces and repeated rows get the same ones; rows without id share one key.
    A null text stays null with null pieces, an empty one has none. A text falls into spans that no
    piece crosses; equal spans of a slice share one lattice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load_pieces(model_path, alpha)
        for texts in slices(batches, most=_SLICE_BYTES):
            data, begins = spaced(texts)
            spans = units(data, begins, table.separable)
            hashes = word_hashes(data, spans)
            _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
            lattices = Lattices(table, data, spans.starts[first], spans.ends[first])
            ids = texts.rows.column("doc_id").fill_null(0).to_numpy().astype(np.int64).view(np.uint64)
            keys = mix(ids ^ np.uint64(seed & (2**64 - 1)) * np.uint64(0x9E3779B97F4A7C15))
            counts = np.diff(spans.offsets)
            place = np.arange(len(hashes)) - np.repeat(spans.offsets[:-1], counts)
            seeds = mix(np.repeat(keys, counts) + place.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
            pieces, lengths = lattices.sample(kind, seeds)
            ends = np.concatenate(([0], np.cumsum(lengths)))[spans.offsets]
            lists = pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.array(pieces.astype(np.int32)), mask=texts.rows.column("text").is_null()
            )
            yield pa.RecordBatch.from_arrays(
                [texts.rows.column("doc_id"), texts.rows.column("text"), lists], names=["doc_id", "text", "pieces"]
            )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(run, "doc_id long, text string, pieces array<int>")


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """Adds `decoded`, the text of `pieces`, to `rows(pieces, ...)`; null for null pieces."""

    def texts_of(table: PieceTable, pieces: pa.ListArray) -> pa.Array:
        lengths = pieces.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        flat = pieces.flatten().to_numpy()
        size = table.lengths[flat]
        ends = np.cumsum(size)
        source = np.repeat(table.begins[flat] - ends + size, size)
        source += np.arange(len(source))
        data = table.flat[source]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(lengths)))]
        # the space that the library puts first is dropped
        keep = np.ones(len(data), bool)
        keep[bounds[:-1][bounds[:-1] < bounds[1:]]] = False
        offsets = bounds - np.concatenate(([0], np.cumsum(bounds[:-1] < bounds[1:])))
        text = pa.LargeStringArray.from_buffers(
            len(pieces), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[keep].tobytes())
        )
        return pc.if_else(pieces.is_null(), pa.scalar(None, pa.string()), text.cast(pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load_pieces(model_path, 1.0)
        for batch in batches:
            total = np.cumsum(batch.column("pieces").value_lengths().fill_null(0).to_numpy())
            begin = 0
            while begin < len(batch):
                done = total[begin - 1] if begin else 0
                end = max(int(np.searchsorted(total, done + _DECODED_PIECES, side="right")), begin + 1)
                part = batch.slice(begin, end - begin)
                begin = end
                text = texts_of(table, part.column("pieces"))
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, "decoded"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("decoded", StringType())]))
