"""Arrow batches of texts as arrays of bytes and words, for operators that run inside tasks.

Nothing here holds more than one slice of a batch, so memory is bounded by `SLICE_BYTES` and the
longest text.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_BYTES = 2 << 20
_HASH_BYTES = 1 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_RANDOM = np.random.default_rng(20_240_607)
_BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


class Texts(NamedTuple):
    """Some rows: their UTF-8 bytes end to end, and where each text begins (one more entry at the end)."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Words of some texts in order: first byte, end, and how many words precede each text."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[Texts]:
    """Consecutive rows of at most `most` bytes of text, or a single longer one. Null counts as empty."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        text = batch.column(at)
        if text.null_count:
            text = text.fill_null("")
        offsets = np.frombuffer(
            text.buffers()[1], dtype=np.int64 if pa.types.is_large_string(text.type) else np.int32
        )[text.offset : text.offset + len(text) + 1].astype(np.int64)
        body = text.buffers()[2]
        data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
        begin = 0
        while begin < len(text):
            end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
            end = min(max(end, begin + 1), len(text))
            yield Texts(
                batch.slice(begin, end - begin),
                data[offsets[begin] : offsets[end]],
                offsets[begin : end + 1] - offsets[begin],
            )
            begin = end
    release()


def release() -> None:
    """Gives freed memory back to the system: Python workers outlive their task and stand by while
    other stages run."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Let Arrow batches of this session hold fewer rows than by default, as texts are long rows.

    The setting stays, as tables read lazily are batched when their result is asked for."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def find_words(data: np.ndarray, offsets: np.ndarray, white: np.ndarray = _WHITE) -> Words:
    """Words `[^\\x20\\x09-\\x0D]+` of each text, or runs of other bytes than `white` ones."""
    inside = ~white[data]
    if not len(inside):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]  # a word never goes on in the next text
    left = edges[(edges < len(data)) & (edges > 0)]
    first[left] = inside[left]
    last[left - 1] = inside[left - 1]
    starts = np.flatnonzero(first)
    return Words(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def line_spans(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Lines of each text, cut at `\\n`; a text of `k` breaks has `k + 1`."""
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    ends = np.sort(np.concatenate((offsets[1:], breaks)), kind="stable")
    return Words(starts, ends, np.arange(len(offsets)) + np.searchsorted(breaks, offsets))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of each word: differences of a running polynomial, in pieces of `_HASH_BYTES`."""
    hashes = np.empty(len(words.starts), np.uint64)
    at = 0
    while at < len(hashes):
        begin = int(words.starts[at])
        stop = int(np.searchsorted(words.ends, begin + _HASH_BYTES, side="right"))
        stop = max(stop, at + 1)
        piece = data[begin : words.ends[stop - 1]]
        up, down = _power_tables(max(len(piece) + 1, _HASH_BYTES + 1))
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[piece] * up[: len(piece)], out=total[1:])
        s, e = words.starts[at:stop] - begin, words.ends[at:stop] - begin
        hashes[at:stop] = (total[e] - total[s]) * down[s]
        at = stop
    return mix(hashes)


def window_hashes(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words inside a text, and where each text's runs begin.

    A text of fewer words has its whole sequence as one run, an empty one has none.
    """
    counts = np.diff(offsets)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(runs)))
    first = np.repeat(offsets[:-1] - bounds[:-1], runs) + np.arange(bounds[-1])
    length = np.repeat(np.minimum(counts, width), runs)
    total = np.zeros(len(first), np.uint64)
    for i in range(width):
        here = length > i
        if here.all():
            total = total * np.uint64(_BASE) + hashes[first + i]
        else:
            total[here] = total[here] * np.uint64(_BASE) + hashes[first[here] + i]
    return mix(total + length.astype(np.uint64)), bounds


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the flags of each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def ranked(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For hashes in order, each of one owner: which are not the first of their kind there, and which
    are there twice or more."""
    key = mix(hashes + (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))
    by = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[1:] = key[by[1:]] == key[by[:-1]]
    twice = again.copy()
    twice[:-1] |= again[1:]
    later, repeated = np.empty(len(key), bool), np.empty(len(key), bool)
    later[by], repeated[by] = again, twice
    return later, repeated
