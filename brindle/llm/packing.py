"""Packing of token sequences: first fit decreasing in randomised groups of documents."""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from brindle.llm.texts import Texts, Words, find_words, lower_ascii, slices, word_hashes
from brindle.session import materialize

_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECES = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


_SLICE_BYTES = 6 << 20
_TRAILING = np.zeros(256, dtype=bool)
_TRAILING[list(b".,!?;:$%&*#|")] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def parts_of_words(data: np.ndarray, words: Words) -> Words:
    """Words with the marks behind a letter cut off as a part of their own.

    The vocabulary cuts there too, so the ids of a word are those of its parts, and "the," does not
    have to be encoded besides "the".
    """
    starts, ends = words.starts, words.ends.copy()
    at = np.flatnonzero(_TRAILING[data[ends - 1]]) if len(ends) else np.zeros(0, np.int64)
    while len(at):
        ends[at] -= 1
        at = at[(ends[at] > starts[at]) & _TRAILING[data[np.maximum(ends[at] - 1, 0)]]]
    cut = (ends < words.ends) & (ends > starts)
    cut[cut] = _LETTER[data[ends[cut] - 1]]
    extra = np.concatenate(([0], np.cumsum(cut)))
    place = np.arange(len(starts)) + extra[:-1]
    new_starts, new_ends = (np.empty(len(starts) + extra[-1], np.int64) for _ in range(2))
    new_starts[place], new_ends[place] = starts, np.where(cut, ends, words.ends)
    new_starts[place[cut] + 1], new_ends[place[cut] + 1] = ends[cut], words.ends[cut]
    return Words(new_starts, new_ends, words.offsets + extra[words.offsets])


class WordTokens:
    """Token ids of texts by those of their distinct words.

    White space separates words in this vocabulary and letters lose their case, so the ids of a text
    are those of its words in lower case (words with `<` keep theirs, as they may name a special
    token). The first `most` distinct words are kept for the process, others encoded per slice.
    """

    def __init__(self, path: str, most: int = 150_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.index: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.offsets = np.zeros(1, np.int64)

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [
            e.ids
            for e in self.tokenizer.encode_batch_fast(
                [w.decode("utf-8", "replace") for w in words], add_special_tokens=False
            )
        ]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum()))
        return flat, lengths

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and where each text begins."""
        words = find_words(texts.data, texts.offsets)
        data = lower_ascii(texts.data)
        special = np.flatnonzero(texts.data == 0x3C)
        for at in np.unique(np.searchsorted(words.starts, special, side="right") - 1).tolist():
            own = slice(words.starts[at], words.ends[at])
            data[own] = texts.data[own]
        words = parts_of_words(data, words)
        _, first, kind = np.unique(word_hashes(data, words), return_index=True, return_inverse=True)
        raw = data.tobytes()
        known = len(self.offsets) - 1
        rows, fresh = np.empty(len(first), np.int64), []
        for i, (a, b) in enumerate(zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)):
            at = self.index.get(raw[a:b])
            if at is None:
                at = known + len(fresh)
                fresh.append(raw[a:b])
            rows[i] = at
        more, lengths = self._encode(fresh)
        ids = np.concatenate((self.ids, more))
        offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(lengths)))
        room = min(self.most - known, len(fresh))
        if room > 0:
            self.index.update(zip(fresh[:room], range(known, known + room), strict=True))
            self.offsets = offsets[: known + room + 1].copy()
            self.ids = ids[: self.offsets[-1]].copy()
        row = rows[kind]
        lengths = offsets[row + 1] - offsets[row]
        ends = np.cumsum(lengths)
        flat = np.repeat(offsets[row] - ends + lengths, lengths)
        flat += np.arange(len(flat))
        return ids[flat], np.concatenate(([0], ends))[words.offsets]


@functools.lru_cache(maxsize=2)
def load_words(path: str) -> WordTokens:
    return WordTokens(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 4096) -> DataFrame:
    """`row, doc_id, start, length, ids_crc32, doc_tokens` per piece of `docs(doc_id, text, ...)`.

    A document's ids end with `end_id`; it is cut into pieces of `capacity` ids and the rest. `row`
    is a number of its own for every row, also for rows that repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_words(tokenizer_path)
        tail = np.array([end_id], np.uint32)
        row = TaskContext.get().partitionId() << 33
        for texts in slices(batches, most=_SLICE_BYTES):
            ids, bounds = vocabulary.encode(texts)
            rows = []
            for i, doc in enumerate(texts.rows.column("doc_id").to_pylist()):
                own = np.concatenate((ids[bounds[i] : bounds[i + 1]], tail)).astype("<u4")
                for start in range(0, len(own), capacity):
                    piece = own[start : start + capacity]
                    rows.append((row + i, doc, start, len(piece), zlib.crc32(piece.tobytes()), len(own)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                names=["row", "doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )
            row += len(texts.rows)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item, taken from the longest on, each into the first bin it fits.

    A tournament tree over the room left in the bins finds that bin in logarithmic time: every node
    holds the most room below it, so the walk goes left whenever the left half has enough.
    """
    n = len(lengths)
    size = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * size)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        node = 1
        while node < size:
            node *= 2
            if room[node] < need:
                node += 1
        bins[item], offsets[item] = node - size, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 4096, group_pieces: int = 8192) -> DataFrame:
    """Adds `sequence_id, offset` to `pieces(row, doc_id, start, length, ...)`, each at most `capacity` long.

    Documents are dealt at random into groups of about `group_pieces` pieces, by a hash of the row
    number, so that repeated rows are dealt too; each group is packed on its own. Pieces of the whole
    `capacity` fill a sequence wherever they are and are dealt one by one, so a document of very many
    ids makes no large group.
    """
    pieces = materialize(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = first_fit_decreasing(part["length"].to_numpy(), capacity)
        part["sequence_id"] = (int(key[0]) << 32) + bins
        part["offset"] = offsets
        return part[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    alone = F.when(F.col("length") == capacity, F.col("start")).otherwise(F.lit(-1))
    group = F.pmod(F.xxhash64("row", alone), F.lit(groups))
    return pieces.withColumn("_group", group).groupBy("_group").applyInPandas(run, _PACKED)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 4096, group_pieces: int = 8192
) -> DataFrame:
    """Packed pieces of all rows of `docs(doc_id, text, ...)`, see `token_pieces` and `pack`.

    A null or empty text is the one id `end_id`. Repeated rows are packed each; rows without id
    too. An empty table gives no sequences.
    """
    return pack(token_pieces(docs, tokenizer_path, end_id, capacity), capacity, group_pieces)
