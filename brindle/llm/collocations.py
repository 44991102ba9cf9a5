"""Phrases whose words belong together, counted without loss in mergeable quotient filters.

Texts become blocks of word numbers. A phrase of a block is its word numbers side by side in a few
bits each; an invertible permutation scatters these keys evenly. The leading bits of a permuted key
(the quotient) are its place in a sorted filter, the others (the remainder) are stored in full, so a
filter gives back every phrase and its exact count. Filters of many blocks are cut by leading
bits and merged in rounds until one task has all counts of a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from brindle.llm.texts import Texts, find_words, lower_ascii, mix, release, slices
from brindle.operators.grouping import global_index
from brindle.session import materialize

BLOCK_BYTES = 16 << 20
# Entries of a part, on average, before equal ones are merged.
PART_ENTRIES = 1 << 21
# A filter is cut into at most 2 to this power parts a round.
ROUND_BITS = 10
# Keys are made so many at a time.
_PIECE = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09]] = True
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_BLOCKS = "block long, words array<struct<lang: string, word: string, n: long>>, tokens binary"
_SEGMENTS = (
    "prefix long, source long, entries long, slot_bits int, marks binary, remainders binary, counts binary, large binary"
)
_SEGMENT_SCHEMA = pa.schema(
    [("prefix", pa.int64()), ("source", pa.int64()), ("entries", pa.int64()), ("slot_bits", pa.int32())]
    + [(c, pa.binary()) for c in ("marks", "remainders", "counts", "large")]
)


# ---- words of blocks


def _block_row(block: int, data: np.ndarray, offsets: np.ndarray, langs: pa.Array) -> pa.RecordBatch:
    """One row: the distinct words with their counts, and all tokens as `word + 1`, 0 where a piece ends."""
    data = lower_ascii(data)
    words = find_words(data, offsets, _SPACE | _BREAK)
    inside = ~(_SPACE | _BREAK)[data]
    ends = np.cumsum(words.ends - words.starts)
    spelt = pa.Array.from_buffers(
        pa.string(),
        len(ends),
        [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(data[inside])],
    ).dictionary_encode()
    lang = langs.dictionary_encode()
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(words.offsets))
    pair = spelt.indices.to_numpy().astype(np.int64) * max(len(lang.dictionary), 1) + lang.indices.to_numpy()[owner]
    codes, distinct = pd.factorize(pair)
    counts = np.bincount(codes, minlength=len(distinct))
    fields = [
        lang.dictionary.take(pa.array(distinct % max(len(lang.dictionary), 1))),
        spelt.dictionary.take(pa.array(distinct // max(len(lang.dictionary), 1))),
        pa.array(counts.astype(np.int64)),
    ]
    broken = np.cumsum(_BREAK[data])[words.starts]  # a break never stands where a word starts
    cut = np.zeros(len(codes), bool)
    cut[1:] = (broken[1:] != broken[:-1]) | (owner[1:] != owner[:-1])
    tokens = np.zeros(len(codes) + int(cut.sum()), np.uint32)
    tokens[np.arange(len(codes)) + np.cumsum(cut)] = codes + 1
    listed = pa.ListArray.from_arrays(
        pa.array([0, len(distinct)], pa.int32()), pa.StructArray.from_arrays(fields, ["lang", "word", "n"])
    )
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), listed, pa.array([tokens.tobytes()], pa.binary())], names=["block", "words", "tokens"]
    )


def _portions(texts: Texts, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """The texts as they are; a single text above `most` bytes is cut where a piece ends."""
    langs = texts.rows.column("lang").fill_null("und")
    if len(texts.offsets) != 2 or len(texts.data) <= most:
        yield texts.data, texts.offsets, langs
        return
    breaks = np.flatnonzero(_BREAK[texts.data]) + 1
    begin = 0
    while begin < len(texts.data):
        at = int(np.searchsorted(breaks, begin + most, side="right"))
        if at and breaks[at - 1] > begin:
            end = int(breaks[at - 1])
        else:
            end = int(breaks[at]) if at < len(breaks) else len(texts.data)
        yield texts.data[begin:end], np.array([0, end - begin]), langs
        begin = end


def split_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows `block, words, tokens` of about `block_bytes` of text each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        size = 0

        def block() -> pa.RecordBatch:
            starts = np.cumsum([0] + [len(d) for d, _, _ in held])
            offsets = [np.zeros(1, np.int64), *(o[1:] + s for (_, o, _), s in zip(held, starts))]
            row = _block_row(
                number, np.concatenate([d for d, _, _ in held]), np.concatenate(offsets), pa.concat_arrays([x for *_, x in held])
            )
            release()
            return row

        for texts in slices(batches, most=block_bytes):
            for part in _portions(texts, block_bytes):
                if held and size + len(part[0]) > block_bytes:
                    yield block()
                    held, size, number = [], 0, number + 1
                held.append((part[0].copy(), part[1], part[2]))
                size += len(part[0])
        if held:
            yield block()

    return docs.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(run, _BLOCKS)


def number_words(words: DataFrame, least: int) -> DataFrame:
    """`lang, word, n, id` of the words found `least` times or more in a language; ids count from 1.

    A phrase is no more frequent than its words, so the others can be in no candidate.
    """
    frequent = words.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return materialize(global_index(frequent, ["lang", "word"], "id").withColumn("id", F.col("id") + 1), "phrase-words")


# ---- keys and filters


class Keys(NamedTuple):
    """Phrases of up to three words of `bits` bits: the first of three words, or 0, and the last two.

    `scatter` permutes the 2 `bits` wide right half by multiplications, shifts and the left half;
    `gather` undoes it.
    """

    bits: int

    @property
    def width(self) -> int:
        return 2 * self.bits

    def _mask(self) -> np.uint64:
        return np.uint64((1 << self.width) - 1)

    def scatter(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        x = right ^ (mix(left + np.uint64(1)) & self._mask())
        for m in _MULTIPLIERS:
            x = (x * np.uint64(m)) & self._mask()
            x = x ^ (x >> np.uint64(self.bits))
        return x

    def gather(self, left: np.ndarray, scattered: np.ndarray) -> np.ndarray:
        x = scattered
        for m in reversed(_MULTIPLIERS):
            x = x ^ (x >> np.uint64(self.bits))
            x = (x * np.uint64(pow(m, -1, 1 << 64))) & self._mask()
        return x ^ (mix(left + np.uint64(1)) & self._mask())


class Filter(NamedTuple):
    """Distinct phrases in the order of their scattered key, each with its count."""

    scattered: np.ndarray
    left: np.ndarray
    counts: np.ndarray


def summed(keys: Keys, scattered: np.ndarray, left: np.ndarray, counts: np.ndarray) -> Filter:
    """The filter of any entries; those that are sorted runs already are merged quickly."""
    if keys.width + keys.bits <= 64:
        shift = np.uint64(keys.bits)
        key = (scattered << shift) | left
        by = np.argsort(key, kind="stable")
        key = key[by]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])
        scattered, left = key[first] >> shift, key[first] & np.uint64((1 << keys.bits) - 1)
    else:
        by = np.lexsort((left, scattered))
        scattered, left = scattered[by], left[by]
        new = np.concatenate(([True], (scattered[1:] != scattered[:-1]) | (left[1:] != left[:-1])))
        first = np.flatnonzero(new[: len(scattered)])
        scattered, left = scattered[first], left[first]
    total = np.add.reduceat(counts[by], first) if len(first) else np.zeros(0, np.int64)
    return Filter(scattered, left, total)


def phrases(keys: Keys, tokens: np.ndarray) -> Filter:
    """All runs of two and three words without a 0 between them."""
    x = tokens.astype(np.uint64)
    two = (x[:-1] > 0) & (x[1:] > 0)
    three = two[:-1] & two[1:]
    low = np.uint64(keys.bits)
    if keys.width + keys.bits > 64:
        pair = (x[:-1] << low) | x[1:]
        left = np.concatenate((np.zeros(int(two.sum()), np.uint64), x[:-2][three]))
        right = np.concatenate((pair[two], pair[1:][three]))
        return summed(keys, keys.scatter(left, right), left, np.ones(len(left), np.int64))
    # each stands once, so sorting in place and the lengths of runs do, with no order or counts beside the keys
    ends = [int(two.sum()), int(two.sum()) + int(three.sum())]
    key = np.empty(ends[-1], np.uint64)
    for start, end, there, words in ((0, ends[0], two, 2), (ends[0], ends[1], three, 3)):
        at = np.flatnonzero(there).astype(np.uint32)
        for a in range(start, end, _PIECE):
            chosen = at[a - start : a - start + min(_PIECE, end - a)]
            left = x[chosen] if words == 3 else np.zeros(len(chosen), np.uint64)
            right = (x[chosen + (words - 2)] << low) | x[chosen + (words - 1)]
            key[a : a + len(chosen)] = (keys.scatter(left, right) << low) | left
    del x, two, three
    key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])
    counts = np.diff(first, append=len(key))
    key = key[first]
    return Filter(key >> low, key & np.uint64((1 << keys.bits) - 1), counts)


def _low(values: np.ndarray, bits: int) -> np.ndarray:
    """The bytes of whole numbers of so many bits, a row each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8]


def _numbers(rows: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view("<u8").ravel().astype(np.uint64)


def _joined(tail: np.ndarray, left: np.ndarray, tail_bits: int, left_bits: int) -> bytes:
    """Remainders: both numbers of an entry, side by side if they fit 64 bits."""
    if tail_bits + left_bits <= 64:
        rows = _low((tail << np.uint64(left_bits)) | left, tail_bits + left_bits)
    else:
        rows = np.hstack((_low(tail, tail_bits), _low(left, left_bits)))
    return np.ascontiguousarray(rows).tobytes()


def _split(data: bytes, count: int, tail_bits: int, left_bits: int) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(data, np.uint8).reshape(count, -1) if count else np.zeros((0, 1), np.uint8)
    if tail_bits + left_bits <= 64:
        both = _numbers(rows)
        return both >> np.uint64(left_bits), both & np.uint64((1 << left_bits) - 1)
    cut = (tail_bits + 7) // 8
    return _numbers(rows[:, :cut]), _numbers(rows[:, cut:])


def packed(keys: Keys, part: Filter, prefix: int, prefix_bits: int) -> list:
    """Fields `entries` to `large` of a segment: entries whose scattered key begins with `prefix`.

    The quotient is one of about as many slots as there are entries. `marks` has a 1 for each entry
    and a 0 behind each slot; remainders follow in order; a count above 254 is in `large`.
    """
    n, rest = len(part.left), keys.width - prefix_bits
    slot_bits = min(rest, max(int(n).bit_length() - 1, 0))
    tail = part.scattered - (np.uint64(prefix) << np.uint64(rest)) if prefix else part.scattered
    slot = tail >> np.uint64(rest - slot_bits)
    marks = np.zeros(n + (1 << slot_bits), np.uint8)
    marks[np.arange(n) + slot.astype(np.int64)] = 1
    remainder = tail & np.uint64((1 << (rest - slot_bits)) - 1)
    return [
        n,
        slot_bits,
        np.packbits(marks).tobytes(),
        _joined(remainder, part.left, rest - slot_bits, keys.bits),
        np.minimum(part.counts, 255).astype(np.uint8).tobytes(),
        part.counts[part.counts >= 255].astype("<i8").tobytes(),
    ]


def unpacked(keys: Keys, row: dict, prefix_bits: int) -> Filter:
    """The filter of a segment."""
    n, slot_bits, rest = row["entries"], row["slot_bits"], keys.width - prefix_bits
    marks = np.unpackbits(np.frombuffer(row["marks"], np.uint8), count=n + (1 << slot_bits))
    slot = (np.flatnonzero(marks) - np.arange(n)).astype(np.uint64)
    remainder, left = _split(row["remainders"], n, rest - slot_bits, keys.bits)
    tail = (slot << np.uint64(rest - slot_bits)) | remainder
    scattered = tail | (np.uint64(row["prefix"]) << np.uint64(rest)) if prefix_bits else tail
    counts = np.frombuffer(row["counts"], np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(row["large"], "<i8")
    return Filter(scattered, left, counts)


def _segments(keys: Keys, whole: Filter, source: int, prefix: int, old_bits: int, new_bits: int) -> pa.RecordBatch:
    """A filter of one prefix cut by `new_bits` leading bits instead of `old_bits`."""
    parts = 1 << (new_bits - old_bits)
    shift = keys.width - new_bits
    begin = prefix << (new_bits - old_bits)
    place = (whole.scattered >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(whole.left), np.int64)
    cuts = np.searchsorted(place, np.arange(begin, begin + parts + 1))
    rows = [
        [begin + k, source, *packed(keys, Filter(*(c[a:b] for c in whole)), begin + k, new_bits)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
        if b > a
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SEGMENT_SCHEMA)], schema=_SEGMENT_SCHEMA
    )


def _merged(keys: Keys, table: pa.Table, prefix_bits: int) -> Filter:
    parts = [unpacked(keys, row, prefix_bits) for row in table.to_pylist()]
    return summed(keys, *(np.concatenate(c) for c in zip(*parts)))


def count_phrases(blocks: DataFrame, vocabulary: DataFrame, least: int, part_entries: int = PART_ENTRIES) -> DataFrame:
    """`x1, x2, x3, f`: phrases of word ids found `least` times or more; `x1` is 0 for two words.

    A block gets the ids of its own words only. Its filter is cut by leading bits; parts of many
    blocks are merged and cut again, at most 2 ** `ROUND_BITS` ways a round, until a part has
    about `part_entries` entries of all blocks. Rows moved are in proportion to the blocks.
    """
    size = blocks.agg(F.sum(F.length("tokens"))).first()[0] or 0
    biggest = vocabulary.agg(F.max("id")).first()[0] or 0
    if biggest >= 1 << 32:
        raise ValueError("more than 2 ** 32 frequent words")
    keys = Keys(max(int(biggest).bit_length(), 1))
    entries = max(size // 2, 1)  # two phrases per token of four bytes at most
    bits = min(max(int(entries // part_entries).bit_length(), 1), keys.width)
    first_bits = min(bits, ROUND_BITS)

    def encode(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        local = right.column("local").to_numpy()
        ids = np.zeros(int(local.max(initial=-1)) + 2, np.uint32)
        ids[local + 1] = right.column("id").to_numpy()
        found = []
        for tokens in left.column("tokens").to_pylist():
            at = np.frombuffer(tokens, np.uint32)
            known = np.zeros(len(at), np.uint32)
            known[at < len(ids)] = ids[at[at < len(ids)]]
            found += [known, np.zeros(1, np.uint32)]
        block = key[0].as_py()
        segments = [_segments(keys, phrases(keys, np.concatenate(found)), block, 0, 0, first_bits)] if found else []
        release()
        return pa.Table.from_batches(segments, _SEGMENT_SCHEMA)

    words = blocks.select(F.col("block").alias("of"), F.posexplode("words").alias("local", "w"))
    words = words.select("of", "local", "w.lang", "w.word")
    ids = words.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).select("of", "local", "id")
    tokens = blocks.select("block", "tokens").groupBy("block")
    segments = tokens.cogroup(ids.groupBy("of")).applyInArrow(encode, _SEGMENTS)
    done = first_bits
    while done < bits:
        segments = _merge_round(keys, segments, done, min(done + ROUND_BITS, bits), entries, part_entries)
        done = min(done + ROUND_BITS, bits)

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        whole = _merged(keys, table, done)
        kept = whole.counts >= least
        left, right = whole.left[kept], keys.gather(whole.left[kept], whole.scattered[kept])
        low = np.uint64((1 << keys.bits) - 1)
        columns = [left, right >> np.uint64(keys.bits), right & low, whole.counts[kept]]
        del whole
        release()
        return pa.table([c.astype(np.int64) for c in columns], names=["x1", "x2", "x3", "f"])

    return segments.groupBy("prefix").applyInArrow(finish, "x1 long, x2 long, x3 long, f long")


def _merge_round(
    keys: Keys, segments: DataFrame, done: int, upto: int, entries: int, part_entries: int
) -> DataFrame:
    """Segments of `done` leading bits, merged within sets of sources of about `part_entries` entries
    and cut by `upto` leading bits."""
    sets = max(1, (entries >> done) // part_entries)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        prefix, source = (k.as_py() for k in key)
        return pa.Table.from_batches([_segments(keys, _merged(keys, table, done), source, prefix, done, upto)])

    grouped = segments.withColumn("source", F.pmod(F.xxhash64("source"), F.lit(sets)))
    return grouped.groupBy("prefix", "source").applyInArrow(run, _SEGMENTS)


# ---- scores


def mine_phrases(
    docs: DataFrame,
    least: int = 10,
    top: int = 2000,
    cover_percent: int = 50,
    block_bytes: int = BLOCK_BYTES,
    part_entries: int = PART_ENTRIES,
) -> DataFrame:
    """The best phrases of two and three words per language: `lang, rank, phrase, a, l, r, n, score`.

    Reads `docs(text, lang, ...)`. ASCII letters are lower-cased; pieces end at `[.,;:!?\\x0A-\\x0D]`,
    words are `[^\\x20\\x09]+` of a piece. A null language is `und`, a null text has no words; repeated
    rows count each. `a` counts a phrase, `l` and `r` the parts left and right of the cut with the
    lowest score `floor(1000000 * a * a / (l * r))`, `n` the words of the language. Candidates stand
    `least` times; one that lies in a longer candidate with `cover_percent` of its count is dropped.
    Equal scores are ordered by `a`, then by the phrase. A language without candidates has no rows, nor
    has an empty table. Scores are exact while `a` is below 10 ** 16.
    """
    blocks = materialize(split_blocks(docs, block_bytes), "phrase-blocks")
    words = blocks.select(F.explode("words").alias("w")).select("w.*")
    totals = materialize(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    vocabulary = number_words(words, least)
    found = materialize(count_phrases(blocks, vocabulary, least, part_entries), "phrases")

    pairs = found.where("x1 = 0").select(F.col("x2").alias("p"), F.col("x3").alias("q"), F.col("f").alias("a"))
    triples = found.where("x1 > 0").withColumnRenamed("f", "a")
    covers = triples.select(
        F.explode(F.array(F.struct(F.col("x1").alias("p"), F.col("x2").alias("q")), F.struct(F.col("x2").alias("p"), F.col("x3").alias("q")))).alias("pair"),
        "a",
    ).groupBy("pair.p", "pair.q").agg(F.max("a").alias("longer"))
    covered = F.coalesce(100 * F.col("longer") >= cover_percent * F.col("a"), F.lit(False))
    two = pairs.join(covers, ["p", "q"], "left").where(~covered)
    two = two.select(F.col("p").alias("x1"), F.lit(0).cast("long").alias("x2"), F.col("q").alias("x3"), "a")
    head = pairs.select(F.col("p").alias("x1"), F.col("q").alias("x2"), F.col("a").alias("head"))
    tail = pairs.select(F.col("p").alias("x2"), F.col("q").alias("x3"), F.col("a").alias("tail"))
    three = triples.join(head, ["x1", "x2"]).join(tail, ["x2", "x3"])
    candidates = two.withColumns({"head": F.lit(None).cast("long"), "tail": F.lit(None).cast("long")}).unionByName(three)

    first = vocabulary.select(F.col("id").alias("x1"), "lang", F.col("word").alias("w1"), F.col("n").alias("n1"))
    last = vocabulary.select(F.col("id").alias("x3"), F.col("word").alias("w3"), F.col("n").alias("n3"))
    middle = vocabulary.select(F.col("id").alias("x2"), F.col("word").alias("w2"))
    scored = (
        candidates.join(first, "x1")
        .join(last, "x3")
        .withColumn("cut1", _score("a", F.col("n1"), F.coalesce("tail", "n3")))
        .withColumn("cut2", F.when(F.col("head").isNotNull(), _score("a", F.col("head"), F.col("n3"))))
        .withColumn("early", F.col("cut2").isNull() | (F.col("cut1") <= F.col("cut2")))
        .withColumn("score", F.when(F.col("early"), F.col("cut1")).otherwise(F.col("cut2")))
    )
    spelt = _likely_best(scored, top).join(middle, "x2", "left").withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelt.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang",
        "rank",
        "phrase",
        "a",
        F.when(F.col("early"), F.col("n1")).otherwise(F.col("head")).alias("l"),
        F.when(~F.col("early"), F.col("n3")).otherwise(F.coalesce("tail", "n3")).alias("r"),
        "n",
        "score",
    )


def _likely_best(scored: DataFrame, top: int) -> DataFrame:
    """Rows of `scored(lang, score, ...)` among which the `top` of every language are, and few others.

    A language may hold most rows, so these are not sorted in one task: counts of scores by size
    class, of which a language has some hundred, tell from which class on `top` rows are reached.
    """
    written = materialize(scored.withColumn("size", F.floor(64 * F.log1p("score"))), "phrase-scores")
    classes = written.groupBy("lang", "size").count()
    above = Window.partitionBy("lang").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    wanted = classes.withColumn("above", F.coalesce(F.sum("count").over(above), F.lit(0))).where(F.col("above") < top)
    wanted = materialize(wanted.select("lang", "size"), "phrase-classes")
    return written.join(wanted, ["lang", "size"], "left_semi").drop("size")


def _score(a: str, left, right):
    whole = [c.cast("decimal(19,0)") for c in (F.col(a), F.col(a), left, right)]
    return F.call_function("div", whole[0] * whole[1] * F.lit(1_000_000).cast("decimal(7,0)"), whole[2] * whole[3])
