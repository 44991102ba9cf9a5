"""Language-model scores of documents by prediction by partial matching."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from brindle.llm.texts import Texts, find_words, lower_ascii, release, slices, word_hashes
from brindle.session import free, materialize

_BEFORE, _SPACE, _END = 0x0D, 0x20, 0x0A  # no word holds any of the three
_SYMBOLS = 256 - 6 + 2  # bytes of words, the space and the end
_WINDOW = 1 << 18
_MOST_TASKS = 20_000
_SLICE_BYTES = 1 << 18
_SET_ENTRIES = 4 << 20  # codes of some blocks that one task merges or looks up
_MERGED_ROWS = 32
_GRAM, _WORD, _TEXT = 0, 1, 2
_BLOCKS = "block long, kind int, bucket long, entries long, codes binary, counts binary, large binary"


def symbols(texts: Texts, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes to predict: per text `order` marks, its lowered words with one space between, an end.

    Returns them end to end, where each text begins, the hashes of all words and the words before
    each text.
    """
    data = lower_ascii(texts.data)
    words = find_words(data, texts.offsets)
    n, counts = len(texts.offsets) - 1, np.diff(words.offsets)
    lengths = words.ends - words.starts + 1
    total = np.concatenate(([0], np.cumsum(lengths)))
    bodies = np.maximum(total[words.offsets[1:]] - total[words.offsets[:-1]], 1)
    begins = np.concatenate(([0], np.cumsum(bodies + order)))
    stream = np.full(begins[-1], _BEFORE, np.uint8)
    owner = np.repeat(np.arange(n), counts)
    to = begins[owner] + order + total[:-1] - total[words.offsets[owner]]
    at = np.arange(total[-1])
    source = at + np.repeat(words.starts - total[:-1], lengths)
    stream[at + np.repeat(to - total[:-1], lengths)] = data[np.minimum(source, max(len(data) - 1, 0))]
    stream[to + lengths - 1] = _SPACE
    stream[begins[1:] - 1] = _END
    return stream, begins, word_hashes(data, words), words.offsets


def gram_codes(stream: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Windows of a stream: first place, which places are predicted, and their `order + 1` last bytes
    as one number each, the predicted byte lowest."""
    for begin in range(0, len(stream), _WINDOW):
        part = stream[max(0, begin - order) : begin + _WINDOW].astype(np.uint64)
        codes = part.copy()
        for back in range(1, order + 1):
            codes[back:] |= part[:-back] << np.uint64(8 * back)
        skip = min(begin, order)
        here = stream[begin : begin + _WINDOW]
        yield begin, here != _BEFORE, codes[skip:]


class Counts:
    """Distinct codes with their counts, merged whenever what was added outgrows what is held."""

    def __init__(self):
        self.codes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.added, self.size = [], 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.added.append((codes, counts))
        self.size += len(codes)
        if self.size > max(len(self.codes), 1 << 19):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        codes = np.concatenate([self.codes, *(c for c, _ in self.added)])
        counts = np.concatenate([self.counts, *(n for _, n in self.added)])
        self.added, self.size = [], 0
        by = np.argsort(codes, kind="stable")
        codes, counts = codes[by], counts[by]
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else by
        self.codes = codes[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts
        return self.codes, self.counts


class Lookup:
    """Places of known 64-bit keys by an open hash table that whole arrays are looked up in at once."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        pending, at = np.arange(len(keys), dtype=np.int32), self._first(keys)
        while len(pending):
            free = self.slots[at] < 0
            self.slots[at[free]] = pending[free]
            left = self.slots[at] != pending
            pending, at = pending[left], (at[left] + 1) & self.mask

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Each key must be known."""
        at = self._first(keys)
        found = self.slots[at]
        wrong = np.flatnonzero(self.keys[found] != keys)
        at = at[wrong]
        while len(wrong):
            at = (at + 1) & self.mask
            found[wrong] = self.slots[at]
            still = self.keys[found[wrong]] != keys[wrong]
            wrong, at = wrong[still], at[still]
        return found


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is a multiple of 10; a row without id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(True))


def _bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    return (codes * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(33)) % np.uint64(buckets)


def _dealt(codes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of sorted codes by bucket, in order."""
    bucket = _bucket(codes, buckets)
    by = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[by], np.arange(buckets + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, by[cuts[b] : cuts[b + 1]]


def _squeeze(values: np.ndarray, width: int) -> bytes:
    """Whole numbers of `width` bytes as compressed planes of bytes; of sorted ones the high planes are short."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _stretch(data: bytes, width: int, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * width, "zstd", asbytes=True), np.uint8).reshape(width, n)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = planes.T
    return wide.view("<u8").ravel().astype(np.uint64)


def _pack(codes: np.ndarray, counts: np.ndarray, width: int) -> tuple[int, bytes, bytes, bytes]:
    """Number of entries, codes of `width` bytes, counts of one byte, and those that need more."""
    large = counts[counts >= 255].astype("<i8").tobytes()
    return len(codes), _squeeze(codes, width), _squeeze(np.minimum(counts, 255), 1), large


def _unpack(row: dict, width: int) -> tuple[np.ndarray, np.ndarray]:
    counts = _stretch(row["counts"], 1, row["entries"]).astype(np.int64)
    counts[counts == 255] = np.frombuffer(row["large"], "<i8")
    return _stretch(row["codes"], width, row["entries"]), counts


# Prices are logarithms of 24 bits; word counts need more.
_VALUES = {_GRAM: "<f4", _WORD: "<f8"}


def _width(kind: int, order: int) -> int:
    return order + 1 if kind == _GRAM else 8


def _distinct(batches: list[pa.RecordBatch], order: int) -> dict[int, Counts]:
    """The distinct grams and words of some texts with how often those of training hold them."""
    held = {_GRAM: Counts(), _WORD: Counts()}
    for texts in slices(iter(batches), most=_SLICE_BYTES):
        learn = ~np.asarray(texts.rows.column("held_out").to_pylist(), bool)
        stream, begins, hashes, bounds = symbols(texts, order)
        own = np.repeat(learn, np.diff(begins))
        for begin, real, codes in gram_codes(stream, order):
            mine = own[begin : begin + len(codes)]
            found, n = np.unique(codes[real & mine], return_counts=True)
            held[_GRAM].add(found, n)
            other = np.unique(codes[real & ~mine])
            held[_GRAM].add(other, np.zeros(len(other), np.int64))
        own = np.repeat(learn, np.diff(bounds))
        found, n = np.unique(hashes[own], return_counts=True)
        other = np.unique(hashes[~own])
        held[_WORD].add(found, n)
        held[_WORD].add(other, np.zeros(len(other), np.int64))
    return held


def _press(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpress(blobs: list[bytes]) -> list[pa.RecordBatch]:
    return [batch for blob in blobs for batch in pa.ipc.open_stream(blob)]


def make_blocks(docs: DataFrame, order: int, buckets: int, block_bytes: int) -> DataFrame:
    """Rows of blocks, each of some consecutive texts of a partition of about `block_bytes`.

    A row holds either texts (`kind` 2, compressed in `codes`) or distinct grams or words with how
    often the block's training texts hold them, cut into buckets by a hash of the code. Blocks
    follow the partitions, so that many repeated rows are in many blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            made = [(_TEXT, 0, len(b), _press(b), b"", b"") for b in held]
            for kind, own in _distinct(held, order).items():
                codes, counts = own.merge()
                for b, at in _dealt(codes, buckets):
                    made.append((kind, b, *_pack(codes[at], counts[at], _width(kind, order))))
            for at in range(0, len(made), 16):
                columns = zip(*made[at : at + 16], strict=True)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                block = pa.array([number] * len(arrays[0]), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [block, *arrays], names=["block", "kind", "bucket", "entries", "codes", "counts", "large"]
                )
            release()

        for texts in slices(batches, most=min(_SLICE_BYTES, block_bytes)):
            if held and size + len(texts.data) > block_bytes:
                yield from rows()
                held, size, number = [], 0, number + 1
            held.append(pa.concat_batches([texts.rows]))
            size += len(texts.data)
        if held:
            yield from rows()

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, _BLOCKS)


def total_counts(held: DataFrame, order: int, sets: int) -> DataFrame:
    """`kind, bucket, code, n`: training counts over all blocks; codes only held out have 0.

    Blocks of a bucket are merged in `sets` tasks, their results `_MERGED_ROWS` at a time, until one
    task has all of a bucket.
    """

    def merged(key: tuple, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        total = Counts()
        for batch in table.to_batches():
            for row in batch.to_pylist():
                total.add(*_unpack(row, _width(key[0].as_py(), order)))
        return total.merge()

    def some(key: tuple, table: pa.Table) -> pa.Table:
        kind, bucket, block = (k.as_py() for k in key)
        fields = (block, kind, bucket, *_pack(*merged(key, table), _width(kind, order)))
        names = ["block", "kind", "bucket", "entries", "codes", "counts", "large"]
        return pa.table({n: pa.array([f], t) for n, f, t in zip(names, fields, _TYPES, strict=True)})

    def whole(key: tuple, table: pa.Table) -> pa.Table:
        codes, counts = merged(key, table)
        release()
        n = len(codes)
        return pa.table(
            {
                "kind": pa.array(np.full(n, key[0].as_py(), np.int32)),
                "bucket": pa.array(np.full(n, key[1].as_py(), np.int64)),
                "code": pa.array(codes.view(np.int64)),
                "n": pa.array(counts),
            }
        )

    while sets > 1:
        dealt = held.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(sets)))
        held = dealt.groupBy("kind", "bucket", "block").applyInArrow(some, _BLOCKS)
        sets = -(-sets // _MERGED_ROWS)
    return held.groupBy("kind", "bucket").applyInArrow(whole, "kind int, bucket long, code long, n long")


_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _state(total: Column, distinct: Column) -> Column:
    """A number for contexts of about as many bytes and distinct bytes."""
    bits = F.length(F.bin(total))
    level = F.when(total < 16, total).otherwise(4 * bits + F.call_function("shiftright", total, bits - 3))
    return (level * 32 + F.least(distinct, F.lit(31))).cast("long")


def escape_rates(contexts: DataFrame) -> DataFrame:
    """`state, rate`: how often a context of a state meets a byte that is new to it.

    Every training byte is left out once: its context then has one less, and the byte is new to it if
    it was there only once. States met 20 times or less are left out; their number is fixed.
    """
    zero = F.lit(0).cast("long")
    left_out = F.array(
        F.struct(_state(F.col("t") - 1, F.col("d") - 1).alias("state"), F.col("once").alias("new"), zero.alias("old")),
        F.struct(_state(F.col("t") - 1, F.col("d")).alias("state"), zero.alias("new"), (F.col("t") - F.col("once")).alias("old")),
    )
    return (
        contexts.where("t > 1")
        .select(F.inline(left_out))
        .groupBy("state")
        .agg(F.sum("new").alias("new"), F.sum("old").alias("old"))
        .where("new + old > 20")
        .select("state", ((F.col("new") + 0.5) / (F.col("new") + F.col("old") + 1)).alias("rate"))
    )


def gram_prices(grams: DataFrame, order: int) -> tuple[DataFrame, list[DataFrame]]:
    """`bucket, code, value`: log10 of the probability of the last byte after the others; and the
    tables that this is read from.

    `grams(bucket, code, n)` has all grams to be priced with their training counts; their sums under
    shorter contexts make the trie. The longest context is asked first: it is escaped with the rate
    of its state, or leaves the rest to the bytes it has seen, by their counts. After an escape the
    next shorter context is asked, with all bytes of the escaped one excluded from its sums. What no
    context has seen shares the rest of the alphabet.
    """
    seen, contexts, rates, todos = [], [], [], []
    for k in range(order + 1):
        mask = (1 << (8 * (k + 1))) - 1
        level = grams.where("n > 0").groupBy(F.col("code").bitwiseAND(F.lit(mask)).alias("g")).agg(F.sum("n").alias("n"))
        level = materialize(level, "seen")
        context = F.shiftrightunsigned("g", 8).alias("c")
        if k:
            below = seen[-1].select(F.col("g").alias("p"), F.col("n").alias("m"))
            level_in = level.join(below, level["g"].bitwiseAND(F.lit(mask >> 8)) == below["p"])
        else:
            level_in = level.withColumn("m", F.lit(0).cast("long"))
        sums = level_in.groupBy(context).agg(
            F.sum("n").alias("t"),
            F.count("*").alias("d"),
            F.sum("m").alias("x"),
            F.sum((F.col("n") == 1).cast("long")).alias("once"),
        )
        seen.append(level)
        contexts.append(materialize(sums, "contexts"))
        rates.append(materialize(escape_rates(contexts[-1]), "escape-rates"))
    zero = F.lit(0).cast("long")
    # x, d: count and number of the bytes that the context before excludes here
    todo = grams.select("bucket", "code", F.lit(0.0).alias("value"), zero.alias("x"), zero.alias("d"))
    priced = []
    for k in range(order, -1, -1):
        mask = (1 << (8 * (k + 1))) - 1
        gram = F.col("code").bitwiseAND(F.lit(mask))
        here = seen[k].select(F.col("g").alias("g"), F.col("n").alias("hit"))
        sums = contexts[k].select("c", F.col("t").alias("t2"), F.col("d").alias("d2"), F.col("x").alias("x2"))
        joined = (
            todo.withColumn("_g", gram)
            .withColumn("_c", F.shiftrightunsigned("_g", 8))
            .join(here, F.col("_g") == F.col("g"), "left")
            .join(sums, F.col("_c") == F.col("c"), "left")
        )
        joined = (
            joined.withColumn("_t", F.coalesce("t2", zero) - F.col("x"))
            .withColumn("_d", F.coalesce("d2", zero) - F.col("d"))
            .withColumn("_state", _state(F.col("_t"), F.col("_d")))
            .join(F.broadcast(rates[k]), F.col("_state") == F.col("state"), "left")
        )
        rate = F.coalesce("rate", F.col("_d") / (2 * F.col("_t")))
        rate = F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))
        found = joined.where("hit is not null").select(
            "bucket", "code", (F.col("value") + F.log10((1 - rate) * F.col("hit") / F.col("_t"))).alias("value")
        )
        escaped = joined.where("hit is null").select(
            "bucket",
            "code",
            (F.col("value") + F.when(F.col("_d") > 0, F.log10(rate)).otherwise(0.0)).alias("value"),
            F.coalesce("x2", zero).alias("x"),
            F.coalesce("d2", zero).alias("d"),
        )
        priced.append(found)
        todo = materialize(escaped, "escaped")
        todos.append(todo)
    rest = F.greatest(F.lit(_SYMBOLS) - F.col("d"), F.lit(1)).cast("double")
    result = todo.select("bucket", "code", (F.col("value") - F.log10(rest)).alias("value"))
    for found in priced:
        result = result.unionByName(found)
    return result, [*seen, *contexts, *rates, *todos]


def block_prices(held: DataFrame, prices: DataFrame, order: int, sets: int) -> DataFrame:
    """`block, kind, bucket, values`: the prices of the codes that each block holds, in their order.

    The prices of a bucket are packed and sent to each of its `sets` of blocks.
    """

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        codes, values = table["code"].to_numpy().view(np.uint64), table["value"].to_numpy()
        by = np.argsort(codes)
        return pa.table(
            {
                "kind": pa.array([key[0].as_py()], pa.int32()),
                "bucket": pa.array([key[1].as_py()], pa.int64()),
                "size": pa.array([len(codes)], pa.int64()),
                "known": pa.array([_squeeze(codes[by], _width(key[0].as_py(), order))], pa.binary()),
                "prices": pa.array([values[by].astype(_VALUES[key[0].as_py()]).tobytes()], pa.binary()),
            }
        )

    def run(key: tuple, blocks: pa.Table, table: pa.Table) -> pa.Table:
        width = _width(key[0].as_py(), order)
        known = _stretch(table["known"][0].as_py(), width, table["size"][0].as_py())
        values = np.frombuffer(table["prices"][0].as_py(), _VALUES[key[0].as_py()])
        found = [
            values[np.searchsorted(known, _stretch(codes.as_py(), width, n.as_py()))].tobytes()
            for codes, n in zip(blocks["codes"], blocks["entries"], strict=True)
        ]
        return pa.table(
            {"block": blocks["block"], "kind": blocks["kind"], "bucket": blocks["bucket"], "values": pa.array(found, pa.binary())}
        )

    packed = prices.groupBy("kind", "bucket").applyInArrow(pack, "kind int, bucket long, size long, known binary, prices binary")
    spread = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(sets - 1))))
    dealt = held.select("block", "kind", "bucket", "entries", "codes", F.pmod(F.xxhash64("block"), F.lit(sets)).cast("int").alias("part"))
    pairs = dealt.groupBy("kind", "bucket", "part").cogroup(spread.groupBy("kind", "bucket", "part"))
    return pairs.applyInArrow(run, "block long, kind int, bucket long, values binary")


def score_texts(docs: DataFrame, order: int = 5, block_bytes: int = 8 << 20) -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score` for every row of
    `docs(doc_id, text, ...)`.

    Learns from the rows that are not held out. `score` is the log10 probability of the text's
    bytes (A-Z lowered, one space between words, then an end) under contexts of up to `order`
    bytes; `base_score` is that of its words and an end by their smoothed frequencies, `n_known`
    counts those seen in training, `train_tokens` all training words and ends.

    Texts are taken in blocks of about `block_bytes`. A block asks for the prices of the distinct
    grams and words it holds and gets just these, so no task or driver holds the model, which grows
    with the input. The codes of a block go to a number of buckets that grows with the root of the
    bytes read. A null or wordless text is one end. Repeated rows are learnt and scored each; rows
    without id are held out. With no training rows all bytes cost the same.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    size, learnt = docs.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
        F.coalesce(F.sum((~F.col("held_out")).cast("long")), F.lit(0)),
    ).first()
    buckets = max(1, math.isqrt(int(size) // (block_bytes >> 1)))
    blocks = materialize(make_blocks(docs, order, buckets, block_bytes), "blocks")
    held = blocks.where(f"kind <> {_TEXT}")
    entries, number = held.agg(F.coalesce(F.sum("entries"), F.lit(0)), F.count_distinct("block")).first()
    sets = max(1, -(-entries // (buckets * _SET_ENTRIES)))
    totals = materialize(total_counts(held, order, sets), "totals")
    words = totals.where(f"kind = {_WORD}")
    n, v = words.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # the end is one more token, seen once in each training text
    n, v = n + learnt, v + (learnt > 0)
    floor = n + 0.1 * (v + 1)
    word_prices = words.select(F.lit(_WORD).alias("kind"), "bucket", "code", F.col("n").cast("double").alias("value"))
    grams, used = gram_prices(totals.where(f"kind = {_GRAM}").drop("kind"), order)
    prices = grams.select(F.lit(_GRAM).alias("kind"), "bucket", "code", "value").unionByName(word_prices)
    prices = materialize(prices, "prices")
    free(totals, *used)
    priced = block_prices(held, prices, order, sets).withColumnRenamed("block", "of")

    def tables(batches: list[pa.RecordBatch], own: pa.Table) -> dict[int, tuple[Lookup, np.ndarray]]:
        """Per kind the block's codes, found again from its texts, and their prices."""
        found = {}
        for kind, counts in _distinct(batches, order).items():
            codes = counts.merge()[0]
            mine = own.filter(pc.equal(own["kind"], kind))
            of = dict(zip(mine["bucket"].to_pylist(), mine["values"], strict=True))
            values = np.zeros(len(codes))
            for b, at in _dealt(codes, buckets):
                values[at] = np.frombuffer(of[b].as_py(), _VALUES[kind])
            found[kind] = (Lookup(codes), values)
        return found

    def run(key: tuple, table: pa.Table, own: pa.Table) -> pa.Table:
        batches = _unpress(table["codes"].to_pylist())
        found = tables(batches, own)
        grams, gram_value = found[_GRAM]
        known, word_count = found[_WORD]
        out = []
        for texts in slices(iter(batches), most=_SLICE_BYTES):
            stream, begins, hashes, bounds = symbols(texts, order)
            each = np.zeros(len(stream))
            for begin, real, codes in gram_codes(stream, order):
                places = begin + np.flatnonzero(real)
                each[places] = gram_value[grams.places(codes[real])]
            score = np.add.reduceat(each, begins[:-1])
            counts = word_count[known.places(hashes)] if len(hashes) else np.zeros(0)
            logs = np.concatenate(([0.0], np.cumsum(np.log10((counts + 0.1) / floor))))
            seen = np.concatenate(([0], np.cumsum(counts > 0)))
            base = logs[bounds[1:]] - logs[bounds[:-1]] + np.log10((learnt + 0.1) / floor)
            size = np.diff(bounds) + 1
            out.append(
                pa.record_batch(
                    {
                        "doc_id": texts.rows.column("doc_id"),
                        "held_out": texts.rows.column("held_out"),
                        "n_tokens": pa.array(size, pa.int64()),
                        "n_known": pa.array(seen[bounds[1:]] - seen[bounds[:-1]] + (learnt > 0), pa.int64()),
                        "train_tokens": pa.array(np.full(len(size), n, np.int64)),
                        "base_score": pa.array(base),
                        "score": pa.array(score),
                    }
                )
            )
        return pa.Table.from_batches(out)

    # about one block to a task, so that sorting them takes little memory
    tasks = max(1, min(number, _MOST_TASKS))
    texts = blocks.where(f"kind = {_TEXT}").select("block", "codes").repartition(tasks, "block")
    return (
        texts.groupBy("block")
        .cogroup(priced.repartition(tasks, "of").groupBy("of"))
        .applyInArrow(
            run,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )
