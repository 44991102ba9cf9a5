"""Record linkage: TF-IDF weights, cosine similarity and its evaluation against gold pairs.

Records are tables `id, tokens`. Nothing but a count is ever brought to the driver and no table of
all pairs is formed:

* tokens are counted where they are read, in blocks of some thousand records; only the distinct
  tokens of a block meet the dictionary, so the tokens of the records are not exchanged by token;
* copies of a record (equal token lists) are collapsed to one vector, so that a group of copies
  costs one row instead of all its pairs;
* `similar_pairs` joins the inverted indices only on the rare end of every vector, which provably
  holds a common token of every pair at or above the asked similarity;
* sums over all pairs are taken per token, not per pair.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.arrays import map_cosine
from brindle.functions.text import token_counts, tokenize
from brindle.operators.grouping import global_index
from brindle.session import materialize

# A block holds records of about this many tokens, or one longer record.
BLOCK_TOKENS = 1 << 21
# Vectors are compared in cells of two blocks of about this many rows of tokens, or of one longer vector.
CELL_ROWS = 1 << 20
# Products of postings of a cell that are held at a time.
CELL_PRODUCTS = 1 << 21
# A task meets this many blocks of a side.
PART_BLOCKS = 16
# Share of the similarity bound that the unindexed, frequent end of a vector may hold.
INDEX_SLACK = 0.7
_EPS = 1e-9


def token_table(records: DataFrame, stopwords: Sequence[str] = ()) -> DataFrame:
    """`id, text` to `id, tokens`."""
    return records.select("id", tokenize(F.col("text"), stopwords).alias("tokens"))


def remove_words(words: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Rows of a long table `id, token, ...` whose token is not a `word` of a large stopword table."""
    return words.join(stopwords.select(F.col("word").alias("token")), "token", "left_anti")


def tokens_without(records: DataFrame, stopwords: DataFrame) -> DataFrame:
    """`id, text` to `id, tokens` without the words of a table `word` of any size.

    The tokens become rows, the stopword table decides by its written size how they are joined, and
    each record gets its remaining tokens back in order and with repeats. Records keep their row
    when no token is left. Ids must be unique.
    """
    words = F.transform(tokenize(F.col("text")), lambda w, i: F.struct(i.alias("at"), w.alias("token")))
    first = F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("string").alias("token")))
    long = records.select("id", F.inline(F.concat(first, F.coalesce(words, F.array().cast("array<struct<at:int,token:string>>")))))
    left = remove_words(long, materialize(stopwords.select("word").distinct(), "stopwords"))
    ordered = F.sort_array(F.collect_list(F.struct("at", "token")))
    return left.groupBy("id").agg(F.transform(F.slice(ordered, 2, 1 << 30), lambda t: t["token"]).alias("tokens"))


def weight_maps(weights: DataFrame) -> DataFrame:
    """`id, vector`: the weights of every record as a map from token to weight.

    Rows of `tfidf` are grouped by record. Its lists already hold a record each, so the maps are written where
    they lie; ids must be unique then, repeated ones are refused.
    """
    if "weights" not in weights.columns:
        entries = F.collect_list(F.struct("token", "weight"))
        return weights.groupBy("id").agg(F.map_from_entries(entries).alias("vector"))
    maps = materialize(weights.select("id", F.map_from_arrays("tokens", "weights").alias("vector")), "vectors")
    repeated = maps.groupBy("id").count().where("count > 1").select("id").first()
    if repeated:
        raise ValueError(f"id {repeated[0]} has more than one list of weights")
    return maps


def score_chosen(pairs: DataFrame, vectors_a: DataFrame, vectors_b: DataFrame) -> DataFrame:
    """`id_a, id_b, n_common, sim` of chosen pairs, from whole vectors held as maps.

    A record without tokens has no vector and is similar to nothing. Vectors that no pair asks for stay where
    they lie, as long as the ids of the pairs can be broadcast; `pairs` should be written, so that Spark knows.
    """

    def asked(vectors: DataFrame, side: str) -> DataFrame:
        found = vectors.select(F.col("id").alias(f"id_{side}"), F.col("vector").alias(side))
        return found.join(pairs.select(f"id_{side}"), f"id_{side}", "left_semi")

    joined = pairs.select("id_a", "id_b").join(asked(vectors_a, "a"), "id_a", "left")
    joined = joined.join(asked(vectors_b, "b"), "id_b", "left")
    common = F.size(F.array_intersect(F.map_keys("a"), F.map_keys("b")))
    return joined.select(
        "id_a",
        "id_b",
        F.when(F.col("a").isNull() | F.col("b").isNull(), 0).otherwise(common).cast("long").alias("n_common"),
        F.coalesce(map_cosine(F.col("a"), F.col("b")), F.lit(0.0)).alias("sim"),
    )


def token_count(records: DataFrame) -> DataFrame:
    return records.agg(F.sum(F.size("tokens")).alias("n_tokens"))


def biggest_record(records: DataFrame) -> DataFrame:
    """The record with most tokens; ties by the smallest id."""
    size = F.size("tokens").cast("long").alias("n_tokens")
    return records.select("id", size).orderBy(F.desc("n_tokens"), "id").limit(1)


def term_frequency(records: DataFrame) -> DataFrame:
    """`id, token, tf` where tf is the share of the record's tokens; no shuffle."""
    counted = records.select(
        "id", F.size("tokens").alias("n"), F.inline_outer(token_counts(F.col("tokens")))
    )
    return counted.where(F.col("token").isNotNull()).select("id", "token", (F.col("c") / F.col("n")).alias("tf"))


def inverse_document_frequency(records: DataFrame) -> DataFrame:
    """`token, idf` with idf = number of distinct ids / records holding the token.

    `records` are `id, tokens`, or their `token_blocks`, which were counted when they were written.
    """
    if _in_blocks(records):
        ids = records.select(F.explode("records.id").alias("id"))
        held = records.select(F.inline("words")).groupBy("token").agg(F.sum("df").alias("df"))
    else:
        ids = records
        tokens = records.select(F.explode_outer(F.array_distinct("tokens")).alias("token"))
        held = tokens.where(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    total = ids.agg(F.countDistinct("id")).scalar()
    return held.select("token", (total / F.col("df")).alias("idf"))


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2 ** 32, compressed byte by byte: most high bytes are 0."""
    planes = np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zlib.compress(planes.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _block_row(block: int, rows: pa.Table, keys: list[str], schema: pa.Schema) -> pa.RecordBatch:
    lists = rows.column("tokens").combine_chunks()
    size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    if lists.null_count:
        size[lists.is_null().to_numpy(zero_copy_only=False)] = 0
    spelt = lists.flatten().dictionary_encode()
    codes = spelt.indices.fill_null(-1).to_numpy().astype(np.int64)
    kinds = max(len(spelt.dictionary), 1)
    owner = np.repeat(np.arange(len(size)), size)
    own, n = np.unique((owner * kinds + codes)[codes >= 0], return_counts=True)
    codes = own % kinds
    words = pa.StructArray.from_arrays(
        [spelt.dictionary, pa.array(np.bincount(codes, minlength=len(spelt.dictionary)).astype(np.int64))], ["token", "df"]
    )
    records = pa.StructArray.from_arrays([rows.column(k).combine_chunks() for k in keys], keys)

    def listed(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    held = np.bincount(own // kinds, minlength=len(size))
    columns = [pa.array([block]), listed(records), listed(words)]
    columns += [pa.array([_pack(x)], pa.binary()) for x in (size, held, codes, n)]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def token_blocks(records: DataFrame, keys: Sequence[str], block_tokens: int | None = None) -> DataFrame:
    """Rows `block, records, words, size, held, codes, n` of about `block_tokens` tokens each, written.

    `records` lists the columns `keys` of the records of a block, `words` its distinct tokens with the number
    of its records that hold them. Of each record, `size` is the number of tokens and `held` that of distinct
    ones; `codes` are their places in `words` and `n` how often they stand. Nothing is exchanged.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    most, keys = block_tokens or BLOCK_TOKENS, list(keys)
    chosen = records.select(*keys, "tokens")
    kept = StructType([chosen.schema[k] for k in keys]).simpleString()
    ddl = f"block long, records array<{kept}>, words array<struct<token: string, df: long>>, size binary, held binary, codes binary, n binary"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        room = most
        for batch in batches:
            sizes = np.diff(batch.column("tokens").offsets.to_numpy()).astype(np.int64)
            ends = np.cumsum(sizes)
            begin = 0
            while begin < len(sizes):
                before = int(ends[begin - 1]) if begin else 0
                end = max(int(np.searchsorted(ends, before + room, side="right")), begin)
                if end == begin and not held:
                    end = begin + 1  # a record of more tokens than a block
                if end > begin:
                    held.append(batch.slice(begin, end - begin))
                    room -= int(ends[end - 1]) - before
                if end < len(sizes):
                    yield _block_row(number, pa.Table.from_batches(held), keys, schema)
                    held, room, number = [], most, number + 1
                begin = end
        if held:
            yield _block_row(number, pa.Table.from_batches(held), keys, schema)

    return materialize(chosen.mapInArrow(run, ddl), "token-blocks")


def _in_blocks(records: DataFrame) -> bool:
    return "tokens" not in records.columns


def _block_words(blocks: DataFrame) -> DataFrame:
    words = blocks.select(F.col("block").alias("of"), F.posexplode("words").alias("local", "word"))
    return words.select("of", "local", "word.token", "word.df")


def _block_postings(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each posting of a block: the place of its record, of its token, how often it stands and among how many."""
    size, held, codes, n = (_unpack(block[c]) for c in ("size", "held", "codes", "n"))
    owner = np.repeat(np.arange(len(size)), held)
    return owner, codes, n, size[owner]


def tfidf(records: DataFrame, idf: DataFrame, lists: Sequence[str] = ()) -> DataFrame:
    """`id, token, weight`; with `lists`, of `tokens` and `weights`, a row `id, *lists` per record that has any.

    `records` are `id, tokens` or their `token_blocks`. The dictionary is written first, so that its size
    is known. It meets the distinct tokens of every block, and each block gets the entries of its own tokens.
    Spelling is carried along only where tokens are asked for.
    """
    blocks = records if _in_blocks(records) else token_blocks(records, ["id"])
    known = _block_words(blocks).join(materialize(idf, "idf"), "token").select("of", "local", "idf")
    kind = blocks.select(F.explode("records.id").alias("id")).schema["id"].dataType.simpleString()
    columns = {"tokens": "array<string>", "weights": "array<double>"} if lists else {"token": "string", "weight": "double"}
    columns = {c: columns[c] for c in lists or columns}
    spelt = not {"token", "tokens"}.isdisjoint(columns)

    def weigh(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("records").combine_chunks().flatten().field(0)
        packed = left.select(["size", "held", "codes", "n"]).to_pylist()[0]
        owner, codes, n, size = _block_postings(packed)
        value = np.full(int(codes.max(initial=-1)) + 1, np.nan)
        value[right.column("local").to_numpy()] = right.column("idf").to_numpy()
        there = ~np.isnan(value[codes])
        owner, codes = owner[there], codes[there]
        found = {"weight": pa.array(n[there] / size[there] * value[codes])}
        if spelt:
            found["token"] = left.column("words").combine_chunks().flatten().field(0).take(pa.array(codes))
        if lists:
            # the postings of a record lie side by side
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))[: len(owner)])
            cuts = pa.array(np.append(first, len(owner)).astype(np.int32))
            found, owner = {f"{c}s": pa.ListArray.from_arrays(cuts, v) for c, v in found.items()}, owner[first]
        return pa.table({"id": ids.take(pa.array(owner))} | {c: found[c] for c in columns})

    ddl = ", ".join([f"id {kind}", *[f"{c} {t}" for c, t in columns.items()]])
    kept = blocks if spelt else blocks.drop("words")
    return kept.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(weigh, ddl)


def norms(weights: DataFrame) -> DataFrame:
    """`id, norm` of the rows or lists of `tfidf`."""
    square = F.col("weight") * F.col("weight")
    if "weights" in weights.columns:
        square = F.aggregate("weights", F.lit(0.0), lambda acc, w: acc + w * w)
    return weights.groupBy("id").agg(F.sqrt(F.sum(square)).alias("norm"))


def smallest_idf(idf: DataFrame, k: int = 11) -> DataFrame:
    return idf.orderBy("idf", "token").limit(k)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """`bin, n` over equal-width bins between the smallest and the largest value."""
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    place = F.coalesce(F.floor(F.try_divide((F.col(column) - low) * bins, high - low)), F.lit(0))
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.least(place, F.lit(bins - 1)).cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# Tokens are graded by the whole part of the logarithm of their frequency.
GRADES = 32
_BODY = "size long, norm double, body binary"


@dataclass(frozen=True)
class LinkageIndex:
    """Two catalogues as weighted vectors.

    `members` has `side, id, vid`: the vector of every record, named by its smallest id. `vectors` has
    `side, vid, copies, size, norm, body`: `body` holds rank, count and document frequency of every token,
    frequent ones first, see `_postings`. `dictionary` has `token, df, rank`, ranks by falling frequency,
    and `total` is the number of distinct ids.
    """

    members: DataFrame
    vectors: DataFrame
    dictionary: DataFrame
    total: int

    def side(self, side: str) -> DataFrame:
        columns = [F.col(c).alias(f"{c}_{side}") for c in ("vid", "copies", "size", "norm", "body")]
        return self.vectors.where(F.col("side") == side).select(*columns)

    def side_members(self, side: str) -> DataFrame:
        return self.members.where(F.col("side") == side).select(
            F.col("id").alias(f"id_{side}"), F.col("vid").alias(f"vid_{side}")
        )


def _postings(body: bytes, size: int, norm: float, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of the tokens of a vector in order, their document frequencies and their shares of the norm."""
    steps, n, falls = _unpack(body).reshape(3, -1)
    df = np.cumsum(-falls) + 2 * falls[:1]  # the first is the frequency itself
    return np.cumsum(steps), df, n / size * (total / df) / norm


def build_index(a: DataFrame, b: DataFrame) -> LinkageIndex:
    """Index of two token tables. Ids must be unique within a side; repeated ones are refused."""
    both = a.select(F.lit("a").alias("side"), "id", "tokens").unionByName(
        b.select(F.lit("b").alias("side"), "id", "tokens")
    )
    content = F.unhex(F.sha2(F.concat_ws(" ", "tokens"), 256)).alias("content")
    blocks = token_blocks(both.select("side", "id", content, "tokens"), ["side", "id", "content"])
    keyed = blocks.select(F.col("block").alias("of"), F.posexplode("records").alias("at", "record"))
    keyed = keyed.select("of", "at", "record.*")
    repeated = keyed.groupBy("side", "id").count().where("count > 1").select("side", "id").first()
    if repeated:
        raise ValueError(f"side {repeated[0]} has id {repeated[1]} more than once")
    # sides of n:1 joins are written: their size is known, so Spark broadcasts or splits them by it
    contents = materialize(
        keyed.groupBy("side", "content").agg(F.min("id").alias("vid"), F.count(F.lit(1)).alias("copies")), "contents"
    )
    members = materialize(keyed.join(contents, ["side", "content"]).drop("content"), "members")
    total = keyed.agg(F.countDistinct("id")).first()[0]

    words = _block_words(blocks)
    frequency = words.groupBy("token").agg(F.sum("df").alias("df"))
    dictionary = materialize(global_index(frequency, [F.desc("df"), "token"], "rank"), "dictionary")
    # what a block needs: rank and frequency of its tokens, and which of its records stand for all copies
    known = words.drop("df").join(dictionary, "token").select(
        "of", F.lit(False).alias("record"), "local", F.col("rank").alias("x"), F.col("df").alias("y")
    )
    named = members.where("id = vid").select(
        "of", F.lit(True).alias("record"), F.col("at").alias("local"), F.col("copies").alias("x"), F.lit(0).cast("long").alias("y")
    )
    kind = both.schema["id"].dataType.simpleString()

    def weigh(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        records = left.column("records").combine_chunks().flatten()
        owner, codes, n, size = _block_postings(left.drop_columns(["records", "words"]).to_pylist()[0])
        flag = right.column("record").to_numpy()
        local, x, y = (right.column(c).to_numpy() for c in ("local", "x", "y"))
        rank, df = np.zeros((2, int(codes.max(initial=-1)) + 1), np.int64)
        rank[local[~flag]], df[local[~flag]] = x[~flag], y[~flag]
        copies = np.zeros(len(records), np.int64)
        copies[local[flag]] = x[flag]
        by = np.flatnonzero(copies[owner])
        by = by[np.lexsort((rank[codes[by]], owner[by]))]
        owner, n, size, rank, df = owner[by], n[by], size[by], rank[codes[by]], df[codes[by]]
        weight = n / size * (total / df)
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))[: len(owner)])
        bodies, norms = [], []
        for start, end in zip(first, [*first[1:], len(owner)]):
            cut = slice(start, end)
            bodies.append(_pack(np.concatenate((np.diff(rank[cut], prepend=0), n[cut], -np.diff(df[cut], prepend=2 * df[start])))))
            norms.append(math.sqrt(float(np.sum(weight[cut] * weight[cut]))))
        at = pa.array(owner[first])
        return pa.table(
            {
                "side": records.field("side").take(at),
                "vid": records.field("id").take(at),
                "copies": copies[owner[first]],
                "size": size[first],
                "norm": pa.array(norms, pa.float64()),
                "body": pa.array(bodies, pa.binary()),
            }
        )

    vectors = blocks.groupBy("block").cogroup(known.unionByName(named).groupBy("of")).applyInArrow(
        weigh, f"side string, vid {kind}, copies long, {_BODY}"
    )
    return LinkageIndex(members.select("side", "id", "vid"), materialize(vectors, "vectors"), dictionary, total)


def _pair_columns(pairs: DataFrame, index: LinkageIndex, extra: str, rate: Callable) -> DataFrame:
    """`vid_a, vid_b, copies_a, copies_b` and the columns `extra` that `rate` makes of the shares of the
    tokens common to both vectors and of their ranks."""
    total = index.total
    kinds = [f"{c} {pairs.schema[c].dataType.simpleString()}" for c in ("vid_a", "vid_b")]
    names = [part.split()[0] for part in extra.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, tuple] = {}

        def vector(side: str, vid, row: tuple) -> tuple:
            # rows of one vector lie side by side
            if side not in last or last[side][0] != vid:
                last[side] = (vid, *_postings(*row, total))
            return last[side]

        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            rated = []
            for i in range(batch.num_rows):
                a, b = (
                    vector(s, columns[f"vid_{s}"][i], tuple(columns[f"{c}_{s}"][i] for c in ("body", "size", "norm")))
                    for s in "ab"
                )
                ranks, x, y = np.intersect1d(a[1], b[1], assume_unique=True, return_indices=True)
                rated.append(rate(a[3][x] * b[3][y], ranks))
            kept = {c: batch.column(c) for c in ("vid_a", "vid_b", "copies_a", "copies_b")}
            yield pa.RecordBatch.from_pydict(kept | {c: [r[i] for r in rated] for i, c in enumerate(names)})

    joined = pairs.select("vid_a", "vid_b").join(index.side("a"), "vid_a").join(index.side("b"), "vid_b")
    return joined.mapInArrow(run, f"{', '.join(kinds)}, copies_a long, copies_b long, {extra}")


def score_vectors(index: LinkageIndex, pairs: DataFrame) -> DataFrame:
    """Exact cosine of distinct `vid_a, vid_b`; pairs without a common token are absent."""
    found = _pair_columns(pairs, index, "n_common long, total double", lambda parts, ranks: (len(ranks), float(parts.sum())))
    return found.where("n_common > 0").select(
        "vid_a", "vid_b", "copies_a", "copies_b", "n_common", _cosine(F.col("total")).alias("sim")
    )


class _Block:
    """A block of vectors in memory; `ranks` are its distinct tokens and `codes` the places there of its postings.

    `cut` is where the indexed part of every vector starts, `grade` the lowest grade before it and `held` has
    the norms of its tokens of each grade or a higher one, see `candidate_pairs`.
    """

    def __init__(self, row: dict, total: int):
        self.vids, self.copies = row["vids"], row["copies"].to_numpy()
        steps, falls = _unpack(row["known"]).reshape(2, -1)
        self.ranks = np.cumsum(steps)
        df = np.cumsum(-falls) + 2 * falls[:1]
        lengths, sizes, cuts = _unpack(row["lengths"]).reshape(3, -1)
        self.codes, n = _unpack(row["postings"]).reshape(2, -1)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.owner = np.repeat(np.arange(len(lengths)), lengths)
        norms = row["norms"].to_numpy()
        self.unit = n / sizes[self.owner] * (total / df[self.codes]) / norms[self.owner]
        squares = self.unit * self.unit
        grades = np.frexp(df)[1] - 1
        every = np.bincount(self.owner * GRADES + grades[self.codes], squares, len(lengths) * GRADES).reshape(-1, GRADES)
        self.held = np.sqrt(np.cumsum(every[:, ::-1], axis=1)[:, ::-1])
        self.cut = self.starts + cuts
        self.grade = np.where(self.cut > self.starts, grades[self.codes[np.maximum(self.cut - 1, 0)]], GRADES)
        self.indexed = np.flatnonzero(np.arange(len(self.owner)) >= self.cut[self.owner])

    def by_rank(self) -> None:
        """Places of the indexed postings of every token."""
        codes = self.codes[self.indexed]
        order = self.indexed[np.argsort(codes, kind="stable")]
        self.n_of = np.bincount(codes, minlength=len(self.ranks))
        self.first_of = np.cumsum(self.n_of) - self.n_of
        self.list_owner, self.list_unit = self.owner[order], self.unit[order]


def _spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """`first[i], first[i] + 1, ...`, `n[i]` of them, one after the other."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - n), n)


def _slices(n: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of `n` that add up to at most `most`, or of one larger number."""
    ends, begin = np.cumsum(n), 0
    while begin < len(n):
        before = ends[begin - 1] if begin else 0
        end = max(int(np.searchsorted(ends, before + most, side="right")), begin + 1)
        yield slice(begin, end)
        begin = end


def _partial_sums(a: _Block, b: _Block, into: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of vectors of a and b, in the order of a, and what tokens indexed in both add to their cosine."""
    place = into[a.codes[a.indexed]]
    met = np.flatnonzero((place >= 0) & (b.n_of[place] > 0))
    posting, place = a.indexed[met], place[met]
    owner, unit, n, first, width = a.owner[posting], a.unit[posting], b.n_of[place], b.first_of[place], len(b.starts)
    # owners one after the other: their number of products and their first posting
    begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))[: len(owner)])
    work = np.add.reduceat(n, begin) if len(begin) else n
    stop = np.append(begin[1:], len(owner))
    for part in _slices(work, CELL_PRODUCTS):
        low, high = begin[part.start], stop[part.stop - 1]
        base = owner[low]
        room = (int(owner[high - 1]) - int(base) + 1) * width
        if part.stop - part.start == 1 or room <= 4 * int(work[part].sum()):
            sums = np.zeros(room)
            for piece in _slices(n[low:high], CELL_PRODUCTS):
                piece = slice(low + piece.start, low + piece.stop)
                at = _spans(first[piece], n[piece])
                key = np.repeat((owner[piece] - base) * width, n[piece]) + b.list_owner[at]
                sums += np.bincount(key, np.repeat(unit[piece], n[piece]) * b.list_unit[at], room)
            key = np.flatnonzero(sums)
            sums = sums[key]
        else:
            piece = slice(low, high)
            at = _spans(first[piece], n[piece])
            key = np.repeat((owner[piece] - base) * width, n[piece]) + b.list_owner[at]
            order = np.argsort(key)
            key = key[order]
            new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sums = np.add.reduceat((np.repeat(unit[piece], n[piece]) * b.list_unit[at])[order], new)
            key = key[new]
        yield key // width + base, key % width, sums


def _near(a: _Block, b: _Block, into: np.ndarray, min_sim: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of candidates of two blocks, in the order of a."""
    for x, y, sums in _partial_sums(a, b, into):
        kept = sums >= min_sim - INDEX_SLACK * min_sim - _EPS
        x, y, sums = x[kept], y[kept], sums[kept]
        lowest = np.minimum(a.grade[x], b.grade[y])
        at = np.minimum(lowest, GRADES - 1)
        missing = np.where(lowest == GRADES, 0.0, a.held[x, at] * b.held[y, at])
        kept = sums + missing >= min_sim - _EPS
        yield x[kept], y[kept]


def _whole_sums(a: _Block, b: _Block, into: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of common tokens and cosine of pairs of places, in the order of a."""
    # of b only the postings of tokens that a has, by their place in a
    back = np.full(len(b.ranks), -1)
    back[into[into >= 0]] = np.flatnonzero(into >= 0)
    code = back[b.codes]
    shared = np.flatnonzero(code >= 0)
    code, unit = code[shared], b.unit[shared]
    n = np.bincount(b.owner[shared], minlength=len(b.starts))
    first = np.cumsum(n) - n
    width = len(a.ranks)
    found = [(np.zeros(0, np.int64), np.zeros(0))]
    begin = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))[: len(x)])
    stop = np.append(begin[1:], len(x))
    rows = max(1, CELL_PRODUCTS // max(width, 1))
    spread = np.zeros(rows * width)
    for group in range(0, len(begin), rows):
        ones = x[begin[group : group + rows]]
        held = a.ends[ones] - a.starts[ones]
        mine = _spans(a.starts[ones], held)
        filled = np.repeat(np.arange(len(ones)) * width, held) + a.codes[mine]
        spread[filled] = a.unit[mine]
        low, high = begin[group], stop[min(group + rows, len(begin)) - 1]
        row = np.searchsorted(ones, x[low:high]) * width
        for piece in _slices(n[y[low:high]], CELL_PRODUCTS):
            other = y[low:high][piece]
            at = _spans(first[other], n[other])
            mass = spread[np.repeat(row[piece], n[other]) + code[at]]
            pair = np.repeat(np.arange(len(other)), n[other])
            found.append((np.bincount(pair, mass > 0, len(other)).astype(np.int64), np.bincount(pair, mass * unit[at], len(other))))
        spread[filled] = 0.0
    return tuple(np.concatenate(c) for c in zip(*found))


def _vector_blocks(index: LinkageIndex, side: str, min_sim: float, cell_rows: int) -> DataFrame:
    """Vectors of a side in blocks of about `cell_rows` tokens, one compressed row each, written."""
    total, bound = index.total, INDEX_SLACK * min_sim - _EPS
    kind = index.vectors.schema["vid"].dataType.simpleString()

    def block(held: list[tuple], vid_type: pa.DataType) -> pa.RecordBatch:
        vids, copies, sizes, norms, cuts, ranks, counts, dfs = zip(*held)
        known, first, codes = np.unique(np.concatenate(ranks), return_index=True, return_inverse=True)
        df = np.concatenate(dfs)[first]
        columns = {
            "vids": pa.array([list(vids)], pa.list_(vid_type)),
            "copies": [list(copies)],
            "norms": [list(norms)],
            "lengths": [_pack(np.array([[len(r) for r in ranks], sizes, cuts]).ravel())],
            "known": [_pack(np.concatenate((np.diff(known, prepend=0), -np.diff(df, prepend=2 * df[0]))))],
            "postings": [_pack(np.concatenate((codes, *counts)))],
        }
        return pa.RecordBatch.from_pydict({f"{c}_{side}": v for c, v in columns.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, room, vid_type = [], cell_rows, None
        for batch in batches:
            vid_type = batch.schema.field("vid").type
            for vid, copies, size, norm, body in zip(*(batch.column(c).to_pylist() for c in ("vid", "copies", "size", "norm", "body"))):
                ranks, df, unit = _postings(body, size, norm, total)
                if held and len(ranks) > room:
                    yield block(held, vid_type)
                    held, room = [], cell_rows
                cut = int(np.searchsorted(np.sqrt(np.cumsum(unit * unit)), bound, side="left"))
                held.append((vid, copies, size, norm, cut, ranks, _unpack(body).reshape(3, -1)[1], df))
                room -= len(ranks)
        if held:
            yield block(held, vid_type)

    ddl = [f"vids array<{kind}>", "copies array<long>", "norms array<double>", "lengths binary", "known binary", "postings binary"]
    named = ", ".join(c.replace(" ", f"_{side} ", 1) for c in ddl)
    chosen = index.vectors.where(F.col("side") == side).select("vid", "copies", "size", "norm", "body")
    blocks = materialize(chosen.mapInArrow(run, named), f"vector-blocks-{side}")
    # parts of few blocks, and enough of them for the cells to keep all cores busy
    n, cores = blocks.count(), blocks.sparkSession.sparkContext.defaultParallelism
    return blocks.repartition(max(1, min(n, max(math.isqrt(4 * cores), -(-n // PART_BLOCKS)))))


def _celled_pairs(index: LinkageIndex, min_sim: float, scored: bool, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Candidates of every block of a with every block of b, and their exact cosine if `scored`."""
    if not 0 < min_sim <= 1:
        raise ValueError("min_sim must lie in (0, 1]")
    total = index.total
    kind = index.vectors.schema["vid"].dataType.simpleString()

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[dict, dict]]:
        for i in range(batch.num_rows):
            yield tuple(
                {
                    c: batch.column(f"{c}_{s}")[i].values if c in ("vids", "copies", "norms") else batch.column(f"{c}_{s}")[i].as_py()
                    for c in ("vids", "copies", "norms", "lengths", "known", "postings")
                }
                for s in "ab"
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, a = None, None
        for batch in batches:
            for left, right in rows(batch):
                # a block of a meets one block of b after the other
                if key != (left["postings"], left["known"]) or not a.vids.equals(left["vids"]):
                    key, a = (left["postings"], left["known"]), _Block(left, total)
                b = _Block(right, total)
                b.by_rank()
                into = np.searchsorted(b.ranks, a.ranks)
                into[b.ranks[np.minimum(into, len(b.ranks) - 1)] != a.ranks] = -1
                for x, y in _near(a, b, into, min_sim):
                    columns = {"vid_a": a.vids.take(pa.array(x)), "vid_b": b.vids.take(pa.array(y))}
                    if scored:
                        n, sums = _whole_sums(a, b, into, x, y)
                        columns |= {"copies_a": a.copies[x], "copies_b": b.copies[y], "n_common": n, "total": sums}
                    yield pa.RecordBatch.from_pydict(columns)

    more = ", copies_a long, copies_b long, n_common long, total double" if scored else ""
    # every part of one side reads the parts of the other; no pair is exchanged
    left, right = (_vector_blocks(index, s, min_sim, cell_rows) for s in "ab")
    cells = left.hint("shuffle_replicate_nl").crossJoin(right)
    return cells.mapInArrow(run, f"vid_a {kind}, vid_b {kind}{more}")


def candidate_pairs(index: LinkageIndex, min_sim: float, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Distinct `vid_a, vid_b` among which are all pairs of similarity `min_sim` or more.

    Sort the tokens of all vectors by one order, frequent ones first, and leave out of the index the
    longest start of every vector whose norm is below `s = INDEX_SLACK * min_sim` of the whole. The
    common tokens of a pair that are not indexed on both sides lie in the start of one of the two,
    so by Cauchy-Schwarz they add less than `s` to the cosine. Hence a pair at `min_sim` or above
    collects at least `min_sim - s` from tokens indexed on both sides. All these common tokens are of the
    lowest grade that either start has, or of a higher one, so they add no more than the product of the two
    norms of such tokens, which is far below `s` for most pairs.
    """
    return _celled_pairs(index, min_sim, False, cell_rows)


def similar_pairs(index: LinkageIndex, min_sim: float) -> DataFrame:
    """All pairs of distinct vectors with cosine `min_sim` or more.

    `vid_a, vid_b, copies_a, copies_b, n_common, sim`; a row stands for `copies_a * copies_b`
    pairs of records, which `expand_pairs` lists. Candidates are found and scored from whole vectors
    where a block of a meets a block of b, so neither they nor partial sums are exchanged or written.
    """
    found = _celled_pairs(index, min_sim, True)
    return found.select("vid_a", "vid_b", "copies_a", "copies_b", "n_common", _cosine(F.col("total")).alias("sim")).where(
        F.col("sim") >= min_sim
    )


def _cosine(total: Column) -> Column:
    """A sum of products without the last digits, which depend on the order of the summands."""
    return F.round(total, 12)


def expand_pairs(index: LinkageIndex, pairs: DataFrame) -> DataFrame:
    """`id_a, id_b, sim` for the records behind vector pairs; as large as the answer itself."""
    return (
        pairs.select("vid_a", "vid_b", "sim")
        .join(index.side_members("a"), "vid_a")
        .join(index.side_members("b"), "vid_b")
        .select("id_a", "id_b", "sim")
    )


def _mapped(index: LinkageIndex, pairs: DataFrame) -> DataFrame:
    return pairs.join(index.side_members("a"), "id_a", "left").join(
        index.side_members("b"), "id_b", "left"
    )


def score_pairs(index: LinkageIndex, pairs: DataFrame) -> DataFrame:
    """Cosine of given `id_a, id_b` pairs; 0 without a common token or with an unknown id."""
    mapped = _mapped(index, pairs.select("id_a", "id_b"))
    known = mapped.where("vid_a is not null and vid_b is not null")
    scored = materialize(score_vectors(index, known.select("vid_a", "vid_b").distinct()), "scores")
    return mapped.join(scored.select("vid_a", "vid_b", "n_common", "sim"), ["vid_a", "vid_b"], "left").select(
        "id_a",
        "id_b",
        F.coalesce("n_common", F.lit(0)).alias("n_common"),
        F.coalesce("sim", F.lit(0.0)).alias("sim"),
    )


def lookup(a: DataFrame, b: DataFrame, id_a, id_b) -> DataFrame:
    """Similarity of one pair of records of two token tables; 0 for unknown ids.

    Only the two records are weighted; the tables are read for the number of records and for those
    that hold a token of the two.
    """
    both = a.select("id", "tokens").unionByName(b.select("id", "tokens"))
    total = both.agg(F.countDistinct("id")).scalar()

    def terms(records: DataFrame, key) -> DataFrame:
        own = records.where(F.col("id") == key).select(
            F.size("tokens").alias("n"), F.inline(token_counts(F.col("tokens")))
        )
        return materialize(own.select("token", (F.col("c") / F.col("n")).alias("tf")), "lookup-terms")

    left, right = terms(a, id_a), terms(b, id_b)
    asked = left.select("token").unionByName(right.select("token")).distinct()
    held = both.select(F.explode(F.array_distinct("tokens")).alias("token")).join(asked, "token", "left_semi")
    idf = materialize(
        held.groupBy("token").agg(F.count(F.lit(1)).alias("df")).select("token", (total / F.col("df")).alias("idf")),
        "lookup-idf",
    )
    weights = (
        idf.join(left.withColumnRenamed("tf", "tf_a"), "token", "left")
        .join(right.withColumnRenamed("tf", "tf_b"), "token", "left")
        .select(*[(F.coalesce(F.col(f"tf_{s}"), F.lit(0.0)) * F.col("idf")).alias(s) for s in "ab"])
    )
    size = F.sqrt(F.sum(F.col("a") * F.col("a"))) * F.sqrt(F.sum(F.col("b") * F.col("b")))
    sim = F.coalesce(F.try_divide(F.sum(F.col("a") * F.col("b")), size), F.lit(0.0))
    return weights.agg(sim.alias("sim")).select(F.lit(id_a).alias("id_a"), F.lit(id_b).alias("id_b"), "sim")


def pair_count(index: LinkageIndex) -> int:
    """Number of all pairs of records."""
    sizes = dict(index.members.groupBy("side").count().collect())
    return sizes.get("a", 0) * sizes.get("b", 0)


def _rank_blocks(found: DataFrame) -> DataFrame:
    """Rows `block, vids_a, vids_b, known, lengths, codes` of pairs with about `BLOCK_TOKENS` ranks, written.

    `known` are the distinct ranks of a block, `lengths` the number of ranks of a pair, `codes` their places.
    """
    kinds = [found.schema[c].dataType.simpleString() for c in ("vid_a", "vid_b")]
    names = ["block", "vids_a", "vids_b", "known", "lengths", "codes"]

    def block(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        lists = rows.column("ranks").combine_chunks()
        known, codes = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)

        def listed(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        columns = [pa.array([number]), *[listed(rows.column(c).combine_chunks()) for c in ("vid_a", "vid_b")]]
        return pa.RecordBatch.from_arrays([*columns, listed(pa.array(known)), *[pa.array([_pack(x)]) for x in (lengths, codes)]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, room = TaskContext.get().partitionId() << 32, [], BLOCK_TOKENS
        for batch in batches:
            sizes = np.diff(batch.column("ranks").offsets.to_numpy()).astype(np.int64)
            for part in _slices(sizes, BLOCK_TOKENS):
                n = int(sizes[part].sum())
                if held and n > room:
                    yield block(number, held)
                    number, held, room = number + 1, [], BLOCK_TOKENS
                held.append(batch.slice(part.start, part.stop - part.start))
                room -= n
        if held:
            yield block(number, held)

    ddl = f"block long, vids_a array<{kinds[0]}>, vids_b array<{kinds[1]}>, known array<long>, lengths binary, codes binary"
    return materialize(found.select("vid_a", "vid_b", "ranks").mapInArrow(run, ddl), "rank-blocks")


def common_tokens(index: LinkageIndex, pairs: DataFrame) -> DataFrame:
    """`vid_a, vid_b, tokens`: sorted common tokens of distinct vector pairs.

    A list is bounded by the vocabulary of one text. Only the distinct ranks of a block of pairs meet the dictionary.
    """
    found = _pair_columns(pairs, index, "ranks array<bigint>", lambda parts, ranks: (ranks,))
    blocks = _rank_blocks(found.where(F.size("ranks") > 0))
    asked = blocks.select(F.col("block").alias("of"), F.posexplode("known").alias("local", "rank"))
    spelt = asked.join(index.dictionary.select("rank", "token"), "rank").select("of", "local", "token")

    def spell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        words = right.sort_by("local").column("token").combine_chunks()
        order = pc.sort_indices(words).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        row = left.select(["lengths", "codes"]).to_pylist()[0]
        lengths, codes = _unpack(row["lengths"]), _unpack(row["codes"])
        pair = np.repeat(np.arange(len(lengths)), lengths)
        codes = codes[np.lexsort((place[codes], pair))]
        ends = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
        tokens = pa.ListArray.from_arrays(ends, words.take(pa.array(codes)))
        vids = [left.column(f"vids_{s}").combine_chunks().flatten() for s in "ab"]
        return pa.table([*vids, tokens], names=["vid_a", "vid_b", "tokens"])

    kinds = [found.schema[c].dataType.simpleString() for c in ("vid_a", "vid_b")]
    return blocks.groupBy("block").cogroup(spelt.groupBy("of")).applyInArrow(
        spell, f"vid_a {kinds[0]}, vid_b {kinds[1]}, tokens array<string>"
    )


def duplicate_average(scored_gold: DataFrame) -> DataFrame:
    """Number and mean similarity of gold pairs that share a token; null mean when there are none."""
    found = scored_gold.where(F.col("n_common") > 0)
    return found.agg(F.count(F.lit(1)).alias("n_pairs"), F.avg("sim").alias("avg_sim"))


def other_average(index: LinkageIndex, scored_gold: DataFrame) -> DataFrame:
    """Number and mean similarity of all pairs of records that are not gold, zeros included.

    The sum of the cosines of all pairs is, token by token, the product of the two sides' sums, so
    its cost is that of one pass over the index.
    """
    total = index.total

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("side", "copies", "body", "size", "norm")]
            ranks, sums = [np.zeros(0, np.int64)], {s: [np.zeros(0)] for s in "ab"}
            for side, copies, body, size, norm in zip(*columns):
                rank, _, unit = _postings(body, size, norm, total)
                ranks.append(rank)
                sums[side].append(unit * copies)
                sums["b" if side == "a" else "a"].append(np.zeros(len(unit)))
            rank, place = np.unique(np.concatenate(ranks), return_inverse=True)
            added = {f"s_{s}": np.bincount(place, np.concatenate(sums[s]), len(rank)) for s in "ab"}
            yield pa.RecordBatch.from_pydict({"rank": rank} | added)

    added = index.vectors.mapInArrow(add, "rank long, s_a double, s_b double")
    sums = added.groupBy("rank").agg(F.sum("s_a").alias("s_a"), F.sum("s_b").alias("s_b"))
    whole = sums.agg(F.coalesce(F.sum(F.col("s_a") * F.col("s_b")), F.lit(0.0))).scalar()
    sizes = index.members.agg(
        *[F.count_if(F.col("side") == s).alias(f"n_{s}") for s in "ab"]
    )
    gold = scored_gold.where(F.col("n_common") > 0).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("sim"), F.lit(0.0)).alias("sim")
    )
    return sizes.select(
        (F.col("n_a") * F.col("n_b") - gold.select("n").scalar()).alias("n_pairs"),
        (whole - gold.select("sim").scalar()).alias("sum_sim"),
    ).select("n_pairs", F.try_divide("sum_sim", "n_pairs").alias("avg_sim"))


def evaluate(
    sims: DataFrame, scored_gold: DataFrame, min_sim: float, steps: int = 100, n_pairs: int | None = None
) -> DataFrame:
    """Quality of linking at every threshold `i / steps` from `min_sim` up.

    With `n_pairs`, the number of all pairs of records, threshold 0 is rated too: it links them all.

    `sims` are vector pairs from `similar_pairs(index, min_sim)`, `scored_gold` distinct gold pairs
    from `score_pairs`. False positives use bins `int(sim * steps)`, false negatives raw scores.
    """
    low = int(-(-min_sim * steps // 1))
    score_bin = (F.col("sim") * steps).cast("int")
    linked = sims.groupBy(F.least(score_bin, F.lit(steps)).alias("i")).agg(
        F.sum(F.col("copies_a") * F.col("copies_b")).alias("linked")
    )
    right = (
        scored_gold.where(F.col("sim") >= min_sim)
        .groupBy(F.least(score_bin, F.lit(steps)).alias("i"))
        .agg(F.count(F.lit(1)).alias("right"))
    )
    # the first threshold that misses a gold pair: smallest i with sim < i / steps
    missed_at = (
        F.when(F.col("sim") < score_bin / steps, score_bin)
        .when(F.col("sim") < (score_bin + 1) / steps, score_bin + 1)
        .otherwise(score_bin + 2)
    )
    missed = scored_gold.groupBy(F.greatest(missed_at, F.lit(low)).alias("i")).agg(
        F.count(F.lit(1)).alias("missed")
    )
    if n_pairs is not None and low > 1:
        raise ValueError("threshold 0 can only be added below the first threshold")
    grid = sims.sparkSession.range(low if n_pairs is None else 0, steps + 1).select(F.col("id").cast("int").alias("i"))
    n_gold = scored_gold.agg(F.count(F.lit(1))).scalar()
    # windows over at most `steps + 1` rows
    at_or_above = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    at_or_below = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    counts = (
        grid.join(linked, "i", "left")
        .join(right, "i", "left")
        .join(missed, "i", "left")
        .na.fill(0)
        .select(
            "i",
            (F.sum("linked").over(at_or_above) - F.sum("right").over(at_or_above)).alias("fp"),
            F.sum("missed").over(at_or_below).alias("fn"),
        )
        .where(F.col("i") < steps)
        .withColumn("tp", n_gold - F.col("fn"))
    )
    if n_pairs is not None:
        counts = counts.withColumn("fp", F.when(F.col("i") == 0, n_pairs - n_gold).otherwise(F.col("fp")))
    rated = counts.withColumn("precision", F.try_divide("tp", F.col("tp") + F.col("fp"))).withColumn(
        "recall", F.try_divide("tp", F.col("tp") + F.col("fn"))
    )
    f = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rated.select(
        (F.col("i") / steps).alias("threshold"), "tp", "fp", "fn", "precision", "recall", f.alias("f_measure")
    )
