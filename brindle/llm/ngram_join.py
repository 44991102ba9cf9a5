"""Similarity join of texts on word n-grams by tries of globally ordered gram sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from brindle.llm.components import connected_components
from brindle.llm.joins import maybe_in, text_mark, without
from brindle.llm.texts import find_words, lower_ascii, mix, slices, window_hashes, word_hashes
from brindle.operators.grouping import global_index
from brindle.session import free, materialize

_BLOCK_GRAMS = 4_500_000
_CELL_GRAMS = 1_000_000
_MATRIX = 8_000_000


def gram_sets(texts, width: int) -> list[np.ndarray]:
    """The set of each text as an ascending array of 63-bit gram hashes."""
    data = lower_ascii(texts.data)
    words = find_words(data, texts.offsets)
    grams, bounds = window_hashes(word_hashes(data, words), words.offsets, width)
    grams >>= np.uint64(1)
    return [np.unique(grams[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def set_keys(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    first = int(mix(grams).sum(dtype=np.uint64))
    second = int(mix(grams ^ np.uint64(0x5DEECE66D1234567)).sum(dtype=np.uint64))
    return _signed(first), _signed(second)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def document_sets(docs: DataFrame, width: int) -> DataFrame:
    """Rows `doc_id, n, key_a, key_b` per document, and rows `gram, n` per gram that a block of
    documents holds in two different sets or more, with the number of these sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, total = [], set(), 0

        def repeated() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            grams, counts = grams[counts > 1], counts[counts > 1]
            none = pa.nulls(len(grams), pa.int64())
            return _batch(none, pa.array(counts), none, none, pa.array(grams.view(np.int64)))

        def _batch(*columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(list(columns), names=["doc_id", "n", "key_a", "key_b", "gram"])

        for texts in slices(batches):
            found = []
            for grams in gram_sets(texts, width):
                key = set_keys(grams)
                found.append((len(grams), *key))
                if len(grams) and key not in keys:
                    keys.add(key)
                    held.append(grams)
                    total += len(grams)
            n, a, b = (pa.array(c, pa.int64()) for c in zip(*found, strict=True))
            yield _batch(texts.rows.column("doc_id"), n, a, b, pa.nulls(len(found), pa.int64()))
            if total >= _BLOCK_GRAMS:
                yield repeated()
                held, keys, total = [], set(), 0
        yield repeated()

    return docs.mapInArrow(run, "doc_id long, n long, key_a long, key_b long, gram long")


def most_repeated(counts: DataFrame, most: int) -> np.ndarray:
    """Tags (the high 31 bits) of the grams of `counts(gram, n)` with the largest sums, at most `most`,
    the largest last.

    The smallest sum that keeps to the bound is found from the number of grams per sum, sums from 64
    on by powers of two.
    """
    written = materialize(counts.groupBy("gram").agg(F.sum("n").alias("n")), "repeated")
    level = F.when(F.col("n") < 64, F.col("n")).otherwise(F.floor(F.log2("n")) + 58)
    sums = written.withColumn("level", level)
    least, total = 1 << 20, 0
    for found in sums.groupBy("level").count().orderBy(F.desc("level")).collect():
        total += found["count"]
        if total > most:
            break
        least = found["level"]
    tag, size = F.shiftright("gram", 32).cast("int").alias("tag"), F.least("n", F.lit(1 << 30)).cast("int").alias("n")
    chosen = sums.where(F.col("level") >= least).select(tag, size).toArrow()
    free(written)
    tags, n = (chosen[c].to_numpy().astype(np.uint32) for c in ("tag", "n"))
    tags = tags[np.lexsort((tags, n))]
    last = len(tags) - 1 - np.unique(tags[::-1], return_index=True)[1]
    return tags[np.sort(last)]


class GramOrder:
    """A total order of grams: those whose tag is not known to be frequent by hash, then the others,
    the most frequent last. Any such order gives the same links; a good one gives few candidates."""

    def __init__(self, frequent: np.ndarray):
        self.places = np.argsort(frequent, kind="stable").astype(np.uint32)
        self.tags = frequent[self.places]

    def ranks(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.tags):
            return grams
        tags = (grams >> np.uint64(32)).astype(np.uint32)
        at = np.searchsorted(self.tags, tags)
        at[at == len(self.tags)] = 0
        known = self.tags[at] == tags
        late = np.uint64(1 << 63) | self.places[at].astype(np.uint64) << np.uint64(32) | grams & np.uint64(0xFFFFFFFF)
        return np.where(known, late, grams)


def prefix_length(n: int, percent: int) -> int:
    """How many grams of a set of `n`, in any order common to all sets, hold one of every partner."""
    return n - (percent * n + 99) // 100 + 1


def chained(held: list[tuple[np.ndarray, int, int]], percent: int) -> pa.RecordBatch:
    """Postings `gram, node, n` of a block of sets, each given by some grams, its node and its size.

    Sets of alike size under one gram are chained on the spot by a gram of their own, and one of them
    stands for all, so a gram of very many sets becomes few rows before the exchange.
    """
    lengths = np.array([len(g) for g, _, _ in held], np.int64)
    grams = np.concatenate([np.zeros(0, np.uint64), *(g for g, _, _ in held)]).view(np.int64)
    node = np.repeat(np.array([k for _, k, _ in held], np.int64), lengths)
    n = np.repeat(np.array([s for _, _, s in held], np.int64), lengths)
    by = np.lexsort((node, n, grams))
    grams, node, n = grams[by], node[by], n[by]
    # sizes within one class differ by less than the threshold
    kind = np.floor(np.log(np.maximum(n, 1)) / (np.log(100 / percent) if percent < 100 else 1.0))
    head = np.ones(len(grams), bool)
    head[1:] = (grams[1:] != grams[:-1]) | (kind[1:] != kind[:-1])
    tail = np.flatnonzero(~head)
    pairs = np.unique(np.stack((node[tail - 1], node[tail]), 1), axis=0)
    own = mix(pairs[:, 0].view(np.uint64) ^ mix(pairs[:, 1].view(np.uint64))) | np.uint64(1 << 63)
    own, zero = own.view(np.int64), np.zeros(len(own), np.int64)
    columns = (
        np.concatenate((grams[head], own, own)),
        np.concatenate((node[head], pairs[:, 0], pairs[:, 1])),
        np.concatenate((n[head], zero, zero)),
    )
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "node", "n"])


def prefix_postings(docs: DataFrame, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """`gram, node, n`: sets (by their second key) under the first grams of their order.

    Two sets that link share a gram within their first `prefix_length`.
    """
    order = docs.sparkSession.sparkContext.broadcast(GramOrder(frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, total = [], set(), 0

        for texts in slices(batches):
            for grams in gram_sets(texts, width):
                key = set_keys(grams)
                if not len(grams) or key in keys:
                    continue
                keys.add(key)
                first = prefix_length(len(grams), percent)
                ranks = order.value.ranks(grams)
                kept = grams[np.argpartition(ranks, first - 1)[:first]] if first < len(grams) else grams
                held.append((kept, key[1], len(grams)))
                total += first
            if total >= _BLOCK_GRAMS // 9:
                yield chained(held, percent)
                held, keys, total = [], set(), 0
        yield chained(held, percent)

    return docs.mapInArrow(run, "gram long, node long, n long")


def candidate_links(postings: DataFrame, percent: int) -> DataFrame:
    """`a, b`: neighbours by size among the sets under one gram, unless their sizes rule it out.

    Sizes may differ by the square of the threshold, as a row can stand for others of its class.
    """
    by_size = W.partitionBy("gram").orderBy("n", "node")
    return (
        postings.withColumn("b", F.lag("node").over(by_size))
        .withColumn("m", F.lag("n").over(by_size))
        .where((F.col("b") != F.col("node")) & (F.col("m") * 10_000 >= F.col("n") * percent * percent))
        .select(F.col("node").alias("a"), "b")
        .distinct()
    )


def exact_postings(members: DataFrame, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """`gram, node, n` as in `prefix_postings` for `members(key_b, n, text)`, in a better order.

    The order puts first the grams whose hash is low, half as many again as a prefix takes, those in
    fewer of these sets first; then the others as in `prefix_postings`. Only low grams have to be
    counted, and those that a single set holds link nothing and are dropped once counted.
    """
    order = members.sparkSession.sparkContext.broadcast(GramOrder(frequent))
    low_end = np.uint64(min((1 << 63) - 1, (1 << 63) * 3 * (100 - percent) // 200))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "node", "n", "low"]
        for texts in slices(batches):
            low, rest = [], []
            nodes = texts.rows.column("key_b").to_pylist()
            for grams, node in zip(gram_sets(texts, width), nodes, strict=True):
                n = len(grams)
                ranks = order.value.ranks(grams)
                by = np.argsort(ranks)
                lower = int(np.searchsorted(ranks[by], low_end))
                low.append((grams[by[:lower]], node, n))
                rest.append((grams[by[lower : prefix_length(n, percent)]], node, n))
            lengths = np.array([len(g) for g, _, _ in low], np.int64)
            columns = [np.concatenate([np.zeros(0, np.uint64), *(g for g, _, _ in low)]).view(np.int64)]
            for values in ([k for _, k, _ in low], [n for _, _, n in low], lengths):
                columns.append(np.repeat(np.asarray(values, np.int64), lengths))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
            others = chained(rest, percent)
            yield pa.RecordBatch.from_arrays([*others.columns, pa.nulls(len(others), pa.int64())], names=names)

    found = members.select("key_b", "text").mapInArrow(run, "gram long, node long, n long, low long")
    is_low = F.col("low").isNotNull()
    of_node = W.partitionBy("node")
    counted = (
        found.withColumn("df", F.count("*").over(W.partitionBy("gram")))
        .where((F.col("df") > 1) | ~is_low)
        .withColumn("place", F.row_number().over(of_node.orderBy(~is_low, "df", "gram")))
        .withColumn("place", F.col("place") + F.col("low") - F.count("low").over(of_node))
    )
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return counted.where(~is_low | (F.col("place") <= first)).select("gram", "node", "n")


def trie_join(
    sets: list[np.ndarray], weights: np.ndarray, percent: int, split: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Per set: a label shared by linked sets, and the weight of the sets it links with.

    All sets are joined with each other or, with `split`, the first `split` with the rest. The sets
    of one side are stored in a trie in one order of grams, the most common first. All sets of the
    other side walk down it together: at a node, the overlap with the path so far is shared by
    everything below, and a set leaves the walk where the grams that remain on either side cannot
    reach the threshold for any length below, or where the overlap is enough for all of them.
    """
    k = len(sets)
    labels, links = np.arange(k), np.zeros(k, np.int64)
    probes = np.arange(k if split is None else split)
    stored = np.arange(0 if split is None else split, k)
    if not len(probes) or not len(stored):
        return labels, links
    sizes = np.array([len(s) for s in sets], np.int64)
    grams, codes, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(df > 1)
    if not len(shared):
        return labels, links
    rank = np.full(len(grams), -1, np.int64)
    rank[shared[np.argsort(-df[shared], kind="stable")]] = np.arange(len(shared))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    paths = []
    for i in range(k):
        path = rank[codes[bounds[i] : bounds[i + 1]]]
        paths.append(np.sort(path[path >= 0]))
    lengths = np.array([len(p) for p in paths], np.int64)

    leaves = np.array(sorted(stored.tolist(), key=lambda i: paths[i].astype(">u4").tobytes()), np.int64)
    leaf_size, leaf_rest = sizes[leaves], lengths[leaves]
    leaf_weight = np.concatenate(([0], np.cumsum(weights[leaves])))
    gained = np.zeros(len(leaves) + 1, np.int64)
    whole, part = 100 + percent, percent

    def accept(who: np.ndarray, lo: int, hi: int) -> None:
        nonlocal labels
        links[who] += leaf_weight[hi] - leaf_weight[lo]
        if split is not None:
            got = weights[who].sum()
            gained[lo] += got
            gained[hi] -= got
        met = np.unique(np.concatenate((labels[who], labels[leaves[lo:hi]])))
        if len(met) > 1:
            labels = np.where(np.isin(labels, met), met[0], labels)

    height = max(1, _MATRIX // len(shared))
    for begin in range(0, len(probes), height):
        group = probes[begin : begin + height]
        has = np.zeros((len(group), len(shared)), np.uint8)
        for row, i in enumerate(group):
            has[row, paths[i]] = 1
        passed = np.cumsum(has, axis=1, dtype=np.int32)
        rows = np.arange(len(group))
        stack = [(0, len(leaves), 0, rows, np.zeros(len(group), np.int64))]
        while stack:
            lo, hi, depth, rows, overlap = stack.pop()
            first, last = paths[leaves[lo]], paths[leaves[hi - 1]]
            least = min(len(first), len(last))
            differ = np.flatnonzero(first[depth:least] != last[depth:least])
            end = depth + int(differ[0]) if len(differ) else least
            if end > depth:
                run = first[depth:end]
                overlap = overlap + has[np.ix_(rows, run)].sum(axis=1)
            who = group[rows]
            size = sizes[who]
            enough = whole * overlap >= part * (size + leaf_size[lo:hi].max())
            if enough.any():
                accept(who[enough], lo, hi)
            rest = lengths[who] - (passed[rows, first[end - 1]] if end else 0)
            most = overlap + np.minimum(rest, leaf_rest[lo:hi].max() - end)
            alive = ~enough & (whole * most >= part * (size + leaf_size[lo:hi].min()))
            if not alive.any():
                continue
            rows, overlap, who, size = rows[alive], overlap[alive], who[alive], size[alive]
            while lo < hi and leaf_rest[lo] == end:  # sets that end here
                found = whole * overlap >= part * (size + leaf_size[lo])
                if found.any():
                    accept(who[found], lo, lo + 1)
                lo += 1
            if lo < hi:
                steps = np.array([paths[i][end] for i in leaves[lo:hi]])
                cuts = [0, *(np.flatnonzero(steps[1:] != steps[:-1]) + 1).tolist(), hi - lo]
                stack += [
                    (lo + a, lo + b, end, rows, overlap) for a, b in zip(cuts[:-1], cuts[1:], strict=True)
                ]
    if split is None:
        links -= np.where(whole * lengths >= part * 2 * sizes, weights, 0)  # sets that have met themselves
    else:
        links[leaves] += np.cumsum(gained)[:-1]
    return labels, links


def join_cells(members: DataFrame, width: int, percent: int) -> DataFrame:
    """`rep, label, links` per member of a cell; `members(cell, side, rep, key_a, weight, text)`.

    Rows come sorted by cell, so a task holds one cell at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}

        def joined() -> pa.RecordBatch:
            rows = sorted(held.items(), key=lambda kv: (kv[1][0], kv[0]))
            sides = [side for _, (side, _, _) in rows]
            reps = np.array([rep for (rep, _), _ in rows], np.int64)
            labels, links = trie_join(
                [grams for _, (_, grams, _) in rows],
                np.array([weight for _, (_, _, weight) in rows], np.int64),
                percent,
                sides.index(1) if 1 in sides else None if cell[1] == cell[2] else len(sides),
            )
            low = np.full(len(reps), np.iinfo(np.int64).max)
            np.minimum.at(low, labels, reps)
            return pa.RecordBatch.from_arrays(
                [pa.array(reps), pa.array(low[labels]), pa.array(links)], names=["rep", "label", "links"]
            )

        for texts in slices(batches):
            rows = texts.rows.drop_columns(["text"]).to_pylist()
            for row, grams in zip(rows, gram_sets(texts, width), strict=True):
                here = (row["component"], row["i"], row["j"])
                if here != cell:
                    if held:
                        yield joined()
                    cell, held = here, {}
                held[row["rep"], row["key_a"]] = (row["side"], grams, row["weight"])
        if held:
            yield joined()

    cells = members.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return cells.mapInArrow(run, "rep long, label long, links long")


def ngram_links(
    docs: DataFrame, width: int = 5, percent: int = 80, frequent_grams: int = 1 << 20
) -> DataFrame:
    """`doc_id, n_shingles, component_id, n_links` for every row of `docs(doc_id, text, ...)`.

    A document's set holds its distinct runs of `width` words (`[^\\x20\\x09-\\x0D]+`, A-Z lowered), or
    its whole sequence if it has fewer; the set of a null or wordless text is empty and linked with
    nothing. Two documents link where `100 * intersection >= percent * union`. `component_id` is
    the smallest id reachable by links, `n_links` the number of documents linked with (copies too).

    Equal sets are one node with a weight. Nodes that share a gram of their prefixes are chained,
    twice: first all of them, in an order known beforehand, with the grams last that blocks of
    documents repeat most (`frequent_grams` bounds that list; it changes the work only, not the
    result); then those that met another one, in the order of counted frequencies. The components
    of the second chains hold every link inside, so each is joined on its own by `trie_join`, and a
    set travels once. A component of more than `_CELL_GRAMS` grams is dealt into blocks and joined
    block by block.

    Repeated rows give a row each and link as copies; an id that stands for several texts is one
    document that links by each. Of rows without id, those equal to a row with
    one belong to its component, others have a null one and no links. Grams are compared by 63-bit
    hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = materialize(document_sets(docs, width), "sets")
    rows = first.where("gram is null").drop("gram")
    frequent = most_repeated(first.where("gram is not null").select("gram", "n"), frequent_grams)
    nodes = materialize(
        rows.where("n > 0")
        .groupBy("key_a", "key_b", "n")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("weight")),
        "nodes",
    )
    links = candidate_links(prefix_postings(docs, width, percent, frequent), percent)
    links = materialize(links, "candidates")
    touched = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    held = nodes.join(touched, nodes["key_b"] == touched["node"]).where("rep is not null").drop("node")
    held = materialize(held, "held")
    free(links)
    # the texts of all candidates, which later steps read instead of the documents
    # (candidates grow with the input, so they are never broadcast; other texts stay in their tasks)
    wanted = maybe_in(docs, held.select(F.col("rep").alias("doc_id")), "doc_id").where("maybe").drop("maybe")
    texts = wanted.join(held.hint("merge"), wanted["doc_id"] == held["rep"]).drop("doc_id")
    repeated = rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if not repeated.isEmpty():
        texts = matching(texts, width)
    texts = materialize(texts, "candidate-texts")
    links = materialize(candidate_links(exact_postings(texts, width, percent, frequent), percent), "candidates")
    groups = connected_components(links)
    free(links)
    members = held.join(groups, held["key_b"] == groups["node"]).drop("node")
    members = materialize(members, "members")
    free(groups, held)
    blocks = (
        members.groupBy("component")
        .agg(F.sum("n").alias("grams"), F.count("*").alias("sets"))
        .where("sets > 1")
        .select("component", F.ceil(F.col("grams") / _CELL_GRAMS).cast("long").alias("blocks"))
    )
    blocks = materialize(blocks, "blocks")
    dealt = (
        members.join(blocks, "component")
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "component",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "rep",
            "key_a",
            "weight",
        )
    )
    dealt = materialize(dealt, "dealt")
    free(members, blocks)
    cells = texts.select("rep", "key_a", "text").join(dealt.hint("merge"), ["rep", "key_a"])
    joined = materialize(join_cells(cells, width, percent), "joined")
    free(dealt, texts)
    linked = connected_components(joined.select(F.col("rep").alias("a"), F.col("label").alias("b")))
    per_set = (
        nodes.join(joined.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
        .join(linked.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "key_a",
            "key_b",
            "n",
            F.coalesce("component", "rep").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    per_set = materialize(per_set, "components")
    free(joined, linked, nodes)
    filled = rows.where("n > 0").join(per_set, ["key_a", "key_b", "n"])
    empty = rows.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")
    )
    return filled.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links").unionByName(empty)


def matching(rows: DataFrame, width: int) -> DataFrame:
    """One row per set, with a text that has it; needed where an id is in the table more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            keys = texts.rows.column("key_a").to_pylist()
            found = [set_keys(g)[0] == key for g, key in zip(gram_sets(texts, width), keys, strict=True)]
            yield texts.rows.filter(pa.array(found, pa.bool_()))

    return rows.mapInArrow(run, rows.schema).dropDuplicates(["rep", "key_a"])


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Rows of `docs` that are first, by id, of their component; rows without id stay.

    A row goes by its id and text: an id that stands for several texts is a document for each of
    them, so only those with a partner go. Repeated rows share one decision, null text counts as empty,
    an empty table stays empty, all columns are kept.
    """
    ids = docs["doc_id"].cast("long").alias("doc_id")
    rows = docs.select(ids, text_mark(docs["text"]).alias("mark"), docs["text"]).where("doc_id is not null")
    texts = materialize(rows.select("doc_id", "mark").distinct(), "marks")
    if texts.groupBy("doc_id").count().where("count > 1").isEmpty():
        linked = ngram_links(rows.select("doc_id", "text"), width, percent).where("doc_id != component_id")
        gone = linked.select("doc_id").distinct().join(texts, "doc_id")
    else:
        # documents are numbered in the order of their ids, and each text of an id on its own
        placed = materialize(global_index(texts, ["doc_id", "mark"], "place"), "places")
        numbered = rows.join(placed, ["doc_id", "mark"]).select(F.col("place").alias("doc_id"), "text")
        linked = ngram_links(numbered, width, percent).where("doc_id != component_id")
        gone = placed.join(linked.select(F.col("doc_id").alias("place")).distinct(), "place").drop("place")
    return without(docs, materialize(gone, "near-copies"))
