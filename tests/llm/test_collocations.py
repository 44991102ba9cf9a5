import collections
import re
import tracemalloc

import numpy as np
import pytest

from brindle.llm import collocations
from brindle.llm.collocations import Filter, Keys

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, least=10, top=2000, cover=50):
    """Rows of the operator from (lang, text) pairs, by counting every phrase in a dictionary."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    longer = collections.Counter()
    for (lang, *w), a in candidates.items():
        if len(w) == 3:
            for part in ((lang, *w[:2]), (lang, *w[1:])):
                longer[part] = max(longer[part], a)
    found = collections.defaultdict(list)
    for (lang, *w), a in candidates.items():
        if len(w) == 2 and longer[(lang, *w)] and 100 * longer[(lang, *w)] >= cover * a:
            continue
        cuts = [(f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w))]
        score, _, (left, right) = min((1_000_000 * a * a // (x * y), k, (x, y)) for k, (x, y) in enumerate(cuts))
        found[lang].append((-score, -a, " ".join(w).encode(), left, right))
    rows = []
    for lang, best in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def mined(docs, **kw):
    return sorted(tuple(r) for r in collocations.mine_phrases(docs, **kw).collect())


@pytest.mark.parametrize("bits", [1, 5, 21, 22, 32])
def test_scatter_is_a_permutation_and_filters_give_all_back(bits):
    rng = np.random.default_rng(bits)
    keys = Keys(bits)
    left = rng.integers(0, 1 << bits, 5000).astype(np.uint64)
    right = rng.integers(0, 1 << (2 * bits) if bits < 32 else 1 << 63, 5000).astype(np.uint64)
    scattered = keys.scatter(left, right)
    assert (keys.gather(left, scattered) == right).all()
    if bits == 5:
        every = np.arange(1 << 10, dtype=np.uint64)
        assert len(np.unique(keys.scatter(np.full(1 << 10, 3, np.uint64), every))) == 1 << 10
    counts = rng.integers(1, 1000, 5000)
    whole = collocations.summed(keys, scattered, left, counts)
    truth = collections.Counter()
    for a, b, c in zip(left.tolist(), right.tolist(), counts.tolist()):
        truth[a, b] += c
    for old, new in ((0, 0), (0, 1), (0, min(6, keys.width))):
        batch = collocations._segments(keys, whole, 9, 0, old, new)
        parts = [collocations.unpacked(keys, r, new) for r in batch.to_pylist()]
        again = Filter(*(np.concatenate(c) for c in zip(*parts)))
        assert all((x == y).all() for x, y in zip(again, whole))
        found = dict(zip(zip(again.left.tolist(), keys.gather(again.left, again.scattered).tolist()), again.counts.tolist()))
        assert found == truth


def test_given_texts_in_small_blocks_and_many_rounds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wanted = brute_force([(r.lang, r.text) for r in docs.collect()], least=4, top=50)
    assert len(wanted) > 100
    assert mined(docs, least=4, top=50) == wanted
    assert mined(docs, least=4, top=50, block_bytes=5000, part_entries=20) == wanted


def test_ties_covers_and_odd_rows(spark, make_docs, odd_texts):
    rows = [*odd_texts, *[(k, "New York City. new york, los angeles\tlos angeles") for k in range(6)], (99, "a b a b a b a b")]
    docs = make_docs(rows).selectExpr("*", "case when doc_id > 5 then 'xx' when doc_id = 4 then '' end as lang", "1 as word", "2 as id")
    pairs = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    for least, top in ((2, 2000), (3, 4), (10, 2000)):
        assert mined(docs, least=least, top=top) == brute_force(pairs, least, top)
    assert mined(docs.where("false")) == []
    assert mined(docs.where("text is null")) == []


def test_a_long_text_is_cut_where_pieces_end(spark):
    text = ", ".join(["one two three four five"] * 500) + " " + "far away " * 300
    docs = spark.createDataFrame([(1, text, None)], "doc_id long, text string, lang string")
    assert mined(docs, block_bytes=500) == brute_force([(None, text)])


def test_phrases_of_a_block_need_little_beside_their_keys():
    """A worker stands beside the heap of its executor, so a block of 16 MB may not take hundreds."""
    tokens = np.random.default_rng(3).integers(0, 1 << 17, 1 << 20).astype(np.uint32)
    keys = Keys(17)
    tracemalloc.start()
    found = collocations.phrases(keys, tokens)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * len(tokens)
    small = collocations.phrases(keys, tokens[:5000])
    listed = tokens[:5000].tolist()
    wanted = collections.Counter((0, a, b) for a, b in zip(listed, listed[1:]) if a and b)
    wanted += collections.Counter((a, b, c) for a, b, c in zip(listed, listed[1:], listed[2:]) if a and b and c)
    right = keys.gather(small.left, small.scattered)
    triples = zip(small.left.tolist(), (right >> np.uint64(17)).tolist(), (right & np.uint64((1 << 17) - 1)).tolist())
    assert dict(zip(triples, small.counts.tolist())) == dict(wanted)
    assert int(found.counts.sum()) > len(tokens)
