import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from brindle.llm import ngram_join
from brindle.llm.components import connected_components
from llm_words import words


def shingles(text, width=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def linked(a, b, percent=80):
    both = len(a & b)
    return bool(a and b) and 100 * both >= percent * (len(a) + len(b) - both)


def brute(rows):
    """n_shingles, component, links per row number."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(doc, low.get(find(i), doc))
    return [
        (doc, len(sets[i]), low.get(find(i)) if sets[i] else doc, links[i]) for i, (doc, _) in enumerate(rows)
    ]


def key(row):
    return tuple((x is None, x) for x in row)


def check(rows, docs):
    found = [tuple(r) for r in ngram_join.ngram_links(docs).collect()]
    assert sorted(found, key=key) == sorted(brute(rows), key=key)


def near_copies(seed, groups=12, copies=9):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 30, 120, 300]))
        if rng.random() < 0.5:
            base[len(base) // 2 : len(base) // 2] = passage
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                at = rng.randrange(len(text))
                text[at : at + rng.randrange(0, 2)] = rng.choices(vocabulary, k=rng.randrange(1, 3))
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_links_of_near_copies(make_docs, seed):
    rows = near_copies(seed)
    check(rows, make_docs(rows))


def test_links_with_small_blocks(make_docs, monkeypatch):
    """Many blocks, cells and matrix parts give the same links."""
    rows = near_copies(3)
    monkeypatch.setattr(ngram_join, "_CELL_GRAMS", 500)
    check(rows, make_docs(rows))


def test_links_of_given_documents(sf_docs):
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    check(rows, sf_docs)


def test_odd_texts(make_docs, odd_texts):
    rows = [r for r in odd_texts if r[0] is not None] + [(None, "one two three")]
    check(rows, make_docs(rows))
    found = ngram_join.ngram_links(make_docs(odd_texts))
    assert found.count() == len(odd_texts)
    alone = found.where("doc_id is null and n_shingles = 2").first()
    assert (alone.component_id, alone.n_links) == (None, 0)


def test_empty_table(make_docs):
    assert ngram_join.ngram_links(make_docs([])).count() == 0


def test_one_of_each_group_stays(make_docs):
    rows = near_copies(4)
    docs = make_docs(rows)
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c, _ in brute(rows)}


def test_an_unrelated_text_of_the_same_id_stays(spark, make_docs, odd_texts):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words), (2, words + " end"), (2, "something else that nobody wrote twice here"), (2, words + " end"), (3, None)]
    docs = make_docs([*rows, (None, words)])
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([rows[0], rows[2], rows[4], (None, words)], key=str)
    odd = make_docs(odd_texts)
    assert sorted((r.doc_id, r.text) for r in ngram_join.keep_one_of_each(odd).where("doc_id is not null").collect() if r.text == "One  TWO\nthree") == []
    assert ngram_join.keep_one_of_each(odd).where("doc_id is null").count() == 3
    assert ngram_join.keep_one_of_each(make_docs([])).count() == 0


sets = st.lists(st.frozensets(st.integers(1, 25), min_size=1, max_size=14), min_size=1, max_size=14)


@settings(max_examples=150, deadline=None)
@given(sets, st.sampled_from([50, 80, 100]), st.integers(0, 14), st.integers(1, 200))
def test_trie_join_is_all_pairs(found, percent, cut, matrix):
    found = list(dict.fromkeys(found))
    k = len(found)
    weights = np.arange(1, k + 1)
    arrays = [np.array(sorted(s), np.uint64) for s in found]
    before, ngram_join._MATRIX = ngram_join._MATRIX, matrix
    try:
        for split in (None, min(cut, k)):
            labels, links = ngram_join.trie_join(arrays, weights, percent, split)
            graph, wanted = defaultdict(set), [0] * k
            for i in range(k):
                for j in range(k):
                    crossing = split is None or (i < split) != (j < split)
                    if i != j and crossing and linked(found[i], found[j], percent):
                        wanted[i] += weights[j]
                        graph[i].add(j)
            assert links.tolist() == wanted
            for i in range(k):
                reach, todo = {i}, [i]
                while todo:
                    for j in graph[todo.pop()] - reach:
                        reach.add(j)
                        todo.append(j)
                assert {j for j in range(k) if labels[j] == labels[i]} == reach
    finally:
        ngram_join._MATRIX = before


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 200), (-5, -9)]
    found = {tuple(r) for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(41)} | {(x, 90) for x in (90, 95, 100)} | {(-5, -9), (-9, -9)}
