import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from brindle.llm import ppm
from llm_words import words


def training(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 != 0


def stream(text):
    return list(b" ".join(w.encode() for w in words(text))) + [0x0A]


def state(total, distinct):
    bits = total.bit_length()
    return (total if total < 16 else 4 * bits + (total >> (bits - 3)), min(distinct, 31))


def escape_rates(contexts):
    """By leaving out every byte once."""
    new, old = Counter(), Counter()
    for counts in contexts.values():
        total = sum(counts.values())
        for n in counts.values() if total > 1 else ():
            if n == 1:
                new[state(total - 1, len(counts) - 1)] += 1
            else:
                old[state(total - 1, len(counts))] += n
    return {s: (new[s] + 0.5) / (new[s] + old[s] + 1) for s in new | old if new[s] + old[s] > 20}


def probability(tries, rates, history, symbol, order):
    """Of one byte, by escapes with exclusion."""
    result, excluded = 1.0, set()
    for k in range(order, -1, -1):
        counts = tries[k].get(tuple(history[len(history) - k :]), {})
        left = {s: n for s, n in counts.items() if s not in excluded}
        if not left:
            continue
        total = sum(left.values())
        rate = rates[k].get(state(total, len(left)), len(left) / (2 * total))
        rate = min(max(rate, 1e-6), 1 - 1e-6)
        if symbol in left:
            return result * (1 - rate) * left[symbol] / total
        result *= rate
        excluded |= set(left)
    return result / (252 - len(excluded))


def brute(rows, order):
    tries = [defaultdict(Counter) for _ in range(order + 1)]
    counts = Counter()
    for doc, text in rows:
        if training(doc):
            counts.update([*words(text), None])
            history = [0x0D] * order
            for s in stream(text):
                for k in range(order + 1):
                    tries[k][tuple(history[len(history) - k :])][s] += 1
                history.append(s)
    n, v = sum(counts.values()), len(counts)
    rates = [escape_rates(t) for t in tries]
    found = []
    for doc, text in rows:
        tokens = [*words(text), None]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        history, score = [0x0D] * order, 0.0
        for s in stream(text):
            score += math.log10(probability(tries, rates, history, s, order))
            history.append(s)
        found.append((doc, not training(doc), len(tokens), sum(counts[t] > 0 for t in tokens), n, base, score))
    return found


def check(rows, docs, order=5, block=64 << 20):
    found = sorted((tuple(r) for r in ppm.score_texts(docs, order, block).collect()), key=str)
    wanted = sorted(brute(rows, order), key=str)
    key = [r[:5] for r in found]
    assert sorted(key, key=str) == sorted((r[:5] for r in wanted), key=str)
    scores = sorted(((str(r[:5]), *np.round(r[5:], 6)) for r in found))
    for a, b in zip(scores, sorted((str(r[:5]), *np.round(r[5:], 6)) for r in wanted), strict=True):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], rel=1e-6, abs=1e-5)


@pytest.mark.parametrize(("order", "block"), [(5, 64 << 20), (2, 2000), (0, 2000)])
def test_scores(make_docs, order, block):
    rng = random.Random(order)
    parts = ["the", "ing", "Über", "ano", "ther", "x", "q,", "z."]
    rows = [
        (i, " ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.randrange(0, 30))))
        for i in range(120)
    ]
    check(rows, make_docs(rows), order, block)


def test_codes_and_prices_meet_in_separate_partitions(spark, make_docs, monkeypatch):
    rows = [(i, f"some words {i % 7} that go on and {i}") for i in range(60)]
    monkeypatch.setattr(ppm, "_SET_ENTRIES", 50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(rows, make_docs(rows), 2, 300)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_odd_texts(make_docs, odd_texts):
    rows = [(d, t if not t or len(t) < 1000 else t[:4000]) for d, t in odd_texts]
    check(rows, make_docs(rows))


def test_windows_of_long_streams(make_docs, monkeypatch):
    rows = [(i, "some words that go on " * 40 + str(i)) for i in range(12)]
    monkeypatch.setattr(ppm, "_WINDOW", 64)
    check(rows, make_docs(rows))


def test_nothing_to_learn(make_docs):
    held = [i for i in range(200) if not training(i)][:3]
    found = ppm.score_texts(make_docs([(i, "ab c") for i in held])).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in found)
    assert all(r.score == pytest.approx(-5 * math.log10(252)) for r in found)
    assert ppm.score_texts(make_docs([])).count() == 0


def test_better_than_words_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    base, score = ppm.score_texts(docs).where("held_out").selectExpr("sum(base_score)", "sum(score)").first()
    assert score > base


def test_lookup():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    asked = rng.permutation(np.repeat(keys, 3))
    assert (keys[ppm.Lookup(keys).places(asked)] == asked).all()
