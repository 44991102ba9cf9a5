import itertools
import random
import re
import zlib

import numpy as np
import pytest

from brindle.llm import line_rules, quality
from brindle.llm.texts import slices
from llm_arrow import batch_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def remainder(doc, n):
    return zlib.crc32(str(doc).encode()) % n


def test_classifier_on_held_out_labels(tables):
    docs, labels = tables
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = quality.score_quality(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in found)
    assert all(r.predicted == (r.score >= 0.5) for r in found)
    held = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in held]) > 0.97


def test_held_out_labels_are_not_read(tables):
    docs, labels = tables
    wrong = labels.selectExpr(
        "doc_id", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1 then 1 - quality else quality end as quality"
    )
    scores = [{r.doc_id: r.score for r in quality.score_quality(docs, x).collect()} for x in (labels, wrong)]
    assert scores[0] == scores[1]


def test_classifier_on_odd_texts(spark, make_docs, odd_texts):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (4, 1), (5, 0), (5, 0)], "doc_id long, quality int")
    for rows in (labels, labels.where("false"), labels.where("quality = 1")):
        found = quality.score_quality(make_docs(odd_texts), rows).collect()
        assert len(found) == len(odd_texts)
        assert all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out for r in found if r.doc_id is None)
    assert quality.score_quality(make_docs([]), labels).count() == 0
    kept = quality.keep_good(make_docs(odd_texts), labels)
    assert kept.columns == make_docs([]).columns
    assert kept.where("doc_id is null").count() == 3


def test_measures_of_a_text():
    text = "One one one two.\nOne one one two.\n\nAB 12 |"
    (part,) = slices(iter([batch_of(["", text, ""])]))
    rows = quality.measure(part)
    m = dict(zip(quality.MEASURES, rows[1], strict=True))
    size, count = len(text), 11
    assert (rows[0] == 0).all() and (rows[2] == 0).all()
    assert m["log_bytes"] == pytest.approx(np.log1p(size)) and m["log_words"] == pytest.approx(np.log1p(count))
    assert m["upper_share"] == pytest.approx(4 / size) and m["digit_share"] == pytest.approx(2 / size)
    assert m["bar_share"] == pytest.approx(1 / size) and m["line_bytes"] == pytest.approx(size / 4)
    assert m["distinct_words"] == pytest.approx(5 / count) and m["next_equal"] == pytest.approx(4 / count)
    assert m["repeated_runs"] == pytest.approx(4 / 9) and m["dup_lines"] == pytest.approx(1 / 3)


def test_additive_model_learns_interactions():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (6000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 0.8)).astype(float)
    model = quality.fit_additive(x[:4000], y[:4000])
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x[4000:]) >= 0.5) == y[4000:]) > 0.9
    flat = quality.fit_additive(x[:4000], y[:4000], pairs=0)
    assert np.mean((flat.score(x[4000:]) >= 0.5) == y[4000:]) < 0.8


def rules(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(windows) < 3000 else None
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        None if covered is None else len(covered),
    )


def test_rules_of_texts(make_docs, odd_texts):
    rng = random.Random(3)
    rows = odd_texts + [
        (100 + i, "".join(rng.choices(["a ", "b", " é", "\n", "a b c ", "#", "| ", "\t", "日本 "], k=rng.randrange(0, 90))))
        for i in range(150)
    ]
    found = line_rules.rate_documents(make_docs(rows), line_rules.LineField()).collect()
    got = sorted(((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found), key=str)
    wanted = sorted(((str(d), *rules(t)) for d, t in rows), key=str)
    for a, b in zip(got, wanted, strict=True):
        assert a[:5] == b[:5] and b[5] in (None, a[5])
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
        assert (r.content_share is None) == (r.n_words == 0)


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(2)
    field = line_rules.LineField()
    field.weights, field.moves, field.start = rng.normal(size=field.weights.shape), rng.normal(size=(2, 2)), rng.normal(size=2)
    lengths = [0, 5, 1, 8, 0, 3]
    codes = rng.integers(0, len(field.weights), (sum(lengths), 4))
    begins = np.concatenate(([0], np.cumsum(lengths)))
    labels = field.viterbi(codes, begins)
    emit = field.emissions(codes)

    def score(path, at):
        total = field.start[path[0]] + sum(emit[at + i, y] for i, y in enumerate(path))
        return total + sum(field.moves[a, b] for a, b in itertools.pairwise(path))

    for a, b in itertools.pairwise(begins):
        if a < b:
            best = max(itertools.product((0, 1), repeat=b - a), key=lambda p: score(p, a))
            assert tuple(labels[a:b]) == best


def test_field_learns_labels_and_moves():
    rng = np.random.default_rng(4)
    sequences, truths = [], []
    for _ in range(200):
        y = [int(rng.random() < 0.5)]
        for _ in range(rng.integers(2, 12)):
            y.append(y[-1] if rng.random() < 0.9 else 1 - y[-1])
        codes = np.array([[int(rng.random() < (0.75 if label else 0.25))] for label in y])
        sequences.append(codes)
        truths.append(np.array(y))
    field = line_rules.LineField().fit(sequences, truths, [1.0] * 200)
    assert np.trace(field.moves) > field.moves[0, 1] + field.moves[1, 0]
    begins = np.concatenate(([0], np.cumsum([len(s) for s in sequences])))
    labels = field.viterbi(np.concatenate(sequences), begins)
    truth = np.concatenate(truths)
    alone = np.concatenate(sequences)[:, 0]
    assert np.mean(labels == truth) > np.mean(alone == truth) + 0.05


def test_lines_of_given_documents(tables):
    docs, labels = tables
    truth = {r.doc_id: r.quality for r in labels.collect()}
    field = line_rules.fit_lines(docs, labels)
    found = [r for r in line_rules.rate_documents(docs, field).collect() if not r.base_failed and r.doc_id in truth]
    good = [r.kept for r in found if truth[r.doc_id] == 1]
    bad = [r.kept for r in found if truth[r.doc_id] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_lines_of_nothing(spark, make_docs, odd_texts):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert line_rules.rate_documents(make_docs([]), line_rules.fit_lines(make_docs([]), labels)).count() == 0
    field = line_rules.fit_lines(make_docs(odd_texts), labels)
    assert line_rules.label_lines(make_docs(odd_texts), field).count() == len(odd_texts)
