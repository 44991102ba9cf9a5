import re
import zlib

import numpy as np
import pytest

from brindle.llm import toxicity
from brindle.llm.texts import slices
from llm_arrow import batch_of

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    return docs, labels, truth, toxicity.score_toxicity(docs, labels).collect()


def test_held_out_labels(scored):
    docs, _, truth, found = scored
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    assert all(r.predicted == (r.score >= 0.7) for r in found)
    held = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([a for a, b in held if b == 1]) > 0.8
    assert np.mean([a for a, b in held if b == 0]) < 0.005


def test_held_out_labels_are_not_read(scored):
    docs, labels, _, found = scored
    wrong = labels.selectExpr(
        "doc_id", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1 then 1 - toxic else toxic end as toxic"
    )
    again = toxicity.score_toxicity(docs, wrong).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in found}


def test_a_few_labels_are_enough_for_the_bound(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = toxicity.known_labels(labels)
    rows = toxicity.measured(docs, np.zeros(0, np.uint64))
    model = toxicity.train(rows, known, train_rows=500)
    assert model.trees is not None
    assert toxicity.score_toxicity(docs, labels, train_rows=500).count() == docs.count()


def test_learnt_words(spark, make_docs):
    """Words of toxic texts only are learnt, but not those of a group of copies or of both classes."""
    rng = np.random.default_rng(3)
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows, marks = [], []
    for k, i in enumerate(ids):
        toxic = int(k % 10 == 0)
        body = " ".join(f"w{x}" for x in rng.integers(0, 300, 30))
        copies = "same copied text with rareword in it and more words" if k % 50 == 0 else body
        rows.append((i, f"{copies} Zorgle!" if toxic and k % 50 else copies))
        marks.append((i, toxic))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(make_docs(rows), toxicity.known_labels(labels))
    assert lexicon.tolist() == toxicity._known(["zorgle"]).tolist()


def test_odd_texts(spark, make_docs, odd_texts):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (4, 1), (5, 0), (5, 0)], "doc_id long, toxic int")
    for rows in (labels, labels.where("false"), labels.where("toxic = 1")):
        found = toxicity.score_toxicity(make_docs(odd_texts), rows).collect()
        assert len(found) == len(odd_texts)
        assert all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out for r in found if r.doc_id is None)
    assert toxicity.score_toxicity(make_docs([]), labels).count() == 0


def plain_measures(text):
    """The measures that plain Python can give: counts of words found one by one."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    low = [re.sub(r"^[^\w]+|[^\w]+$", "", w.replace("_", " ").strip(), flags=re.UNICODE).lower() for w in words]
    insult = [w in toxicity.INSULTS for w in low]
    person = [i for i, w in enumerate(low) if w in toxicity.SECOND_PERSON]
    near = [i for i, hit in enumerate(insult) if hit and any(abs(i - j) <= toxicity.NEAR_WORDS for j in person)]
    return len(words), sum(insult), len({w for w, hit in zip(low, insult) if hit}), len(near), len(person)


def test_measures_of_texts():
    texts = [
        "",
        "You are an idiot, you IDIOT! Such a moron.",
        "This fool said nothing about anybody else who might be reading this, did you?",
        "a perfectly (clean) text; with words.",
        "scum",
        "you",
    ]
    (part,) = slices(iter([batch_of(texts)]))
    found = toxicity.measure(part, np.zeros(0, np.uint64))
    at = {m: i for i, m in enumerate(toxicity.MEASURES)}
    for row, text in zip(found, texts):
        words, insults, kinds, near, person = plain_measures(text)
        assert np.expm1(row[at["log_words"]]) == pytest.approx(words)
        assert np.expm1(row[at["log_insults"]]) == pytest.approx(insults)
        assert np.expm1(row[at["log_kinds"]]) == pytest.approx(kinds)
        assert row[at["near_density"]] == pytest.approx(near / max(words, 1))
        assert row[at["person_density"]] == pytest.approx(person / max(words, 1))


def test_hidden_spellings():
    texts = ["what an 1d1ot", "stuuuupid thing", "l.o.s.e.r", "m*o*r*o*n", "$cum here", "i d i o t", "10 apples", "mo ron"]
    (part,) = slices(iter([batch_of(texts)]))
    found = toxicity.measure(part, np.zeros(0, np.uint64))
    at = {m: i for i, m in enumerate(toxicity.MEASURES)}
    assert [round(np.expm1(r[at["log_hidden"]])) for r in found] == [1, 1, 1, 1, 1, 0, 0, 0]
    assert [r[at["spaced_density"]] > 0 for r in found] == [k == 5 for k in range(8)]
    assert found[1][at["stretched_density"]] > 0 and found[3][at["masked_density"]] > 0
