import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from brindle.llm import exact


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    found = []
    for doc, text in rows:
        own = groups[text or ""]
        ids = [i for i in own if i is not None]
        keep = max(ids) if ids else None
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        found.append((doc, keep, len(own), doc == keep, sha))
    return sorted(found, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("fanout", [2, 16])
def test_groups(make_docs, odd_texts, fanout):
    rows = odd_texts + [(i, f"text {i % 7}") for i in range(20, 90)]
    assert rows_of(exact.exact_groups(make_docs(rows).repartition(9), fanout)) == brute(rows)


def test_smallest_may_stay(make_docs):
    rows = [(3, "a"), (1, "a"), (2, "b")]
    found = exact.exact_groups(make_docs(rows), keep="min")
    assert {(r.doc_id, r.keep_id) for r in found.collect()} == {(3, 1), (1, 1), (2, 2)}


def test_empty_table(make_docs):
    assert exact.exact_groups(make_docs([])).count() == 0


def test_copies_go(make_docs, odd_texts):
    docs = make_docs(odd_texts)
    kept = exact.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    wanted = sorted(
        ((d, t) for (d, t), r in zip(odd_texts, (b for b in odd_texts), strict=True) if d is None or stays(d, t, odd_texts)),
        key=str,
    )
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == wanted


def stays(doc, text, rows):
    return doc == max(d for d, t in rows if (t or "") == (text or "") and d is not None)


def test_other_text_of_an_id_stays(make_docs):
    rows = [(1, "a"), (2, "a"), (1, "b"), (3, None), (4, ""), (3, "c")]
    kept = exact.drop_exact_copies(make_docs(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "b"), (2, "a"), (3, "c"), (4, "")]


def test_combines_before_the_exchange(make_docs):
    """A text of very many rows is one row per run before runs are sent and merged."""
    docs = make_docs([(i, "same") for i in range(500)]).repartition(40)
    digests = exact.text_digests(docs)
    plan = exact.merge_runs(digests, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") == 1
    # 40 runs in two rounds of up to 8: each sends runs by number and range, and sorts them once
    assert plan.count("REPARTITION_BY_COL") == 2 and plan.count("Sort [run#") == 2
    merged = exact.merge_runs(digests, 8)
    assert merged.count() == 1 and merged.first()["group_size"] == 500


def test_ranges_of_digests(make_docs):
    """Runs cut into many ranges give the same groups."""
    rows = [(i, f"text {i % 91}") for i in range(1000)]
    digests = exact.text_digests(make_docs(rows).repartition(7))
    merged = exact.merge_runs(digests, 2, range_rows=10).select("keep_id", "group_size")
    assert sorted(tuple(r) for r in merged.collect()) == sorted((max(range(k, 1000, 91)), len(range(k, 1000, 91))) for k in range(91))


def test_height_comes_from_the_runs(make_docs, monkeypatch):
    """Without RDDs, for partitions as for a written column."""
    docs = make_docs([(i, f"text {i % 5}") for i in range(300)]).repartition(20)
    digests = exact.text_digests(docs)
    monkeypatch.setattr(type(digests), "rdd", property(lambda self: pytest.fail("an RDD is used")))
    for rows in (digests, digests.withColumn("run", F.pmod("doc_id", F.lit(30)))):
        merged = exact.merge_runs(rows, 2)
        assert sorted(tuple(r) for r in merged.select("keep_id", "group_size").collect()) == [(i, 60) for i in range(295, 300)]
