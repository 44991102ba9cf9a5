"""The registered queries and the pipeline on the smallest tables."""

import re
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from brindle.llm import licenses, ngram_join, quality
from brindle.llm.queries import OP2_SQL, QUERIES
from llm_words import words

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    query, sql = QUERIES[name]
    df = query(spark, SF_DIR)
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(result.fetchall())


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if not sql))
def test_query_has_a_row_per_document(spark, name):
    df = QUERIES[name][0](spark, SF_DIR)
    ids = {r.doc_id for r in df.select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}


def test_registered():
    known = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in known}
    assert "pipeline" in known


LICENSE = """Copyright (c) 2019 Some Body <a@b.org>
(C) 2020, Others

Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the 'Software'), to deal in the
Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sub-license, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies
or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE."""


def test_licenses(make_docs, odd_texts):
    rows = [
        (50, LICENSE),
        (51, LICENSE.replace("\n", "\r\n").upper()),
        (52, LICENSE + " And more."),
        (53, "text\n* Licensed under CC BY-NC 4.0!!\nRELEASED under the MIT Licence.\nmore"),
        (54, "Licensed under the Apache License, Version 2.0."),
        (55, "a sentence on a license, released under the MIT License."),
    ]
    found = licenses.scan_licenses(make_docs(rows + odd_texts)).collect()
    by_id = {r.doc_id: (r.license_id, r.line_licenses) for r in found}
    assert [by_id[i] for i in range(50, 56)] == [
        ("MIT", ""),
        ("MIT", ""),
        (None, ""),
        (None, "CC-BY-NC-4.0,MIT"),
        ("Apache-2.0", "Apache-2.0"),
        (None, ""),
    ]
    assert len(found) == len(rows) + len(odd_texts)
    assert all(by_id[d] == (None, "") for d, _ in odd_texts)
    assert licenses.scan_licenses(make_docs([])).count() == 0


def test_every_known_licence_is_found_as_a_line(make_docs):
    rows = [(i, f"A page of text.\n * {known}\nmore of it") for i, (_, known) in enumerate(licenses.KNOWN)]
    found = {r.doc_id: (r.license_id, r.line_licenses) for r in licenses.scan_licenses(make_docs(rows)).collect()}
    assert found == {i: (None, name) for i, (name, _) in enumerate(licenses.KNOWN)}


def test_line_below_reserved_rights_is_kept(make_docs):
    head = "Copyright (c) 2020, x\nAll rights reserved.\n"
    bsd = next(known for name, known in licenses.KNOWN if name == "BSD-2-Clause")
    rows = [
        (1, head + bsd),
        (2, head + bsd.replace(". ", ".\n")),
        (3, head + "Licensed under CC BY 4.0.\nmore"),
        (4, head + "one line"),
        (5, head + "another line"),
        (6, "Some text\nAll rights reserved."),
        (7, "Some text"),
    ]
    found = {r.doc_id: r for r in licenses.scan_licenses(make_docs(rows)).collect()}
    assert [found[i].license_id for i in (1, 2)] == ["BSD-2-Clause"] * 2
    assert found[3].line_licenses == "CC-BY-4.0"
    assert found[4].text_digest != found[5].text_digest
    assert found[6].text_digest == found[7].text_digest


@pytest.fixture(scope="module")
def licence_rows(odd_texts):
    """Notices and licences in all places, whole and as lines, and texts without any."""
    head, known = "Copyright (c) 2020, x\nAll rights reserved.\n", dict(reversed(licenses.KNOWN))
    rows = [
        head + "Licensed under CC BY 4.0.\nmore",
        head + known["BSD-2-Clause"],
        head + "x\n" + known["ISC"] + "\ny",
        "(c) 2021 somebody\n All Rights Reserved \n ALL RIGHTS RESERVED.\n© me\n" + known["Zlib"] + "\nand on",
        head + known["BSD-2-Clause"].replace(". ", ".\n"),
        "all rights reserved, but not here\nnext",
        "# copyright: x\r\n#\r\n" + known["MIT"].replace(" ", "\r\n", 9),
        *[text for _, text in licenses.KNOWN],
        *[f"A page.\n * {text.upper()}\nmore" for _, text in licenses.KNOWN],
    ]
    return [*enumerate(rows, 100), *odd_texts]


def test_licence_sql_has_the_present_rules(make_docs, licence_rows):
    licence_rows = [r for r in licence_rows if "İ" not in (r[1] or "")]  # which the two engines lower differently
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", licence_rows)
    wanted = sorted(con.execute(OP2_SQL).fetchall(), key=str)
    found = sorted((tuple(r) for r in licenses.scan_licenses(make_docs(licence_rows)).collect()), key=str)
    assert found == wanted
    assert sum(r[2] is not None for r in found) >= len(licenses.KNOWN) + 3
    lines = {r[0]: r[3] for r in found}
    assert [lines[i] for i in (100, 102, 103)] == ["CC-BY-4.0", "ISC", "Zlib"]


def test_licences_of_a_given_table(spark, make_docs, licence_rows):
    """A table of digests of any size gives the same rows as the list in the program, and more."""
    known = spark.createDataFrame(licenses.KNOWN, "license_id string, known string")
    docs = make_docs(licence_rows)
    assert sorted((tuple(r) for r in licenses.scan_licenses(docs, licenses.digest_table(known)).collect()), key=str) == sorted(
        (tuple(r) for r in licenses.scan_licenses(docs).collect()), key=str
    )
    own = spark.range(5000).selectExpr("concat('L', id) as license_id", "concat('Own terms, number ', id, '!') as known")
    own = own.unionByName(spark.createDataFrame([(None, "x"), ("Y", None)], "license_id string, known string"))
    rows = [(1, "own TERMS\nnumber 17"), (2, "a\nOwn terms (number 3)\nown terms, number 4999.\nOwn terms number 3"), (2, "own terms number 6000"), (None, "Own terms, number 8")]
    found = {(r.doc_id, r.license_id, r.line_licenses) for r in licenses.scan_licenses(make_docs(rows), licenses.digest_table(own)).collect()}
    assert found == {(1, "L17", ""), (2, None, "L3,L4999"), (2, None, ""), (None, "L8", "L8")}
    assert licenses.scan_licenses(make_docs([]), licenses.digest_table(own)).count() == 0


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near(a, b):
    both = len(a & b)
    return bool(a) and 100 * both >= 80 * (len(a) + len(b) - both)


def test_pipeline(spark):
    """Every stage against plain Python on what the stage before has kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.collect()
    for (_, stage), check in zip(corpus_pipeline.STAGES, (after_quality, after_exact, after_near, after_pii), strict=False):
        docs = ngram_join.materialize(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        found = sorted(docs.collect())
        check(spark, rows, found)
        rows = found
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    whole = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert whole == sorted(map(tuple, last.collect()))
    assert {r[0] for r in whole} == {r.doc_id for r in rows}


def after_quality(spark, before, found):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs = spark.createDataFrame(before)
    scores = {r.doc_id: r.predicted for r in quality.score_quality(docs, labels).collect()}
    assert found == sorted(r for r in before if scores[r.doc_id] == 1)
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    kept = {r.doc_id for r in found}
    assert len(kept & good) >= 0.97 * len(good) and len(kept & bad) <= 0.2 * len(bad) + 1


def after_exact(spark, before, found):
    last = defaultdict(int)
    for r in before:
        last[r.text] = max(last[r.text], r.doc_id)
    assert found == sorted(r for r in before if last[r.text] == r.doc_id)


def after_near(spark, before, found):
    sets = [shingles(r.text) for r in before]
    first = list(range(len(before)))

    def root(i):
        while first[i] != i:
            i = first[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if near(sets[i], sets[j]):
                a, b = sorted((root(i), root(j)), key=lambda k: before[k].doc_id)
                first[b] = a
    assert found == sorted(r for i, r in enumerate(before) if root(i) == i)


def after_pii(spark, before, found):
    assert [(r.doc_id, r.lang, r.source) for r in found] == [(r.doc_id, r.lang, r.source) for r in before]
    for old, new in zip(before, found, strict=True):
        assert new.n_chars == len(new.text)
        if not re.search("[0-9@]", old.text):
            assert new == old
        for mail in re.findall(r"[\w.]+@[\w.]+\.com", old.text):
            assert mail not in new.text
