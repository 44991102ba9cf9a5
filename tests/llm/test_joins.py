import pytest
from pyspark.sql import functions as F

from brindle.llm import joins
from brindle.session import materialize


def gone_of(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    return materialize(table.select("doc_id", joins.text_mark(F.col("text")).alias("mark")), "gone")


@pytest.mark.parametrize("bits", [26, 7])
def test_rows_go_by_id_and_text(spark, monkeypatch, bits):
    """Whatever the map rules out or not; clashing names stay."""
    monkeypatch.setattr(joins, "MAP_BITS", bits)
    rows = [(i % 700 if i % 11 else None, f"text {i % 90}" if i % 13 else None) for i in range(2000)]
    clash = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as mark", "2 as `row`", "3 as maybe", "4 as word")
    gone = [(i, f"text {i % 90}") for i in range(0, 700, 3)] + [(i, "") for i in range(0, 700, 5)] + [(9999, "x")]
    left = joins.without(clash, gone_of(spark, gone))
    assert left.columns == clash.columns
    wanted = [r for r in rows if r[0] is None or (r[0], r[1] or "") not in set(gone)]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(wanted, key=str)


def test_nothing_goes_or_there_is_nothing(spark, make_docs, odd_texts):
    none = gone_of(spark, [(77, "x")]).where("false")
    docs = make_docs(odd_texts)
    assert joins.without(docs, none).count() == len(odd_texts)
    assert joins.without(make_docs([]), gone_of(spark, [(1, "a")])).count() == 0


def test_a_map_of_large_keys_is_bounded(spark):
    many = spark.range(3_000_000).select(F.col("id").alias("doc_id"))
    words = joins.key_map(many, "doc_id")
    assert words.count() <= 1 << (joins.MAP_BITS - 6)
    assert joins.maybe_in(spark.range(0, 3_000_000, 1000).select(F.col("id").alias("doc_id")), many, "doc_id").where("not maybe").count() == 0
