"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from brindle.operators import detection, linkage, logs as reports, moments, pca
from brindle.plans.inputs import series
from brindle.sources import annotations, logs, records, sinks

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_does_not_sort_everything(spark):
    found = plan(queries()["log_top_endpoints"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in found
    assert "rangepartitioning" not in found


def test_log_fields_come_from_one_evaluation(spark):
    df = spark.createDataFrame([("x",)], "value string")
    found = plan(reports.top(reports.not_found(logs.access_logs(logs.parse_log(df))), "endpoint", 5))
    assert found.count("regexp_replace(") == 1


@pytest.mark.parametrize("parse", [annotations.parse_assets, lambda d: annotations.parse_coco(d, "f/")])
def test_documents_are_parsed_once(spark, parse):
    df = spark.createDataFrame([("{}",)], "value string")
    assert plan(parse(df)).count("from_json(") == 1


def test_rows_per_group_are_limited_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("image"), "id")
    assert plan(detection.first_boxes(df, ["id"], 3)).count("WindowGroupLimit") == 2
    # as in the rounds of suppression, which order by a struct
    boxes = df.withColumn("box", F.struct("id"))
    assert plan(detection.first_boxes(boxes, ["box"], 4)).count("WindowGroupLimit") == 2


def test_counts_of_a_text_are_not_shuffled(spark):
    df = spark.createDataFrame([(1, ["a"])], "id int, tokens array<string>")
    assert "Exchange" not in plan(linkage.term_frequency(df))


def test_only_needed_columns_are_read(spark):
    found = plan(queries()["lr_label_counts"](spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<l_shipdate:timestamp_ntz>", found)


def test_written_logs_prune_and_push(spark, tmp_path):
    lines = [
        f'h{i} - - [{i % 3 + 1:02d}/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" {code} 5'
        for i, code in enumerate([200, 404, 404, 200, 404, 500])
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    sinks.write_logs(logs.access_logs(logs.parse_log(df)), str(tmp_path / "logs"))
    back = spark.read.parquet(str(tmp_path / "logs")).where("date = date'1995-08-02'")
    errors = reports.count_by(reports.not_found(back), "host")
    assert "PartitionFilters: [isnotnull(date" in plan(errors)
    assert "EqualTo(response_code,404)" in plan(errors)
    assert sorted(map(tuple, errors.collect())) == [("h1", 1), ("h4", 1)]


def test_no_query_joins_without_keys(spark):
    for name in ("box_anchor_assign", "box_iou", "cf_rmse", "cf_unrated", "lr_baseline_rmse", "er_cosine"):
        found = plan(queries()[name](spark, SF_DIR))
        assert "CartesianProduct" not in found and "NestedLoopJoin" not in found, name


def test_load_counts_need_no_scan_of_their_own(spark):
    lines = spark.read.text(f"{SF_DIR}/region.parquet")
    rows, _ = records.observed(records.parse_records(lines), "plan")
    found = plan(records.valid(rows))
    assert found.count("CollectMetrics") == 1 and found.count("FileScan") == 1


def test_folded_vectors_are_computed_once(spark):
    """The batches that sum the moments get the vectors from one projection, without a filter on them."""
    data = pca.folded(pca.rescaled(series(spark, SF_DIR)).where("ts is not null"), 8, "time")
    taken = data.select(F.lit(0).alias("part"), F.col("ts").cast("array<double>").alias("v")).mapInArrow(
        moments._batch_moments(15, 0.0), moments._SCHEMA
    )
    once = plan(data).count("transform(")
    assert plan(taken).count("transform(") == once
