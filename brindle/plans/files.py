"""Queries that go through files: written to the shared folder, read back, compared with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.plans.inputs import BOXES_SQL, LOGS_SQL, boxes, log_lines, table, with_sql
from brindle.session import scratch_folder
from brindle.sources.annotations import read_annotations, split_rejects
from brindle.sources.logs import log_status, parse_log
from brindle.sources.sinks import write_class_names, write_lines, write_table
from brindle.sources.text import list_files, read_class_names, read_lines

LABEL_SQL = "label || ' \"' || image || '\"' || chr(10) || 'part, ' || label"


def _file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as lines in folders by nation and segment, with tables of another kind beside
    them; the listing of the line files by folder."""
    folder = scratch_folder(spark, "customers")
    customers = table(spark, sf_dir, "customer").select(
        F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name").alias("line"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    # one file to a folder, so that the listing does not depend on partitions
    write_lines(customers.repartition("nation", "segment"), f"{folder}/lines", by=["nation", "segment"])
    write_table(customers, f"{folder}/lines/other", kind="csv")
    found = list_files(spark, folder, (".txt",))
    part = F.regexp_extract(F.url_decode("path"), "nation=([0-9]+)/segment=([^/]+)/", 1).cast("int")
    segment = F.regexp_extract(F.url_decode("path"), "nation=([0-9]+)/segment=([^/]+)/", 2)
    return found.groupBy(part.alias("nation"), segment.alias("segment")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes")
    )


def _gzip_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The access log through gzip files, which cannot be split, spread behind their scan."""
    folder = scratch_folder(spark, "logs")
    write_lines(log_lines(spark, sf_dir), folder, "value", codec="gzip")
    cores = spark.sparkContext.defaultParallelism
    return log_status(parse_log(read_lines(spark, folder, min_partitions=cores)))


def _class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts as a class file: the line number is the code."""
    folder = scratch_folder(spark, "classes")
    parts = table(spark, sf_dir, "part").select(
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("label"), F.col("p_partkey").alias("code")
    )
    write_class_names(parts, folder)
    return read_class_names(spark, folder)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes whose labels hold quotes, commas and line breaks."""
    quote, label = F.lit('"'), F.col("label")
    text = F.concat(label, F.lit(" "), quote, F.col("image"), quote, F.lit("\n"), F.lit("part, "), label)
    return boxes(spark, sf_dir).select("image", "xmin", "ymin", "xmax", "ymax", text.alias("label"))


def _csv_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "boxes")
    write_table(_labelled(spark, sf_dir), folder, kind="csv")
    return read_annotations(spark, folder, multiline=True)


def _csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes as text, those of label R once more with a word for their first number."""
    folder = scratch_folder(spark, "boxes")
    words = F.when(F.col("label") == "R", F.array(F.col("xmin").cast("string"), F.lit("left")))
    left = F.explode(words.otherwise(F.array(F.col("xmin").cast("string")))).alias("xmin")
    rows = boxes(spark, sf_dir).select("image", left, *[F.col(c).cast("string") for c in ("ymin", "xmax", "ymax")], "label")
    write_table(rows, folder, kind="csv")
    return split_rejects(read_annotations(spark, folder, rejects=True))[1]


QUERIES = {
    "src_file_list": (
        _file_list,
        "select c_nationkey as nation, c_mktsegment as segment, cast(1 as bigint) as n_files, "
        "cast(sum(length(c_custkey::varchar || '|' || c_name) + 1) as bigint) as n_bytes from customer group by 1, 2",
    ),
    "src_gzip_logs": (
        _gzip_status,
        with_sql(LOGS_SQL, query=(
            "select count(*) + count(*) filter (where spoilt) as n_lines, count(*) as n_access, "
            "count(*) filter (where spoilt) as n_failed from all_logs"
        )),
    ),
    "src_class_names": (
        _class_names,
        "select cast(row_number() over (order by p_partkey) - 1 as int) as code, p_name || ' ' || p_partkey as label from part",
    ),
    "src_csv_boxes": (
        _csv_boxes,
        with_sql(BOXES_SQL, query=f"select image, xmin, ymin, xmax, ymax, {LABEL_SQL} as label from boxes"),
    ),
    "src_csv_rejects": (
        _csv_rejects,
        with_sql(BOXES_SQL, query=(
            "select count(*) + count(*) filter (where label = 'R') as n_read, count(*) as n_ok, "
            "count(*) filter (where label = 'R') as n_bad from boxes"
        )),
    ),
}
