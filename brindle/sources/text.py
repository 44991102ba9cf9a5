"""Readers of plain text, small dictionaries and file listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import Row, StructType

from brindle.session import materialize


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line, column `value`.

    `min_partitions` spreads files that cannot be split, such as gzip; splittable files are cut by
    `spark.sql.files.maxPartitionBytes`.
    """
    lines = spark.read.text(path)
    if min_partitions and lines.rdd.getNumPartitions() < min_partitions:
        lines = lines.repartition(min_partitions)
    return lines


def literal_table(spark: SparkSession, rows: Sequence[tuple | Row], schema: StructType | str) -> DataFrame:
    """A table from values given in the program."""
    return spark.createDataFrame(list(rows), schema)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words of a word list, one per line, column `word`."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''").distinct()


def word_set(words: DataFrame, max_words: int = 100_000) -> list[str]:
    """A word list as literals for `tokenize`; refuses one that is not small."""
    found = [r[0] for r in words.limit(max_words + 1).collect()]
    if len(found) > max_words:
        raise ValueError(f"more than {max_words} words; filter by an anti join instead")
    return sorted(found)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """`path, line, value`: the lines of every file with their 0-based numbers, however files are split.

    Lines of a split stay in order, so their numbers there are differences of running ids; what the
    splits before it hold is added from one count per split. No line is sorted or moved.
    """
    read = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    lines = materialize(read, "lines")  # ids differ from read to read
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("path", "start").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    offsets = splits.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return lines.join(materialize(offsets, "splits"), ["path", "start"]).select(
        "path", (F.col("place") - F.col("first") + F.col("before")).alias("line"), "value"
    )


def read_class_names(spark: SparkSession, path: str) -> DataFrame:
    """`code, label` of a class-name file: the code is the line number; empty lines at its end are none."""
    lines = numbered_lines(spark, path).select(F.col("line").cast("int").alias("code"), F.trim("value").alias("label"))
    last = lines.where("label <> ''").agg(F.max("code")).scalar()
    return lines.where(F.col("code") <= last)


def anchor_list(text: Column) -> Column:
    """`w,h,  w,h,...` as an array of structs `anchor_id, w, h`."""
    numbers = F.transform(F.split(text, ","), lambda v: F.trim(v).cast("double"))
    return F.transform(
        F.sequence(F.lit(0), (F.size(numbers) / 2).cast("int") - 1),
        lambda i: F.struct(
            i.alias("anchor_id"),
            F.get(numbers, i * 2).alias("w"),
            F.get(numbers, i * 2 + 1).alias("h"),
        ),
    )


def read_anchors(spark: SparkSession, path: str) -> DataFrame:
    """`anchor_id, w, h` of an anchor file, which is one line."""
    line = spark.read.text(path, wholetext=True)
    first = F.element_at(F.split("value", r"\r?\n"), 1)
    return line.select(F.inline(anchor_list(first)))


def list_files(
    spark: SparkSession, folder: str, endings: Sequence[str] = (".jpg", ".jpeg", ".png")
) -> DataFrame:
    """`path, length, modificationTime` of all files below a folder with one of the suffixes."""
    glob = "*{" + ",".join(endings) + "}"
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path", "length", "modificationTime")
    )
