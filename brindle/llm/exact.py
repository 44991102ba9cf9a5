"""Exact duplicates by a tree of merged digest runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.llm.joins import without
from brindle.session import materialize

_KEYS = ("digest", "n_bytes", "check")


def text_digests(docs: DataFrame) -> DataFrame:
    """`doc_id, digest, n_bytes, check` per row: SHA-256 of the text and what verifies it.

    Equal digests count as one text only if length and a second, unrelated hash agree too.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("check"),
    )


def _one_of_each(runs: DataFrame, keep: str) -> DataFrame:
    """Sorted runs of equal number merged: of equal texts the row of the id that stays, their sizes summed.

    Rows of a run and range lie in one task, in the order of their digests; equal ones are neighbours.
    """
    order = {"max": F.desc_nulls_last, "min": F.asc_nulls_last}[keep]("keep_id")
    place = ["run", "range", *_KEYS]
    same = Window.partitionBy(*place)
    return (
        runs.repartition("run", "range")
        .sortWithinPartitions(*place, order)
        .withColumn("group_size", F.sum("group_size").over(same.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("nth", F.row_number().over(same.orderBy(order)))
        .where("nth = 1")
        .drop("nth")
    )


def merge_runs(digests: DataFrame, fanout: int = 16, keep: str = "max", range_rows: int = 1 << 20) -> DataFrame:
    """`digest, n_bytes, check, keep_id, group_size` per text, merged over a tree of sorted runs.

    Every partition begins as one run, by a written column `run` or by its number. Its equal texts
    become one row with the largest (`keep="min"`: smallest) id and the number of rows, so a text
    that holds a third of all rows is one row per run from then on. Runs are exchanged in binomial
    rounds: where the round's bits of a run's number are set, it is sent to the run without them, and
    merged there. A round takes as many bits as `fanout` has, so it merges up to `fanout` runs. Runs
    are cut into ranges of digests, about `range_rows` of all rows each, so that the last run too is spread
    over tasks.
    """
    best = {"max": F.max, "min": F.min}[keep]
    run = F.col("run") if "run" in digests.columns else F.spark_partition_id()
    last, rows = digests.select(run.alias("run")).agg(F.max("run"), F.count(F.lit(1))).first()
    ranges = max(1, -(-rows // range_rows))
    lead = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    runs = (
        digests.withColumns({"run": run.cast("long"), "range": F.floor(lead * ranges / (1 << 32)).cast("long")})
        .groupBy("run", "range", *_KEYS)
        .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    bits, done = max(1, (fanout - 1).bit_length()), 0
    while (last or 0) >> done:
        sent = F.col("run").bitwiseAND(F.lit(~(((1 << bits) - 1) << done)))
        runs = _one_of_each(runs.withColumn("run", sent), keep)
        done += bits
    return runs.select(*_KEYS, "keep_id", "group_size")


def exact_groups(docs: DataFrame, fanout: int = 16, keep: str = "max") -> DataFrame:
    """`doc_id, keep_id, group_size, kept, text_sha256` for every row of `docs(doc_id, text, ...)`.

    A null text counts as empty, and empty texts are equal. Of equal texts the row with the largest
    id stays. Rows that repeat both id and text are counted each and share one decision. A row
    without id is counted, is never the one that stays while another has an id, and where no row of
    a text has an id, `keep_id` is null and `kept` is true. Columns other than the two are not read.
    An empty table gives an empty result.
    """
    digests = materialize(text_digests(docs.select("doc_id", "text")).withColumn("run", F.spark_partition_id()), "digests")
    # written, so that rows of a text that is very frequent may be split over tasks
    groups = materialize(merge_runs(digests, fanout, keep), "groups")
    return digests.join(groups, list(_KEYS)).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay; all columns are kept, rows without id too.

    A row goes by its id and text, so that of an id with several texts the others stay; rows that
    repeat both share one decision. Texts that surely stay do not leave their tasks.
    """
    copies = exact_groups(docs).where("not kept and doc_id is not null")
    gone = copies.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex("text_sha256").alias("mark")).distinct()
    return without(docs, materialize(gone, "copies"), _digest)
