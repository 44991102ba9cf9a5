"""Parsers of line records. Every parser maps a table with a `value` column to a typed table.

`status` is `ok`, `header` or `bad`; bad lines stay in the table with their `line`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import ArrayType

from brindle.functions.text import regex_groups, strip_quotes
from brindle.session import materialize

# Formats and header fields of the two record files.
RECORD_PATTERN = r'^(.+),"(.+)",(.*),(.*),(.*)$'
RECORD_HEADER = '"id"'
PAIR_PATTERN = r"^(.+),(.+)$"
PAIR_HEADER = '"idAmazon"'


def _status(parts: Column, header: str) -> Column:
    return (
        F.when(parts.isNull(), F.lit("bad"))
        .when(parts[0] == header, F.lit("header"))
        .otherwise(F.lit("ok"))
    )


def parse_records(lines: DataFrame) -> DataFrame:
    """Catalogue lines to `id, text, status, line`; the text is title, description and maker."""
    parsed = lines.select("value", regex_groups(F.col("value"), RECORD_PATTERN, 5).alias("p"))
    ok = F.col("status") == "ok"
    p = F.col("p")
    return parsed.withColumn("status", _status(p, RECORD_HEADER)).select(
        F.when(ok, strip_quotes(p[0])).alias("id"),
        F.when(ok, F.concat_ws(" ", p[1], p[2], p[3])).alias("text"),
        "status",
        F.col("value").alias("line"),
    )


def parse_pairs(lines: DataFrame) -> DataFrame:
    """Gold-pair lines to `id_a, id_b, status, line`."""
    parsed = lines.select("value", regex_groups(F.col("value"), PAIR_PATTERN, 2).alias("p"))
    ok = F.col("status") == "ok"
    p = F.col("p")
    return parsed.withColumn("status", _status(p, PAIR_HEADER)).select(
        F.when(ok, strip_quotes(p[0])).alias("id_a"),
        F.when(ok, strip_quotes(p[1])).alias("id_b"),
        "status",
        F.col("value").alias("line"),
    )


def status_counts(parsed: DataFrame) -> DataFrame:
    """One row `n_read, n_ok, n_header, n_bad` from a single pass."""
    return parsed.agg(
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "header").alias("n_header"),
        F.count_if(F.col("status") == "bad").alias("n_bad"),
    )


def observed(parsed: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """`parsed`, and its `status_counts` gathered by the first action that reads it to the end.

    The counts cost no pass of their own: `observation.get` has them once that action is done.
    """
    counts = Observation(name)
    is_ = F.col("status")
    return parsed.observe(
        counts,
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(is_ == "ok").alias("n_ok"),
        F.count_if(is_ == "header").alias("n_header"),
        F.count_if(is_ == "bad").alias("n_bad"),
    ), counts


def load(parsed: DataFrame, max_bad: int | None = None, name: str = "load") -> tuple[DataFrame, dict[str, int]]:
    """The valid rows, written once, and the counts of all rows from the same scan.

    With `max_bad`, more bad lines than that, or not exactly one header, are an error.
    """
    rows, counts = observed(parsed, name)
    written = materialize(valid(rows), name)
    found = {k: int(v) for k, v in counts.get.items()}
    if max_bad is not None and (found["n_bad"] > max_bad or found["n_header"] != 1):
        raise ValueError(f"{found['n_bad']} lines failed to parse, {found['n_header']} headers")
    return written, found


def expect_valid(parsed: DataFrame) -> DataFrame:
    """`parsed` itself; a job that comes across a bad line fails there, with the line in its message."""
    message = F.concat(F.lit("line failed to parse: "), F.substring(F.coalesce("line", F.lit("")), 1, 200))
    return parsed.where(F.assert_true(F.col("status") != "bad", message).isNull())


def check_load(parsed: DataFrame) -> DataFrame:
    """The counts of `status_counts`; running it fails unless all lines but one header are valid."""
    clean = (F.col("n_bad") == 0) & (F.col("n_read") == F.col("n_ok") + 1)
    counts = status_counts(parsed)
    failure = F.assert_true(clean, F.lit("lines failed to parse, or not exactly one header"))
    return counts.where(failure.isNull())


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") == "ok").drop("status", "line")


def failed(parsed: DataFrame, show: int | None = None) -> DataFrame:
    """The bad lines; `show` limits them for a report."""
    bad = parsed.where(F.col("status") == "bad").select("line")
    return bad if show is None else bad.limit(show)


def _is_complete(parsed: DataFrame, required: Sequence[str]) -> Column:
    """Whether the required fields are there; of a list, all its elements, and at least one."""
    found = F.lit(True)
    for name in required:
        here = F.col(name).isNotNull()
        if isinstance(parsed.schema[name].dataType, ArrayType):
            here = here & (F.size(name) > 0) & ~F.exists(name, lambda v: v.isNull())
        found = found & F.coalesce(here, F.lit(False))
    return found


def complete(parsed: DataFrame, *required: str) -> DataFrame:
    """Rows of a parsed table whose required fields (by default all) were read."""
    return parsed.where(_is_complete(parsed, required or parsed.columns))


def complete_counts(parsed: DataFrame, *required: str) -> DataFrame:
    """One row `n_read, n_ok, n_bad` of a parsed table."""
    good = _is_complete(parsed, required or parsed.columns)
    return parsed.agg(
        F.count(F.lit(1)).alias("n_read"), F.count_if(good).alias("n_ok"), F.count_if(~good).alias("n_bad")
    )


def parse_ratings(lines: DataFrame) -> DataFrame:
    """`user::item::rating::ts` lines; rows with a field that is not a number have a null there."""
    f = F.split("value", "::")
    return lines.select(
        F.get(f, F.lit(0)).try_cast("int").alias("user"),
        F.get(f, F.lit(1)).try_cast("int").alias("item"),
        F.get(f, F.lit(2)).try_cast("double").alias("rating"),
        F.get(f, F.lit(3)).try_cast("long").alias("ts"),
    )


def parse_titles(lines: DataFrame) -> DataFrame:
    """`item::title::genre|genre` lines."""
    f = F.split("value", "::")
    return lines.select(
        F.get(f, F.lit(0)).try_cast("int").alias("item"),
        F.get(f, F.lit(1)).alias("title"),
        F.split(F.get(f, F.lit(2)), r"\|").alias("genres"),
    )


def parse_points(lines: DataFrame) -> DataFrame:
    """`label,f1,f2,...` lines to `label, features`."""
    numbers = F.transform(F.split("value", ","), lambda v: F.trim(v).try_cast("double"))
    return lines.select(numbers.alias("n")).select(
        F.col("n")[0].alias("label"), F.slice("n", F.lit(2), F.size("n") - 1).alias("features")
    )


def parse_series(lines: DataFrame) -> DataFrame:
    """`x y v1 v2 ...` lines, separated by white space, to `x, y, ts`."""
    words = F.split(F.trim("value"), r"\s+")
    return lines.select(words.alias("w")).select(
        F.col("w")[0].try_cast("int").alias("x"),
        F.col("w")[1].try_cast("int").alias("y"),
        F.transform(
            F.slice("w", F.lit(3), F.size("w") - 2), lambda v: v.try_cast("double")
        ).alias("ts"),
    )
