"""Web access logs in the Common Log Format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.text import regex_groups

# Fixed value: the nine fields of a log line, followed by anything.
LOG_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)[\s\S]*$'
)
# Month names of a log line.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def log_time(s: Column) -> Column:
    """`dd/MMM/yyyy:HH:mm:ss +zzzz` by position; the offset is ignored. Null when not a time."""

    def number(start: int, length: int) -> Column:
        return F.substring(s, start, length).try_cast("int")

    months = F.create_map(*[F.lit(v) for i, m in enumerate(MONTHS) for v in (m, i + 1)])
    return F.try_make_timestamp_ntz(
        number(8, 4),
        F.try_element_at(months, F.substring(s, 4, 3)),
        number(1, 2),
        number(13, 2),
        number(16, 2),
        number(19, 2).cast("decimal(16,6)"),
    )


def content_size(s: Column) -> Column:
    """`-` is 0; null when not a whole number."""
    return F.when(s == "-", F.lit(0).cast("long")).otherwise(s.try_cast("long"))


def parse_log(lines: DataFrame) -> DataFrame:
    """Log lines to typed fields, `ok` and the original `line`.

    A line is ok when it has all nine fields and a readable time and size.
    """
    p = F.col("p")
    fields = F.struct(
        p[0].alias("host"),
        p[1].alias("client_identd"),
        p[2].alias("user_id"),
        log_time(p[3]).alias("date_time"),
        p[4].alias("method"),
        p[5].alias("endpoint"),
        p[6].alias("protocol"),
        p[7].cast("int").alias("response_code"),
        content_size(p[8]).alias("content_size"),
    )
    # inline keeps filters on the fields from being rewritten into more evaluations of the pattern
    parsed = lines.select(
        F.col("value").alias("line"), regex_groups(F.col("value"), LOG_PATTERN, 9).alias("p")
    ).select("line", F.inline(F.array(fields)))
    ok = F.col("host").isNotNull() & F.col("date_time").isNotNull() & F.col("content_size").isNotNull()
    return parsed.withColumn("ok", ok)


def access_logs(parsed: DataFrame) -> DataFrame:
    return parsed.where("ok").drop("ok", "line")


def failed_logs(parsed: DataFrame, show: int | None = None) -> DataFrame:
    bad = parsed.where(~F.col("ok")).select("line")
    return bad if show is None else bad.limit(show)


def log_status(parsed: DataFrame) -> DataFrame:
    """One row `n_lines, n_access, n_failed` from a single pass."""
    return parsed.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("ok").alias("n_access"),
        F.count_if(~F.col("ok")).alias("n_failed"),
    )
