"""Reports over parsed access logs. Each takes the table of valid log records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.text import percent_label

NOT_FOUND = 404


def _n(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def day_key(by: str = "day") -> Column:
    """`day` of the month, which merges months, or the full `date`."""
    time = F.col("date_time")
    return F.dayofmonth(time).cast("long") if by == "day" else F.to_date(time)


def content_stats(logs: DataFrame) -> DataFrame:
    """Average (whole and exact), smallest and largest size."""
    size = F.col("content_size")
    return logs.agg(
        F.expr("sum(content_size) div count(content_size)").alias("avg_int"),
        F.avg(size).alias("avg_size"),
        F.min(size).alias("min_size"),
        F.max(size).alias("max_size"),
    )


def count_by(logs: DataFrame, column: str) -> DataFrame:
    return logs.groupBy(column).agg(_n())


def code_fractions(logs: DataFrame) -> DataFrame:
    """Count and share per response code with the label of a pie slice."""
    counts = count_by(logs, "response_code")
    share = F.col("n") / counts.agg(F.sum("n")).scalar()
    return counts.withColumn("fraction", share).withColumn(
        "label", percent_label(F.col("fraction") * 100)
    )


def hosts_over(logs: DataFrame, n: int = 10) -> DataFrame:
    return count_by(logs, "host").where(F.col("n") > n)


def top(logs: DataFrame, column: str, k: int) -> DataFrame:
    """The `k` most frequent values; ties by value."""
    return count_by(logs, column).orderBy(F.desc("n"), column).limit(k)


def top_errors(logs: DataFrame, k: int = 10) -> DataFrame:
    """Endpoints with most answers other than 200, so that redirects count too."""
    return top(logs.where(F.col("response_code") != 200), "endpoint", k)


def unique_hosts(logs: DataFrame) -> DataFrame:
    return logs.agg(F.countDistinct("host").alias("n_hosts"))


def daily_hosts(logs: DataFrame, by: str = "day") -> DataFrame:
    return logs.groupBy(day_key(by).alias("day")).agg(F.countDistinct("host").alias("n_hosts")).orderBy("day")


def daily_requests_per_host(logs: DataFrame, by: str = "day") -> DataFrame:
    """Requests, distinct hosts and their ratio per day, in one aggregation instead of a join."""
    return (
        logs.groupBy(day_key(by).alias("day"))
        .agg(_n("n_requests"), F.countDistinct("host").alias("n_hosts"))
        .withColumn("avg_req", F.col("n_requests") / F.col("n_hosts"))
        .withColumn("avg_req_int", F.expr("n_requests div n_hosts"))
        .orderBy("day")
    )


def not_found(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("response_code") == NOT_FOUND)


def not_found_endpoints(logs: DataFrame) -> DataFrame:
    return not_found(logs).select("endpoint").distinct()


def not_found_by_day(logs: DataFrame, by: str = "day") -> DataFrame:
    return not_found(logs).groupBy(day_key(by).alias("day")).agg(_n()).orderBy("day")


def not_found_top_days(logs: DataFrame, k: int = 5, by: str = "day") -> DataFrame:
    return not_found(logs).groupBy(day_key(by).alias("day")).agg(_n()).orderBy(F.desc("n"), "day").limit(k)


def not_found_by_hour(logs: DataFrame) -> DataFrame:
    hour = F.hour("date_time").cast("long").alias("hour")
    return not_found(logs).groupBy(hour).agg(_n()).orderBy("hour")


def host_sketches(logs: DataFrame, by: str = "date", lg_k: int = 12) -> DataFrame:
    """`day, sketch`: a mergeable sketch of the distinct hosts of every day.

    Kept as a table, sketches answer for any set of days without the logs. The relative error of an
    estimate is about `1.04 / sqrt(2 ** lg_k)`.
    """
    return logs.groupBy(day_key(by).alias("day")).agg(F.hll_sketch_agg("host", lg_k).alias("sketch"))


def approx_hosts(sketches: DataFrame, period: Column | None = None) -> DataFrame:
    """`period, n_hosts`: estimated distinct hosts of every period, from the sketches of its days.

    Without a period there is one row for all days.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_hosts")
    if period is None:
        return sketches.agg(merged).select(F.lit("all").alias("period"), "n_hosts")
    return sketches.groupBy(period.cast("string").alias("period")).agg(merged)
