"""Access-log queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.operators import logs as ops
from brindle.plans.inputs import LOGS_SQL, log_lines, with_sql
from brindle.session import materialize
from brindle.sources.logs import access_logs, log_status, parse_log


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_log(log_lines(spark, sf_dir))


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_logs(parsed(spark, sf_dir))


def _sql(query: str) -> str:
    return with_sql(LOGS_SQL, query=query)


def _report(report):
    return lambda spark, sf_dir: report(access(spark, sf_dir))


def _parse(spark, sf_dir):
    logs = access(spark, sf_dir)
    return logs.select(
        "host", "client_identd", "user_id",
        F.date_format("date_time", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
        "method", "endpoint", "protocol", "response_code", "content_size",
    )


def _stats(logs):
    return ops.content_stats(logs).withColumn("avg_size", F.round("avg_size", 6))


def _fractions(logs):
    return ops.code_fractions(logs).withColumn("fraction", F.round("fraction", 9))


def _daily_avg(logs):
    return ops.daily_requests_per_host(logs).withColumn("avg_req", F.round("avg_req", 6))


def _by_date(logs):
    return ops.daily_hosts(logs, by="date").withColumn("day", F.col("day").cast("string"))


HOST_BITS, HOST_ERROR = 12, 0.05


def _approx_hosts(spark, sf_dir):
    """Distinct hosts per day, per month and in all: the exact number, and whether the estimate from
    the written daily sketches is within its error."""
    logs = access(spark, sf_dir).select("host", "date_time")
    sketches = materialize(ops.host_sketches(logs, "date", HOST_BITS), "host-sketches")
    month = F.date_format("day", "yyyy-MM")
    estimates = reduce(DataFrame.unionByName, [ops.approx_hosts(sketches, p) for p in (F.col("day"), month, None)])
    day = F.to_date("date_time").cast("string")
    periods = F.array(day, F.substring(day, 1, 7), F.lit("all"))
    exact = logs.select("host", F.explode(periods).alias("period")).groupBy("period")
    exact = exact.agg(F.countDistinct("host").alias("exact"))
    off = F.abs(F.col("n_hosts") - F.col("exact")) <= F.ceil(HOST_ERROR * F.col("exact"))
    return exact.join(estimates, "period", "full").select("period", F.col("exact").alias("n_hosts"), off.alias("within"))


def _top(column, where, k):
    return _sql(
        f"select {column}, count(*) as n from logs where {where} group by {column} "
        f"order by n desc, {column} limit {k}"
    )


QUERIES = {
    "log_approx_hosts": (
        _approx_hosts,
        _sql(
            "select period, count(distinct host) as n_hosts, true as within from (select host, unnest(["
            "strftime(date_time, '%Y-%m-%d'), strftime(date_time, '%Y-%m'), 'all']) as period from logs) group by period"
        ),
    ),
    "log_parse": (
        _parse,
        _sql(
            "select host, '-' as client_identd, '-' as user_id, "
            "strftime(date_time, '%Y-%m-%d %H:%M:%S') as date_time, 'GET' as method, endpoint, "
            "'HTTP/1.0' as protocol, response_code, content_size from logs"
        ),
    ),
    "log_parse_status": (
        lambda spark, sf_dir: log_status(parsed(spark, sf_dir)),
        _sql(
            "select count(*) + count(*) filter (where spoilt) as n_lines, count(*) as n_access, "
            "count(*) filter (where spoilt) as n_failed from all_logs"
        ),
    ),
    "log_content_stats": (
        _report(_stats),
        _sql(
            "select cast(sum(content_size) // count(content_size) as bigint) as avg_int, "
            "round(avg(content_size), 6) as avg_size, min(content_size) as min_size, "
            "max(content_size) as max_size from logs"
        ),
    ),
    "log_code_counts": (
        _report(lambda logs: ops.count_by(logs, "response_code")),
        _sql("select response_code, count(*) as n from logs group by response_code"),
    ),
    "log_code_fraction": (
        _report(_fractions),
        _sql(
            "select response_code, n, round(n / t, 9) as fraction, "
            "case when 100 * n / t < 7 then '' "
            "else cast(cast(round_even(100 * n / t, 0) as bigint) as varchar) || '%' end as label "
            "from (select response_code, count(*) as n, (select count(*) from logs) as t "
            "from logs group by response_code)"
        ),
    ),
    "log_hosts_gt10": (
        _report(ops.hosts_over),
        _sql("select host, count(*) as n from logs group by host having count(*) > 10"),
    ),
    "log_top_endpoints": (
        _report(lambda logs: ops.top(logs, "endpoint", 10)),
        _top("endpoint", "true", 10),
    ),
    "log_top_errors": (_report(ops.top_errors), _top("endpoint", "response_code <> 200", 10)),
    "log_unique_hosts": (
        _report(ops.unique_hosts),
        _sql("select count(distinct host) as n_hosts from logs"),
    ),
    "log_daily_hosts": (
        _report(ops.daily_hosts),
        _sql(
            "select day(date_time) as day, count(distinct host) as n_hosts from logs group by 1 order by 1"
        ),
    ),
    "log_date_hosts": (
        _report(_by_date),
        _sql(
            "select strftime(date_time, '%Y-%m-%d') as day, count(distinct host) as n_hosts "
            "from logs group by 1 order by 1"
        ),
    ),
    "log_daily_avg": (
        _report(_daily_avg),
        _sql(
            "select day(date_time) as day, count(*) as n_requests, count(distinct host) as n_hosts, "
            "round(count(*) / count(distinct host), 6) as avg_req, "
            "count(*) // count(distinct host) as avg_req_int from logs group by 1 order by 1"
        ),
    ),
    "log_404_endpoints": (
        _report(ops.not_found_endpoints),
        _sql("select distinct endpoint from logs where response_code = 404"),
    ),
    "log_404_top20": (
        _report(lambda logs: ops.top(ops.not_found(logs), "endpoint", 20)),
        _top("endpoint", "response_code = 404", 20),
    ),
    "log_404_top_hosts": (
        _report(lambda logs: ops.top(ops.not_found(logs), "host", 25)),
        _top("host", "response_code = 404", 25),
    ),
    "log_404_by_day": (
        _report(ops.not_found_by_day),
        _sql(
            "select day(date_time) as day, count(*) as n from logs where response_code = 404 "
            "group by 1 order by 1"
        ),
    ),
    "log_404_top_days": (
        _report(ops.not_found_top_days),
        _sql(
            "select day(date_time) as day, count(*) as n from logs where response_code = 404 "
            "group by 1 order by n desc, day limit 5"
        ),
    ),
    "log_404_by_hour": (
        _report(ops.not_found_by_hour),
        _sql(
            "select hour(date_time) as hour, count(*) as n from logs where response_code = 404 "
            "group by 1 order by 1"
        ),
    ),
}
