"""Analytics over test results.

``results(test_name, test_suite, status, duration, timestamp, error_message, error_type,
environment, component)`` with status PASSED, FAILED or SKIPPED.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.exprs import duration_text, elapsed, percent, ratio, within_days

PASSED, FAILED, SKIPPED = "PASSED", "FAILED", "SKIPPED"


def _count() -> Column:
    return F.count(F.lit(1))


def _status(name: str) -> Column:
    return F.count_if(F.col("status") == name)


def latest(df: DataFrame, ts: str = "timestamp") -> Column:
    """The newest time in a table as a scalar subquery, the usual ``as_of`` of a report."""
    return df.agg(F.max(ts)).scalar()


def recent(results: DataFrame, days: int = 30, as_of: Column | None = None) -> DataFrame:
    """Results strictly younger than ``days``; ``as_of`` defaults to now."""
    now = F.current_timestamp() if as_of is None else as_of
    return results.where(within_days("timestamp", now, days))


def last_results(results: DataFrame, limit: int = 100, tie_break: Sequence[str] = ("test_name",)) -> DataFrame:
    """The newest ``limit`` results, newest first."""
    return results.orderBy(F.desc("timestamp"), *tie_break).limit(limit)


def daily_stats(results: DataFrame) -> DataFrame:
    m = results.groupBy(F.to_date("timestamp").alias("date")).agg(
        _count().alias("total"),
        _status(PASSED).alias("passed"),
        _status(FAILED).alias("failed"),
        F.sum("duration").alias("duration"),
    )
    return m.select(
        "*",
        percent(F.col("passed"), F.col("total")).alias("success_rate"),
        ratio(F.col("duration"), F.col("total")).alias("avg_duration"),
    )


def linear_trend(series: DataFrame, order: str, values: Sequence[str]) -> DataFrame:
    """Least-squares slope of each value over the row number (0, 1, ...); 0 below two rows.

    The series is an aggregate with one row per day; only it is numbered in one place.
    """
    numbered = series.withColumn("_x", F.row_number().over(Window.orderBy(order)) - 1)
    return numbered.agg(
        *[F.coalesce(F.regr_slope(F.col(v), F.col("_x")), F.lit(0.0)).alias(f"{v}_trend") for v in values],
        *[F.coalesce(F.avg(v), F.lit(0.0)).alias(f"average_{v}") for v in values],
    )


def trends(results: DataFrame) -> DataFrame:
    """Slopes and unweighted means over days."""
    t = linear_trend(daily_stats(results), "date", ["success_rate", "avg_duration"])
    return t.select(
        "success_rate_trend",
        F.col("avg_duration_trend").alias("duration_trend"),
        "average_success_rate",
        F.col("average_avg_duration").alias("average_duration"),
    )


def flaky_tests(results: DataFrame, min_executions: int = 5) -> DataFrame:
    m = results.groupBy("test_name").agg(
        _count().alias("total_executions"),
        _status(PASSED).alias("passed_count"),
        _status(FAILED).alias("failed_count"),
    )
    passed, failed = F.col("passed_count"), F.col("failed_count")
    unstable = (F.col("total_executions") >= min_executions) & (passed > 0) & (failed > 0)
    score = percent(F.least(passed, failed), F.col("total_executions"))
    return m.where(unstable).withColumn("flaky_score", score)


def flaky_sorted(results: DataFrame, min_executions: int = 5) -> DataFrame:
    return flaky_tests(results, min_executions).orderBy(F.desc("flaky_score"), "test_name")


def flaky_quarantine(results: DataFrame, min_rate: float = 0.2, days: int = 7) -> DataFrame:
    """Tests that fail at least that often, locked for some days after the last failure."""
    failed_at = F.when(F.col("status") == FAILED, F.col("timestamp"))
    m = results.groupBy("test_name").agg(
        _count().alias("executions"), _status(FAILED).alias("failures"),
        F.max(failed_at).alias("last_failure"),
    )
    rate = ratio(F.col("failures"), F.col("executions"))
    return m.withColumn("failure_rate", rate).where(
        (F.col("failure_rate") >= min_rate) & (F.col("failures") > 0)
    ).withColumn("quarantined_until", F.timestamp_add("DAY", F.lit(days), F.col("last_failure")))


def failure_patterns(results: DataFrame) -> DataFrame:
    """Failures by error type and by component, in long form ``(dimension, value, failures)``."""
    kinds = F.array(
        *[
            F.struct(
                F.lit(c).alias("dimension"), F.coalesce(F.col(c), F.lit("Unknown")).alias("value")
            )
            for c in ("error_type", "component")
        ]
    )
    return (
        results.where(F.col("status") == FAILED)
        .select(F.inline(kinds))
        .groupBy("dimension", "value")
        .agg(_count().alias("failures"))
    )


def top_failing_tests(results: DataFrame, limit: int = 10) -> DataFrame:
    """A top-k report with the newest error of each test; ties are broken by name."""
    m = results.where(F.col("status") == FAILED).groupBy("test_name").agg(
        _count().alias("failure_count"),
        F.coalesce(F.max_by("error_message", "timestamp"), F.lit("")).alias("latest_error"),
    )
    return m.orderBy(F.desc("failure_count"), "test_name").limit(limit)


def summary(results: DataFrame) -> DataFrame:
    m = results.agg(
        _count().alias("total_tests"),
        _status(PASSED).alias("passed_tests"),
        _status(FAILED).alias("failed_tests"),
        _status(SKIPPED).alias("skipped_tests"),
        F.sum("duration").alias("total_duration"),
    )
    return m.select(
        "total_tests",
        "passed_tests",
        "failed_tests",
        "skipped_tests",
        F.coalesce(percent(F.col("passed_tests"), F.col("total_tests")), F.lit(0.0))
        .alias("success_rate"),
        F.coalesce("total_duration", F.lit(0)).alias("total_duration"),
        F.coalesce(ratio(F.col("total_duration"), F.col("total_tests")), F.lit(0.0))
        .alias("average_duration"),
    )


def status_distribution(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(_count().alias("tests"))


def suite_rollup(suites: DataFrame) -> DataFrame:
    """``suites(test_suite, status, duration_seconds)``: any status but PASSED is a failure."""
    m = suites.agg(
        _count().alias("total_suites"),
        _status(PASSED).alias("passed_suites"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).cast("bigint").alias("total_duration"),
    )
    return m.select(
        "total_suites",
        "passed_suites",
        (F.col("total_suites") - F.col("passed_suites")).alias("failed_suites"),
        "total_duration",
        F.coalesce(percent(F.col("passed_suites"), F.col("total_suites")), F.lit(0.0))
        .alias("success_rate"),
    )


def period_trend(results: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """The last ``days`` against the ``days`` before: success, run time and failure rate."""
    ts = F.col("timestamp")
    start, middle = as_of - F.make_dt_interval(F.lit(2 * days)), as_of - F.make_dt_interval(F.lit(days))
    period = F.when(ts > middle, "current").otherwise("previous")
    rows = results.where((ts > start) & (ts <= as_of)).select("status", "duration", period.alias("_p"))

    def of(name: str, what: Column) -> Column:
        return F.when(F.col("_p") == name, what)

    aggs = []
    for p in ("current", "previous"):
        aggs += [
            F.count(of(p, F.lit(1))).alias(f"{p}_n"),
            F.count_if((F.col("_p") == p) & (F.col("status") == PASSED)).alias(f"{p}_ok"),
            F.count_if((F.col("_p") == p) & (F.col("status") == FAILED)).alias(f"{p}_bad"),
            F.sum(of(p, F.col("duration"))).alias(f"{p}_t"),
        ]
    m = rows.agg(*aggs)

    def metric(name: str, part: str, scale: int, better_up: bool) -> Column:
        now = ratio(F.col(f"current_{part}"), F.col("current_n")) * scale
        before = ratio(F.col(f"previous_{part}"), F.col("previous_n")) * scale
        better = (now > before) if better_up else (now < before)
        return F.struct(
            F.lit(name).alias("metric"),
            now.alias("current"),
            before.alias("previous"),
            (now - before).alias("change"),
            F.when(now == before, "stable").when(better, "improving").when(~better, "declining")
            .otherwise("unknown").alias("trend"),
        )

    return m.select(
        F.inline(
            F.array(
                metric("success_rate", "ok", 100, True),
                metric("execution_time", "t", 1, False),
                metric("failure_rate", "bad", 100, False),
            )
        )
    )


def access_findings(checks: DataFrame) -> DataFrame:
    """Access that differs from what was expected, with how often it was seen."""
    expected, actual = F.col("expected_success"), F.col("actual_success")
    severity = F.when(~expected & actual, "HIGH").when(expected & ~actual, "MEDIUM")
    finding = F.when(F.col("severity") == "HIGH", "Unauthorized access detected").otherwise(
        "Expected access denied"
    )
    return (
        checks.withColumn("severity", severity)
        .where(F.col("severity").isNotNull())
        .groupBy("severity", "service_account", "operation")
        .agg(_count().alias("occurrences"))
        .withColumn("finding", finding)
    )


def access_summary(checks: DataFrame) -> DataFrame:
    m = checks.agg(
        _count().alias("total_tests"),
        F.count_if(F.col("expected_success") == F.col("actual_success")).alias("passed_tests"),
    )
    return m.select(
        "total_tests",
        "passed_tests",
        (F.col("total_tests") - F.col("passed_tests")).alias("failed_tests"),
        F.coalesce(percent(F.col("passed_tests"), F.col("total_tests")), F.lit(0.0))
        .alias("success_rate"),
    )


def run_duration(logs: DataFrame, key: str = "source_category", ts: str = "ts") -> DataFrame:
    m = logs.groupBy(key).agg(F.min(ts).alias("started"), F.max(ts).alias("finished"))
    seconds = elapsed("SECOND", "started", "finished")
    return m.withColumn("duration_seconds", seconds).withColumn(
        "duration_text", duration_text("duration_seconds")
    )


def health_rollup(checks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``checks(status, critical)``: CRITICAL, WARNING or HEALTHY."""
    failed = ~F.col("status").eqNullSafe("PASS")
    m = checks.groupBy(*keys).agg(
        _count().alias("checks"),
        F.count_if(failed).alias("failed_checks"),
        F.count_if(failed & F.coalesce("critical", F.lit(False))).alias("critical_failures"),
    )
    status = (
        F.when(F.col("critical_failures") > 0, "CRITICAL")
        .when(F.col("failed_checks") > 0, "WARNING")
        .otherwise("HEALTHY")
    )
    return m.withColumn("overall_status", status)


def failure_listing(results: DataFrame) -> DataFrame:
    """Failed tests per suite, one row per name: a list cell would hold a whole suite."""
    return (
        results.where(F.col("status") == FAILED)
        .groupBy("test_suite", "test_name")
        .agg(_count().alias("failures"))
    )


def critical_suites_gate(suites: DataFrame, critical: Sequence[str], minimum: float = 85) -> DataFrame:
    """Enough suites pass, and every run of each named suite does; a missing one fails."""
    named = F.col("test_suite").isin(*critical)
    m = suites.agg(
        _count().alias("total_suites"),
        _status(PASSED).alias("passed_suites"),
        F.count_if(named & (F.col("status") != PASSED)).alias("critical_failures"),
        F.count_distinct(F.when(named, F.col("test_suite"))).alias("critical_seen"),
    )
    rate = percent(F.col("passed_suites"), F.col("total_suites"))
    good = (
        (F.col("success_rate") >= minimum)
        & (F.col("critical_failures") == 0)
        & (F.col("critical_seen") == len(set(critical)))
    )
    return m.withColumn("success_rate", rate).withColumn(
        "gate_result", F.when(good, "PASS").otherwise("FAIL")
    )


def report(results: DataFrame, days: int = 30, as_of: Column | None = None) -> DataFrame:
    """The machine-readable report as ``(section, item)`` rows, one JSON document each.

    Sections: summary, trends, flaky_tests, failure_patterns, top_failing_tests and the last
    100 test_results. Lists are rows, so no section has to fit into one cell.
    """
    rows = recent(results, days, as_of)
    sections = {
        "summary": summary(rows),
        "trends": trends(rows),
        "flaky_tests": flaky_tests(rows),
        "failure_patterns": failure_patterns(rows),
        "top_failing_tests": top_failing_tests(rows),
        "test_results": last_results(rows),
    }
    parts = [
        df.select(F.lit(name).alias("section"), F.to_json(F.struct(*df.columns)).alias("item"))
        for name, df in sections.items()
    ]
    return reduce(DataFrame.unionByName, parts)
