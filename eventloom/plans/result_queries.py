"""Queries: analytics over test results."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import results
from eventloom.plans.catalog import Tables, query
from eventloom.sources import reports

DAYS = 14


def recent(t: Tables):
    all_results = t.test_results
    return results.recent(all_results, DAYS, results.latest(all_results))


def suite_runs(t: Tables):
    """One run per suite and day; a run fails when more than a fifth of its tests do."""
    failed = F.avg(F.when(F.col("status") == "FAILED", 1.0).otherwise(0.0))
    runs = t.test_results.groupBy("test_suite", F.to_date("timestamp").alias("run_date")).agg(
        failed.alias("_failed"), F.floor(F.sum("duration")).cast("bigint").alias("duration_seconds")
    )
    status = F.when(F.col("_failed") > 0.2, "FAILED").otherwise("PASSED")
    return runs.select("test_suite", "run_date", status.alias("status"), "duration_seconds")


_RESULT_COLUMNS = ("test_name, test_suite, status, CAST(duration AS DECIMAL(38,2)) AS duration, "
                   '"timestamp", error_message, error_type, environment, component')
_DAILY = """
    SELECT CAST("timestamp" AS DATE) AS "date", count(*) AS total,
      count(*) FILTER (status = 'PASSED') AS passed, count(*) FILTER (status = 'FAILED') AS failed,
      CAST(sum(duration) AS DECIMAL(38,2)) AS duration,
      CAST(count(*) FILTER (status = 'PASSED') AS DOUBLE) / count(*) * 100 AS success_rate,
      CAST(sum(duration) AS DOUBLE) / count(*) AS avg_duration
    FROM recent_tests GROUP BY 1"""


@query("recent_results", f"SELECT {_RESULT_COLUMNS} FROM recent_tests")
def _(t: Tables):
    return recent(t)


@query("last_results", f"""
    SELECT {_RESULT_COLUMNS} FROM recent_tests ORDER BY "timestamp" DESC, test_name LIMIT 100""")
def _(t: Tables):
    return results.last_results(recent(t))


@query("result_daily_stats", f"""
    SELECT * REPLACE (round(success_rate, 6) AS success_rate, round(avg_duration, 6) AS avg_duration)
    FROM ({_DAILY})""")
def _(t: Tables):
    return results.daily_stats(recent(t))


@query("result_trends", f"""
    WITH d AS (SELECT *, row_number() OVER (ORDER BY "date") - 1 AS x FROM ({_DAILY}))
    SELECT round(regr_slope(success_rate, x), 6) AS success_rate_trend,
      round(regr_slope(avg_duration, x), 6) AS duration_trend,
      round(avg(success_rate), 6) AS average_success_rate, round(avg(avg_duration), 6) AS average_duration
    FROM d""")
def _(t: Tables):
    return results.trends(recent(t))


@query("agg_linear_trend", """
    WITH d AS (SELECT CAST(event_timestamp AS DATE) AS "day", count(*) AS events FROM user_events GROUP BY 1),
      n AS (SELECT *, row_number() OVER (ORDER BY "day") - 1 AS x FROM d)
    SELECT round(regr_slope(events, x), 6) AS events_trend, round(avg(events), 6) AS average_events FROM n""")
def _(t: Tables):
    days = t.user_events.groupBy(F.to_date("event_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("events")
    )
    return results.linear_trend(days, "day", ["events"])


_FLAKY = """
    SELECT test_name, count(*) AS total_executions, count(*) FILTER (status = 'PASSED') AS passed_count,
      count(*) FILTER (status = 'FAILED') AS failed_count,
      round(CAST(least(count(*) FILTER (status = 'PASSED'), count(*) FILTER (status = 'FAILED')) AS DOUBLE)
        / count(*) * 100, 6) AS flaky_score
    FROM recent_tests GROUP BY 1
    HAVING count(*) >= 5 AND bool_or(status = 'PASSED') AND bool_or(status = 'FAILED')"""


@query("flaky_tests", _FLAKY)
def _(t: Tables):
    return results.flaky_tests(recent(t))


@query("flaky_sorted", f"{_FLAKY} ORDER BY flaky_score DESC, test_name")
def _(t: Tables):
    return results.flaky_sorted(recent(t))


@query("failure_patterns", """
    SELECT 'error_type' AS dimension, coalesce(error_type, 'Unknown') AS "value", count(*) AS failures
    FROM recent_tests WHERE status = 'FAILED' GROUP BY ALL
    UNION ALL SELECT 'component', coalesce(component, 'Unknown'), count(*)
    FROM recent_tests WHERE status = 'FAILED' GROUP BY ALL""")
def _(t: Tables):
    return results.failure_patterns(recent(t))


@query("top_failing_tests", """
    SELECT test_name, count(*) AS failure_count, arg_max(error_message, "timestamp") AS latest_error
    FROM recent_tests WHERE status = 'FAILED' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(t: Tables):
    return results.top_failing_tests(recent(t))


@query("result_summary", """
    SELECT count(*) AS total_tests, count(*) FILTER (status = 'PASSED') AS passed_tests,
      count(*) FILTER (status = 'FAILED') AS failed_tests,
      count(*) FILTER (status = 'SKIPPED') AS skipped_tests,
      round(CAST(count(*) FILTER (status = 'PASSED') AS DOUBLE) / count(*) * 100, 6) AS success_rate,
      CAST(sum(duration) AS DECIMAL(38,2)) AS total_duration,
      round(CAST(sum(duration) AS DOUBLE) / count(*), 6) AS average_duration
    FROM recent_tests""")
def _(t: Tables):
    return results.summary(recent(t))


@query("status_distribution", "SELECT status, count(*) AS tests FROM recent_tests GROUP BY 1")
def _(t: Tables):
    return results.status_distribution(recent(t))


@query("suite_rollup", """
    SELECT count(*) AS total_suites, count(*) FILTER (status = 'PASSED') AS passed_suites,
      count(*) FILTER (status <> 'PASSED') AS failed_suites,
      CAST(sum(duration_seconds) AS BIGINT) AS total_duration,
      round(CAST(count(*) FILTER (status = 'PASSED') AS DOUBLE) / count(*) * 100, 6) AS success_rate
    FROM suite_runs""")
def _(t: Tables):
    return results.suite_rollup(suite_runs(t))


@query("period_trend", """
    WITH w AS (SELECT *, (SELECT max("timestamp") FROM test_results) AS now FROM test_results),
      p AS (SELECT *, "timestamp" > now - INTERVAL 14 DAY AS cur FROM w
            WHERE "timestamp" > now - INTERVAL 28 DAY),
      m AS (SELECT cur, CAST(count(*) FILTER (status = 'PASSED') AS DOUBLE) / count(*) * 100 AS ok,
              CAST(count(*) FILTER (status = 'FAILED') AS DOUBLE) / count(*) * 100 AS bad,
              CAST(sum(duration) AS DOUBLE) / count(*) AS secs FROM p GROUP BY 1),
      v AS (SELECT 'success_rate' AS metric, ok AS x, cur, 1 AS sign FROM m
            UNION ALL SELECT 'failure_rate', bad, cur, -1 FROM m
            UNION ALL SELECT 'execution_time', secs, cur, -1 FROM m),
      f AS (SELECT metric, max(x) FILTER (cur) AS a, max(x) FILTER (NOT cur) AS b, max(sign) AS sign
            FROM v GROUP BY 1)
    SELECT metric, round(a, 6) AS "current", round(b, 6) AS previous, round(a - b, 6) AS "change",
      CASE WHEN a = b THEN 'stable' WHEN (a - b) * sign > 0 THEN 'improving' ELSE 'declining' END AS trend
    FROM f""")
def _(t: Tables):
    all_results = t.test_results
    return results.period_trend(all_results, results.latest(all_results), DAYS)


@query("access_findings", """
    SELECT CASE WHEN actual_success THEN 'HIGH' ELSE 'MEDIUM' END AS severity, service_account,
      operation, count(*) AS occurrences, CASE WHEN actual_success THEN 'Unauthorized access detected'
        ELSE 'Expected access denied' END AS finding
    FROM access_checks WHERE expected_success <> actual_success GROUP BY ALL""")
def _(t: Tables):
    return results.access_findings(t.access_checks)


@query("access_summary", """
    SELECT count(*) AS total_tests, count(*) FILTER (expected_success = actual_success) AS passed_tests,
      count(*) FILTER (expected_success <> actual_success) AS failed_tests,
      round(CAST(count(*) FILTER (expected_success = actual_success) AS DOUBLE) / count(*) * 100, 6)
        AS success_rate
    FROM access_checks""")
def _(t: Tables):
    return results.access_summary(t.access_checks)


@query("run_duration", """
    WITH m AS (SELECT source_category, min(ts) AS started, max(ts) AS finished,
        date_sub('second', min(ts), max(ts)) AS s FROM logs GROUP BY 1)
    SELECT source_category, started, finished, s AS duration_seconds,
      (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's' AS duration_text
    FROM m""")
def _(t: Tables):
    return results.run_duration(t.logs)


@query("health_rollup", """
    WITH c AS (SELECT environment, status = 'PASSED' AS good, test_suite = 'suite_0' AND component IS NULL
        AS critical FROM test_results)
    SELECT environment, count(*) AS checks, count(*) FILTER (NOT good) AS failed_checks,
      count(*) FILTER (NOT good AND critical) AS critical_failures,
      CASE WHEN bool_or(NOT good AND critical) THEN 'CRITICAL' WHEN bool_or(NOT good) THEN 'WARNING'
        ELSE 'HEALTHY' END AS overall_status
    FROM c GROUP BY 1""")
def _(t: Tables):
    checks = t.test_results.select(
        "environment",
        F.when(F.col("status") == "PASSED", "PASS").otherwise("FAIL").alias("status"),
        ((F.col("test_suite") == "suite_0") & F.col("component").isNull()).alias("critical"),
    )
    return results.health_rollup(checks, ["environment"])


@query("flaky_quarantine", """
    SELECT test_name, count(*) AS executions, count(*) FILTER (status = 'FAILED') AS failures,
      max("timestamp") FILTER (status = 'FAILED') AS last_failure,
      round(CAST(count(*) FILTER (status = 'FAILED') AS DOUBLE) / count(*), 6) AS failure_rate,
      max("timestamp") FILTER (status = 'FAILED') + INTERVAL 7 DAY AS quarantined_until
    FROM recent_tests GROUP BY 1
    HAVING count(*) FILTER (status = 'FAILED') > 0
      AND CAST(count(*) FILTER (status = 'FAILED') AS DOUBLE) / count(*) >= 0.2""")
def _(t: Tables):
    return results.flaky_quarantine(recent(t))


@query("failure_listing", """
    SELECT test_suite, test_name, count(*) AS failures FROM recent_tests WHERE status = 'FAILED'
    GROUP BY 1, 2""")
def _(t: Tables):
    return results.failure_listing(recent(t))


@query("critical_suites_gate", """
    SELECT count(*) AS total_suites, count(*) FILTER (status = 'PASSED') AS passed_suites,
      count(*) FILTER (test_suite IN ('suite_0', 'suite_1') AND status <> 'PASSED') AS critical_failures,
      count(DISTINCT test_suite) FILTER (test_suite IN ('suite_0', 'suite_1')) AS critical_seen,
      round(CAST(count(*) FILTER (status = 'PASSED') AS DOUBLE) / count(*) * 100, 6) AS success_rate,
      CASE WHEN 100.0 * count(*) FILTER (status = 'PASSED') / count(*) >= 85
        AND count(*) FILTER (test_suite IN ('suite_0', 'suite_1') AND status <> 'PASSED') = 0
        AND count(DISTINCT test_suite) FILTER (test_suite IN ('suite_0', 'suite_1')) = 2
        THEN 'PASS' ELSE 'FAIL' END AS gate_result
    FROM suite_runs""")
def _(t: Tables):
    return results.critical_suites_gate(suite_runs(t), ["suite_0", "suite_1"])


# What names an item of a section, and a number and a text that belong to it.
_REPORT_FIELDS = {
    "summary": (None, "total_tests", "success_rate"),
    "trends": (None, None, "success_rate_trend"),
    "flaky_tests": ("test_name", "total_executions", "flaky_score"),
    "failure_patterns": ("value", "failures", None),
    "top_failing_tests": ("test_name", "failure_count", None),
    "test_results": ("test_name", None, "duration"),
}


@query("report_json", f"""
    WITH d AS (SELECT *, row_number() OVER (ORDER BY "date") - 1 AS x FROM ({_DAILY})), f AS ({_FLAKY})
    SELECT 'summary' AS section, NULL AS "name", count(*) AS "number",
      round(CAST(count(*) FILTER (status = 'PASSED') AS DOUBLE) / count(*) * 100, 6) AS measure
      FROM recent_tests
    UNION ALL SELECT 'trends', NULL, NULL, round(regr_slope(success_rate, x), 6) FROM d
    UNION ALL SELECT 'flaky_tests', test_name, total_executions, flaky_score FROM f
    UNION ALL SELECT 'failure_patterns', coalesce(error_type, 'Unknown'), count(*), NULL
      FROM recent_tests WHERE status = 'FAILED' GROUP BY 2
    UNION ALL SELECT 'failure_patterns', coalesce(component, 'Unknown'), count(*), NULL
      FROM recent_tests WHERE status = 'FAILED' GROUP BY 2
    UNION ALL (SELECT 'top_failing_tests', test_name, count(*), NULL FROM recent_tests
      WHERE status = 'FAILED' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
    UNION ALL (SELECT 'test_results', test_name, NULL, CAST(duration AS DOUBLE) FROM recent_tests
      ORDER BY "timestamp" DESC, test_name LIMIT 100)""")
def _(t: Tables):
    """The report's documents, read back from their JSON."""
    all_results = t.test_results
    rows = results.report(all_results, DAYS, results.latest(all_results))

    def read(position: int):
        out = F.lit(None).cast("string")
        for section, fields in _REPORT_FIELDS.items():
            if fields[position]:
                value = F.get_json_object("item", f"$.{fields[position]}")
                out = F.when(F.col("section") == section, value).otherwise(out)
        return out

    return rows.select(
        "section", read(0).alias("name"), read(1).cast("bigint").alias("number"),
        read(2).cast("double").alias("measure"),
    )


# --- report files --------------------------------------------------------------------------

_CASES_SQL = """
    SELECT 'test_' || user_id || '_' || event_id AS test_name, 'suite_' || (user_id % 5) AS test_suite,
      status, CASE status WHEN 'FAILED' THEN 'err ' || event_id WHEN 'SKIPPED' THEN 'off' END
        AS error_message,
      CASE status WHEN 'FAILED' THEN 'Failure' WHEN 'SKIPPED' THEN 'Skipped' END AS error_type
    FROM (SELECT *, CASE WHEN event_id % 17 = 0 THEN 'SKIPPED' WHEN event_type = 'error'
            THEN 'FAILED' ELSE 'PASSED' END AS status FROM events)"""


def _junit_files(t: Tables) -> str:
    """The results as JUnit files, one suite element per test run."""
    path = t.scratch("junit")
    key = F.col("event_id")
    failed = F.col("event_type") == "error"
    status = F.when(key % 17 == 0, "SKIPPED").when(failed, "FAILED").otherwise("PASSED")
    case = F.struct(
        F.concat(F.lit("test_"), F.col("user_id").cast("string"), F.lit("_"), key.cast("string"))
        .alias("_name"),
        F.lit("0.5").alias("_time"),
        F.when(
            status == "FAILED", F.struct(F.concat(F.lit("err "), key.cast("string")).alias("_message"))
        ).alias("failure"),
        F.when(status == "SKIPPED", F.struct(F.lit("off").alias("_message"))).alias("skipped"),
    )
    t.raw_events.select(
        F.concat(F.lit("suite_"), (F.col("user_id") % 5).cast("string")).alias("_name"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("_timestamp"),
        F.lit(1).alias("_tests"),
        (status == "FAILED").cast("int").alias("_failures"),
        (status == "SKIPPED").cast("int").alias("_skipped"),
        F.array(case).alias("testcase"),
    ).write.format("xml").option("rootTag", "testsuites").option("rowTag", "testsuite").save(path)
    return path


@query("src_junit_xml", _CASES_SQL)
def _(t: Tables):
    cases = reports.read_junit_cases(t.spark, _junit_files(t))
    return cases.select("test_name", "test_suite", "status", "error_message", "error_type")


@query("src_junit_xml_suites", """
    SELECT 'suite_' || (user_id % 5) AS suite_name, CAST(sum(n) AS BIGINT) AS total_tests,
      CAST(sum(n - f - s) AS BIGINT) AS passed_tests, CAST(sum(f) AS BIGINT) AS failed_tests,
      CAST(sum(s) AS BIGINT) AS skipped_tests
    FROM (SELECT user_id, count(*) AS n,
        count(*) FILTER (event_type = 'error' AND event_id % 17 <> 0) AS f,
        count(*) FILTER (event_id % 17 = 0) AS s FROM events GROUP BY 1) GROUP BY 1""")
def _(t: Tables):
    suites = reports.read_junit_suites(t.spark, _junit_files(t))
    names = ("total_tests", "passed_tests", "failed_tests", "skipped_tests")
    return suites.groupBy("suite_name").agg(*[F.sum(n).alias(n) for n in names])


@query("src_suite_json", """
    SELECT CASE WHEN test_suite = 'suite_4' THEN 'unknown' ELSE test_suite END AS test_suite, status,
      CAST(sum(duration_seconds) AS DOUBLE) AS duration_seconds, count(*) AS runs
    FROM suite_runs GROUP BY ALL""")
def _(t: Tables):
    path = t.scratch("suites")
    runs = suite_runs(t).withColumn(
        "test_suite", F.when(F.col("test_suite") != "suite_4", F.col("test_suite"))
    )
    runs.write.json(path)
    read = reports.read_suite_results(t.spark, path, lines=True)
    return read.groupBy("test_suite", "status").agg(
        F.sum("duration_seconds").alias("duration_seconds"), F.count(F.lit(1)).alias("runs")
    )
