"""Queries: log alerts, panels, evaluation, suppression and cool-down."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import monitoring
from eventloom.plans.catalog import Tables, query


def _mean(column: str) -> str:
    return f"round(CAST(sum({column}) AS DOUBLE) / count({column}), 6)"


@query("alert_consumer_lag", """
    SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, consumer_group, topic,
      count(*) AS hits, count(*) > 1 AS fires
    FROM metric_lines WHERE lag > 10000 GROUP BY ALL""")
def _(t: Tables):
    return monitoring.consumer_lag_alert(t.logs)


@query("alert_connector_failure", """
    SELECT time_bucket(INTERVAL '2 minutes', ts) AS window_start, connector_name, count(*) AS hits,
      count(*) >= 1 AS fires
    FROM connector_lines WHERE status <> 'RUNNING' GROUP BY ALL""")
def _(t: Tables):
    return monitoring.connector_failure_alert(t.logs, monitoring.CONNECTORS)


@query("alert_error_rate", """
    SELECT time_bucket(INTERVAL '5 minutes', ts) AS timeslice,
      count(*) FILTER (level = 'ERROR') AS errors, count(*) AS total,
      round(CAST(count(*) FILTER (level = 'ERROR') AS DOUBLE) / count(*) * 100, 6) AS error_rate
    FROM connector_lines GROUP BY 1 HAVING count(*) FILTER (level = 'ERROR') > 0.05 * count(*)""")
def _(t: Tables):
    return monitoring.error_rate_alert(t.logs, source=monitoring.CONNECTORS)


@query("alert_throughput_drop", """
    WITH s AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS timeslice,
        CAST(sum(throughput) AS DOUBLE) / count(throughput) AS v FROM metric_lines GROUP BY 1)
    SELECT n.timeslice, round(n.v, 6) AS avg_throughput, round(p.v, 6) AS avg_throughput_before,
      round((n.v - p.v) / p.v * 100, 6) AS change_pct
    FROM s n JOIN s p ON n.timeslice = p.timeslice + INTERVAL 1 HOUR
    WHERE (n.v - p.v) / p.v * 100 < -50""")
def _(t: Tables):
    return monitoring.throughput_drop_alert(t.logs)


@query("period_compare", """
    WITH s AS (SELECT date_trunc('hour', event_timestamp) AS h, count(*) AS n FROM user_events GROUP BY 1)
    SELECT a.h AS "hour", a.n AS events, b.n AS events_before,
      round(CAST(a.n - b.n AS DOUBLE) / b.n * 100, 6) AS change_pct
    FROM s a JOIN s b ON a.h = b.h + INTERVAL 24 HOUR""")
def _(t: Tables):
    hourly = t.user_events.groupBy(
        F.window("event_timestamp", "1 hour")["start"].alias("hour")
    ).agg(F.count(F.lit(1)).alias("events"))
    return monitoring.period_compare(hourly, "hour", "events", 24)


@query("alert_job_failure", """
    SELECT time_bucket(INTERVAL '3 minutes', ts) AS window_start, job_name, job_id, count(*) AS hits,
      count(*) >= 1 AS fires
    FROM job_lines WHERE job_status <> 'RUNNING' GROUP BY ALL""")
def _(t: Tables):
    return monitoring.job_failure_alert(t.logs)


def _checkpoint_sql(limit: int) -> str:
    return f"""
    SELECT time_bucket(INTERVAL '10 minutes', ts) AS timeslice, job_name, count(*) AS failures
    FROM job_lines WHERE checkpoint_status = 'FAILED' GROUP BY ALL HAVING count(*) > {limit}"""


@query("alert_checkpoint_failure", _checkpoint_sql(3))
def _(t: Tables):
    return monitoring.checkpoint_failure_alert(t.logs)


@query("alert_checkpoint_failure_lowered", _checkpoint_sql(1))
def _(t: Tables):
    return monitoring.checkpoint_failure_alert(t.logs, threshold=1)


@query("panel_throughput", f"""
    SELECT time_bucket(INTERVAL '1 minute', ts) AS timeslice, {_mean('throughput')} AS avg_throughput
    FROM metric_lines GROUP BY 1""")
def _(t: Tables):
    return monitoring.throughput_panel(t.logs)


@query("panel_topic_distribution", "SELECT topic, count(*) AS lines FROM metric_lines GROUP BY 1")
def _(t: Tables):
    return monitoring.topic_panel(t.logs)


@query("panel_lag_heatmap", f"""
    SELECT consumer_group, topic, {_mean('lag')} AS avg_lag FROM metric_lines GROUP BY 1, 2""")
def _(t: Tables):
    return monitoring.lag_panel(t.logs)


@query("panel_connector_status", "SELECT status, count(*) AS lines FROM connector_lines GROUP BY 1")
def _(t: Tables):
    return monitoring.connector_status_panel(t.logs)


@query("panel_connector_errors", """
    SELECT time_bucket(INTERVAL '5 minutes', ts) AS timeslice,
      count(*) FILTER (level = 'ERROR') AS errors
    FROM connector_lines GROUP BY 1""")
def _(t: Tables):
    return monitoring.connector_errors_panel(t.logs)


_TOP = """
    SELECT connector_name, count(*) AS errors FROM connector_lines WHERE level = 'ERROR'
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""


@query("panel_top_failing", """
    WITH e AS (SELECT connector_name, count(*) AS errors, max(ts) AS last_error FROM connector_lines
        WHERE level = 'ERROR' GROUP BY 1)
    SELECT CAST(row_number() OVER (ORDER BY errors DESC, connector_name) AS INT) AS rank, connector_name, errors,
      round(100.0 * errors / (SELECT sum(errors) FROM e)::DOUBLE, 6) AS error_share_pct, last_error
    FROM e QUALIFY rank <= 10""")
def _(t: Tables):
    return monitoring.top_failing_panel(t.logs)


@query("top_failing_connectors", _TOP)
def _(t: Tables):
    return monitoring.top_failing_connectors(t.logs)


@query("panel_job_status", "SELECT job_status, count(*) AS lines FROM job_lines GROUP BY 1")
def _(t: Tables):
    return monitoring.job_status_panel(t.logs)


@query("panel_latency", f"""
    SELECT time_bucket(INTERVAL '1 minute', ts) AS timeslice, {_mean('latency')} AS avg_latency
    FROM job_lines GROUP BY 1""")
def _(t: Tables):
    return monitoring.latency_panel(t.logs)


@query("panel_checkpoint_duration", f"""
    SELECT time_bucket(INTERVAL '5 minutes', ts) AS timeslice, {_mean('duration')} AS avg_duration
    FROM job_lines GROUP BY 1""")
def _(t: Tables):
    return monitoring.checkpoint_duration_panel(t.logs)


_LIMITS = (1, 5, 10, 30, 60, 300, 600)


@query("agg_histogram", " UNION ALL ".join(
    [f"SELECT '{b}' AS le, count(*) FILTER (value <= {b}) AS cumulative_count FROM events" for b in _LIMITS]
    + ["SELECT '+Inf', count(value) FROM events"]))
def _(t: Tables):
    return monitoring.histogram(t.raw_events, F.col("value"), _LIMITS)


# Rule, comparison, threshold, severity.
RULES = (
    ("high_consumer_lag", "GreaterThan", 1.0, "critical"),
    ("connector_failure", "GreaterThanOrEqual", 1.0, "critical"),
    ("high_error_rate", "GreaterThanOrEqual", 1.0, "warning"),
    ("flink_checkpoint_failure", "GreaterThanOrEqual", 1.0, "warning"),
)
_RULE_ROWS = ", ".join(f"('{r}', '{c}', {v}::DOUBLE, '{s}')" for r, c, v, s in RULES)
_ENVIRONMENT = "CASE event_id % 3 WHEN 0 THEN 'dev' WHEN 1 THEN 'staging' ELSE 'prod' END"


def rules_table(t: Tables):
    return t.spark.createDataFrame(
        list(RULES), "rule string, comparison string, threshold double, severity string"
    )


def rule_values(t: Tables):
    """Result rows per rule, the number an alert's threshold is held against."""
    logs = t.logs
    found = {
        "high_consumer_lag": monitoring.consumer_lag_alert(logs),
        "connector_failure": monitoring.connector_failure_alert(logs, monitoring.CONNECTORS),
        "high_error_rate": monitoring.error_rate_alert(logs, source=monitoring.CONNECTORS),
        "flink_checkpoint_failure": monitoring.checkpoint_failure_alert(logs),
    }
    rows = None
    for rule, df in found.items():
        one = df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit(rule).alias("rule"), "value"
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query("alert_evaluate", f"""
    WITH v AS (
      SELECT 'high_consumer_lag' AS "rule", (SELECT count(*) FROM (SELECT 1 FROM metric_lines
        WHERE lag > 10000 GROUP BY time_bucket(INTERVAL '5 minutes', ts), consumer_group, topic)) AS n
      UNION ALL SELECT 'connector_failure', (SELECT count(*) FROM (SELECT 1 FROM connector_lines
        WHERE status <> 'RUNNING' GROUP BY time_bucket(INTERVAL '2 minutes', ts), connector_name))
      UNION ALL SELECT 'high_error_rate', (SELECT count(*) FROM (SELECT 1 FROM connector_lines
        GROUP BY time_bucket(INTERVAL '5 minutes', ts)
        HAVING count(*) FILTER (level = 'ERROR') > 0.05 * count(*)))
      UNION ALL SELECT 'flink_checkpoint_failure', (SELECT count(*) FROM ({_checkpoint_sql(3)}))),
      r("rule", "comparison", "threshold", severity) AS (VALUES {_RULE_ROWS})
    SELECT r."rule", r."comparison", r."threshold", severity, CAST(n AS DOUBLE) AS "value",
      CASE r."comparison" WHEN 'GreaterThan' THEN n > r."threshold" ELSE n >= r."threshold" END AS fires
    FROM r LEFT JOIN v ON v."rule" = r."rule" """)
def _(t: Tables):
    return monitoring.evaluate_rules(rule_values(t), rules_table(t))


def fired_alerts(t: Tables):
    """An alert per error event: rule by user, severity and environment by id."""
    key = F.col("event_id")
    severity = F.element_at(
        F.array(*[F.lit(s) for s in ("info", "warning", "critical")]),
        (F.call_function("div", key, F.lit(3).cast("bigint")) % 3 + 1).cast("int"),
    )
    third = key % 3
    return t.raw_events.where(F.col("event_type") == "error").select(
        "event_id",
        F.concat(F.lit("rule_"), (F.col("user_id") % 4).cast("string")).alias("rule"),
        severity.alias("severity"),
        F.when(third == 0, "dev").when(third == 1, "staging").otherwise("prod").alias("environment"),
        F.window("ts", "5 minutes")["start"].alias("fired_at"),
    )


_FIRED = f"""
    fired AS (SELECT event_id, 'rule_' || (user_id % 4) AS "rule",
      CASE event_id // 3 % 3 WHEN 0 THEN 'info' WHEN 1 THEN 'warning' ELSE 'critical' END AS severity,
      {_ENVIRONMENT} AS environment, time_bucket(INTERVAL '5 minutes', ts) AS fired_at
    FROM events WHERE event_type = 'error')"""


@query("alert_suppress", f"""
    WITH {_FIRED} SELECT * FROM fired
    WHERE NOT (environment = 'dev' AND severity IN ('info', 'warning'))
      AND NOT (severity = 'warning' AND hour(fired_at) BETWEEN 2 AND 5)""")
def _(t: Tables):
    return monitoring.suppress(fired_alerts(t))


@query("alert_cooldown", f"""
    WITH RECURSIVE {_FIRED},
      grid AS (SELECT DISTINCT "rule", fired_at FROM fired),
      sent AS (
        SELECT "rule", min(fired_at) AS fired_at FROM grid GROUP BY 1
        UNION ALL
        SELECT s."rule", (SELECT min(g.fired_at) FROM grid g WHERE g."rule" = s."rule"
          AND g.fired_at >= s.fired_at + INTERVAL 15 MINUTE) AS fired_at
        FROM sent s WHERE s.fired_at IS NOT NULL)
    SELECT "rule", fired_at FROM sent WHERE fired_at IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', fired_at) ORDER BY fired_at, "rule") <= 20""")
def _(t: Tables):
    return monitoring.cooldown(fired_alerts(t))


@query("log_search_checks", """
    SELECT source_category, count(*) AS total_lines, count(*) FILTER (json_valid(raw)) AS parsed_lines,
      round(CAST(count(*) FILTER (json_valid(raw)) AS DOUBLE) / count(*) * 100, 6) AS parse_rate,
      CASE WHEN count(*) FILTER (json_valid(raw)) > 0.95 * count(*) THEN 'PASS' ELSE 'FAIL' END AS "result"
    FROM logs GROUP BY 1""")
def _(t: Tables):
    return monitoring.log_search_check(t.logs)
