"""Queries: source-to-sink reconciliation and quality gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.exprs import micros
from eventloom.operators import checks, flow, gates
from eventloom.plans.catalog import Tables, query
from eventloom.sinks import tables as sinks


def _verdict(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE 'FAIL' END"


@query("flow_count_match", f"""
    SELECT p AS produced, d AS delivered, d - p AS difference,
      round(CAST(d AS DOUBLE) / p * 100, 6) AS delivery_rate, {_verdict('p = d')} AS "result"
    FROM (SELECT (SELECT count(*) FROM flow_source) AS p, (SELECT count(*) FROM flow_sink) AS d)""")
def _(t: Tables):
    return flow.count_match(t.flow_source, t.flow_sink)


@query("flow_integrity", f"""
    WITH k AS (SELECT event_id, min("value") AS v FROM flow_sink GROUP BY 1),
      n AS (SELECT (SELECT count(*) FROM flow_source) AS source_keys, (SELECT count(*) FROM k) AS sink_keys,
        (SELECT count(*) FROM flow_source s ANTI JOIN k USING (event_id)) AS missing,
        (SELECT count(*) FROM k ANTI JOIN flow_source s USING (event_id)) AS unexpected,
        (SELECT count(*) FROM flow_source s JOIN k USING (event_id) WHERE s."value" <> k.v) AS changed)
    SELECT *, {_verdict('missing + unexpected + changed = 0')} AS "result" FROM n""")
def _(t: Tables):
    fields = ["user_id", "event_type", "event_timestamp", "value"]
    return flow.integrity(t.flow_source, t.flow_sink, "event_id", fields)


@query("flow_ordering", f"""
    WITH a AS (SELECT user_id, "offset" < lag("offset") OVER (PARTITION BY user_id
        ORDER BY delivered_at, "offset") AS fell FROM flow_source)
    SELECT user_id, count(*) AS records, count(*) FILTER (fell) AS inversions,
      {_verdict('count(*) FILTER (fell) = 0')} AS "result" FROM a GROUP BY 1""")
def _(t: Tables):
    return flow.ordering(t.flow_source, "user_id", "offset", "delivered_at")


@query("flow_ordering_partitions", f"""
    WITH a AS (SELECT "partition", "offset" < lag("offset") OVER (PARTITION BY "partition"
        ORDER BY delivered_at, "offset") AS fell FROM flow_source)
    SELECT "partition", count(*) AS records, count(*) FILTER (fell) AS inversions,
      {_verdict('count(*) FILTER (fell) = 0')} AS "result" FROM a GROUP BY 1""")
def _(t: Tables):
    return flow.ordering(t.flow_source, "partition", "offset", "delivered_at", slot_seconds=600)


@query("flow_duplicates", """
    SELECT count(*) AS total, count(*) - count(DISTINCT event_id) AS duplicates,
      round(CAST(count(*) - count(DISTINCT event_id) AS DOUBLE) / count(*) * 100, 6) AS duplicate_rate,
      CASE WHEN 1000 * (count(*) - count(DISTINCT event_id)) <= count(*) THEN 'PASS' ELSE 'FAIL' END
        AS "result"
    FROM flow_sink""")
def _(t: Tables):
    return flow.duplicates(t.flow_sink, "event_id")


@query("dedup_batch", """
    SELECT event_id, user_id, event_type, CAST("value" AS DECIMAL(38,2)) AS "value"
    FROM flow_sink GROUP BY ALL""")
def _(t: Tables):
    rows = t.flow_sink.select("event_id", "user_id", "event_type", "value")
    return flow.drop_duplicates(rows, ["event_id"], ["value"])


@query("flow_delivery_sla", f"""
    SELECT count(*) AS delivered, count(*) FILTER (d <= 30) AS within_sla, max(d) AS max_delay_seconds,
      round(avg(d), 6) AS avg_delay_seconds,
      round(CAST(count(*) FILTER (d <= 30) AS DOUBLE) / count(*) * 100, 6) AS sla_rate,
      {_verdict('100.0 * count(*) FILTER (d <= 30) / count(*) >= 99.9')} AS "result"
    FROM (SELECT date_sub('second', event_timestamp, delivered_at) AS d FROM flow_source)""")
def _(t: Tables):
    return flow.delivery_sla(t.flow_source, "event_timestamp", "delivered_at")


@query("flow_partition_balance", f"""
    WITH c AS (SELECT "partition", count(*) AS records FROM flow_source GROUP BY 1),
      d AS (SELECT *, (records - s / 6.0::DOUBLE) / (s / 6.0::DOUBLE) * 100 AS off
            FROM c, (SELECT CAST(sum(records) AS DOUBLE) AS s FROM c))
    SELECT "partition", records, round(off, 6) AS deviation_pct, {_verdict('abs(off) <= 10')} AS "result"
    FROM d""")
def _(t: Tables):
    return flow.partition_balance(t.flow_source, "partition", 6)


@query("consumer_lag", """
    SELECT "partition", max("offset") AS end_offset, 'group_a' AS consumer_group,
      max("offset") - "partition" * 3 AS committed, "partition" * 3 AS lag
    FROM flow_source GROUP BY "partition" """)
def _(t: Tables):
    return flow.consumer_lag(t.flow_source, t.committed_offsets)


_LATE = "date_sub('second', event_timestamp, processing_time)"


@query("late_split", f"""
    SELECT event_id, {_LATE} AS late_by_seconds, {_LATE} > 5 AS is_late FROM user_events""")
def _(t: Tables):
    return flow.late_split(t.user_events).select("event_id", "late_by_seconds", "is_late")


@query("late_share", f"""
    SELECT count(*) AS events, count(*) FILTER ({_LATE} > 5) AS late_events,
      round(CAST(count(*) FILTER ({_LATE} > 5) AS DOUBLE) / count(*) * 100, 6) AS late_pct,
      {_verdict(f'count(*) FILTER ({_LATE} > 5) <= 0.05 * count(*)')} AS "result"
    FROM user_events""")
def _(t: Tables):
    return flow.late_share(t.user_events)


# --- gates ---------------------------------------------------------------------------------

def pipeline_metrics(t: Tables):
    """The gated numbers from the derived tables, in long form."""
    seconds = F.timestamp_diff("SECOND", F.col("event_time"), F.col("processing_time"))
    from_enriched = t.enriched_left.agg(
        (F.count("event_time") / F.count(F.lit(1)) * 100).alias("data_completeness"),
        (F.count("user_name") / F.count(F.lit(1)) * 100).alias("join_success_rate"),
        (F.count_if(seconds > 60) / F.count(F.lit(1)) * 100).alias("late_data_percentage"),
        (F.sum(seconds) / F.count(seconds)).alias("processing_latency_seconds"),
    )
    from_results = t.test_results.agg(
        (F.count_if(F.col("status") == "PASSED") / F.count(F.lit(1)) * 100).alias("test_success_rate"),
    )
    span = micros(F.max("processing_time")) - micros(F.min("processing_time"))
    from_events = t.user_events.agg(
        (F.count_if(F.col("event_type") == "error") / F.count(F.lit(1)) * 100).alias("data_error_rate"),
        (F.count(F.lit(1)) / (span / 1e6)).alias("throughput_events_per_second"),
    )
    both = [F.max((F.col("status") == s).cast("int")) for s in ("PASSED", "FAILED")]
    per_test = t.test_results.groupBy("test_name").agg((both[0] + both[1] == 2).alias("flaky"))
    flaky = per_test.agg((F.count_if("flaky") / F.count(F.lit(1)) * 100).alias("flaky_test_rate"))
    parts = [gates.long_metrics(m) for m in (from_enriched, from_results, from_events, flaky)]
    return reduce(lambda a, b: a.unionByName(b), parts)


_METRICS_SQL = f"""
    m AS (SELECT 100.0 * count(event_time) / count(*) AS a, 100.0 * count(user_name) / count(*) AS b,
        100.0 * count(*) FILTER (date_sub('second', event_time, processing_time) > 60) / count(*) AS c,
        CAST(sum(date_sub('second', event_time, processing_time)) AS DOUBLE) / count(*) AS d
      FROM enriched_left),
    v AS (SELECT 'data_completeness' AS metric, a::DOUBLE AS "value" FROM m
      UNION ALL SELECT 'join_success_rate', b FROM m UNION ALL SELECT 'late_data_percentage', c FROM m
      UNION ALL SELECT 'processing_latency_seconds', d FROM m
      UNION ALL SELECT 'data_error_rate', 100.0 * count(*) FILTER (event_type = 'error') / count(*) FROM user_events
      UNION ALL SELECT 'throughput_events_per_second', count(*) / ((epoch_us(max(processing_time))
        - epoch_us(min(processing_time))) / 1e6) FROM user_events
      UNION ALL SELECT 'flaky_test_rate', 100.0 * count(*) FILTER (flaky) / count(*) FROM (SELECT
        bool_or(status = 'PASSED') AND bool_or(status = 'FAILED') AS flaky FROM test_results GROUP BY test_name)
      UNION ALL SELECT 'test_success_rate', 100.0 * count(*) FILTER (status = 'PASSED') / count(*)
        FROM test_results)"""
_GATE_ROWS = ", ".join(
    f"('{m}', '{op}', {gates.ENVIRONMENT_GATES['development'].get(m, v)}::DOUBLE, {str(b).lower()})"
    for m, op, v, b in gates.PIPELINE_GATES
)
_EVALUATED = f"""
    {_METRICS_SQL},
    g(metric, "bound", "threshold", "blocking") AS (VALUES {_GATE_ROWS}),
    x AS (SELECT g.metric, v."value", g."bound", g."threshold", g."blocking",
        CASE WHEN (g."bound" = 'min' AND v."value" >= g."threshold")
          OR (g."bound" = 'max' AND v."value" <= g."threshold") THEN 'PASS'
          WHEN v."value" IS NULL THEN 'MISSING' ELSE 'FAIL' END AS "result"
      FROM g LEFT JOIN v ON v.metric = g.metric)"""
_EVALUATED_ROWS = f"""
    WITH {_EVALUATED}
    SELECT metric, round("value", 6) AS "value", "bound", "threshold", "blocking", "result" FROM x"""


@query("gate_evaluate", _EVALUATED_ROWS)
def _(t: Tables):
    return gates.evaluate(pipeline_metrics(t), gates.gate_table(t.spark, environment="development"))


_ALL_GATE_ROWS = ", ".join(
    f"('{e or 'default'}', '{m}', '{op}', {gates.ENVIRONMENT_GATES[e].get(m, v) if e else v}::DOUBLE)"
    for e in (None, *gates.ENVIRONMENT_GATES) for m, op, v, _ in gates.PIPELINE_GATES
)


@query("gate_join", f"""
    WITH s AS (SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS errors,
        count(*) FILTER (date_sub('second', event_timestamp, processing_time) > 60) AS late,
        count(DISTINCT user_id) AS users FROM user_events),
      v AS (SELECT 'data_error_rate' AS metric, 100.0 * errors / n::DOUBLE AS "value" FROM s
        UNION ALL SELECT 'late_data_percentage', 100.0 * late / n::DOUBLE FROM s
        UNION ALL SELECT 'active_users', users FROM s
        UNION ALL SELECT 'test_success_rate', 100.0 * count(*) FILTER (status = 'PASSED') / count(*)::DOUBLE
          FROM test_results),
      g(environment, metric, "bound", "threshold") AS (VALUES {_ALL_GATE_ROWS})
    SELECT environment, coalesce(g.metric, v.metric) AS metric, round("value", 6) AS "value", "bound", "threshold",
      round(CASE "bound" WHEN 'min' THEN "value" - "threshold" WHEN 'max' THEN "threshold" - "value" END, 6) AS margin,
      CASE WHEN "threshold" IS NULL THEN 'UNGATED' WHEN "value" IS NULL THEN 'MISSING'
        WHEN ("bound" = 'min' AND "value" >= "threshold") OR ("bound" = 'max' AND "value" <= "threshold") THEN 'PASS'
        ELSE 'FAIL' END AS "result"
    FROM g FULL JOIN v ON g.metric = v.metric""")
def _(t: Tables):
    """The numbers of two tables beside the thresholds of every environment."""
    delay = F.timestamp_diff("SECOND", F.col("event_timestamp"), F.col("processing_time"))
    n = F.count(F.lit(1))
    flowing = t.user_events.agg(
        (F.count_if(F.col("event_type") == "error") / n * 100).alias("data_error_rate"),
        (F.count_if(delay > 60) / n * 100).alias("late_data_percentage"),
        F.count_distinct("user_id").alias("active_users"),
    )
    tested = t.test_results.agg((F.count_if(F.col("status") == "PASSED") / n * 100).alias("test_success_rate"))
    return gates.join_thresholds([flowing, tested], gates.gates_by_environment(t.spark))


@query("gate_overall", f"""
    WITH {_EVALUATED}
    SELECT count(*) AS gates, count(*) FILTER ("result" <> 'PASS') AS failed,
      count(*) FILTER ("result" <> 'PASS' AND "blocking") AS blocking_failed,
      CASE WHEN bool_or("result" <> 'PASS' AND "blocking") THEN 'FAIL' ELSE 'PASS' END AS "result"
    FROM x""")
def _(t: Tables):
    return gates.overall(
        gates.evaluate(pipeline_metrics(t), gates.gate_table(t.spark, environment="development"))
    )


@query("quality_score", f"""
    WITH {_METRICS_SQL},
      c AS (SELECT 100.0 * count(*) FILTER (ran) / count(*) AS covered FROM (
        SELECT bool_or(status <> 'SKIPPED') AS ran FROM test_results GROUP BY test_name)),
      p AS (SELECT 100.0 * count(*) FILTER (date_sub('second', event_timestamp, processing_time) <= 5)
        / count(*) AS quick FROM user_events),
      d AS (SELECT 100.0 * count(component) / count(*) AS described FROM test_results),
      a AS (SELECT 100.0 * count(*) FILTER (expected_success = actual_success) / count(*) AS guarded
        FROM access_checks),
      s AS (SELECT (SELECT "value" FROM v WHERE metric = 'test_success_rate') * 40 + covered * 20
        + quick * 15 + guarded * 15 + described * 10 AS total FROM c, p, d, a)
    SELECT round(total / 100, 6) AS score, {_verdict('total / 100 >= 80')} AS "result",
      {_verdict('total / 100 >= 90')} AS main_branch_result FROM s""")
def _(t: Tables):
    """All five parts: tests passed, tests that ran, events processed within five seconds, access
    as expected, and results that name their component."""

    def share(part):
        return F.count_if(part) / F.count(F.lit(1)) * 100

    ran = t.test_results.groupBy("test_name").agg(F.bool_or(F.col("status") != "SKIPPED").alias("ran"))
    delay = F.timestamp_diff("SECOND", F.col("event_timestamp"), F.col("processing_time"))
    parts = [
        t.test_results.agg(
            share(F.col("status") == "PASSED").alias("test_success_rate"),
            share(F.col("component").isNotNull()).alias("documentation_score"),
        ),
        ran.agg(share(F.col("ran")).alias("code_coverage")),
        t.user_events.agg(share(delay <= 5).alias("performance_metrics")),
        t.access_checks.agg(
            share(F.col("expected_success") == F.col("actual_success")).alias("security_score")
        ),
    ]
    return gates.quality_score(reduce(DataFrame.unionByName, map(gates.long_metrics, parts)))


@query("perf_regression", """
    WITH p AS (SELECT event_timestamp >= (SELECT min(event_timestamp) + (max(event_timestamp)
            - min(event_timestamp)) / 2 FROM user_events) AS cur,
          CAST(json_extract_string(payload, '$.processing_time_ms') AS DOUBLE) AS ms FROM user_events),
      v AS (SELECT 'latency' AS metric, avg(ms) FILTER (cur) AS a, avg(ms) FILTER (NOT cur) AS b FROM p
        UNION ALL SELECT 'memory', NULL, NULL
        UNION ALL SELECT 'throughput', count(*) FILTER (cur), count(*) FILTER (NOT cur) FROM p)
    SELECT metric, round(a, 6) AS "value", round(b, 6) AS baseline, round((a - b) / b * 100, 6) AS change_pct,
      CASE metric WHEN 'throughput' THEN 'min' ELSE 'max' END AS "bound",
      CASE metric WHEN 'latency' THEN 10.0 WHEN 'memory' THEN 20.0 ELSE 0.0 END::DOUBLE AS limit_pct,
      CASE WHEN a IS NULL OR b IS NULL THEN 'MISSING' WHEN (metric = 'latency' AND (a - b) / b * 100 <= 10)
        OR (metric = 'throughput' AND (a - b) / b * 100 >= 0) THEN 'PASS' ELSE 'FAIL' END AS "result"
    FROM v""")
def _(t: Tables):
    """The second half of the time span against the first."""
    events = t.user_events
    bounds = events.agg(F.min("event_timestamp").alias("a"), F.max("event_timestamp").alias("b"))
    middle = bounds.select(F.col("a") + (F.col("b") - F.col("a")) / 2).scalar()
    ms = F.get_json_object("payload", "$.processing_time_ms").cast("double")

    def half(condition):
        m = events.where(condition).agg(
            F.avg(ms).alias("latency"), F.count(F.lit(1)).alias("throughput")
        )
        return gates.long_metrics(m)

    ts = F.col("event_timestamp")
    return gates.perf_regression(half(ts >= middle), half(ts < middle))


@query("dq_completeness", """
    SELECT count(*) AS total, count(*) FILTER (user_id IS NOT NULL AND user_name IS NOT NULL) AS complete,
      round(CAST(count(*) FILTER (user_id IS NOT NULL AND user_name IS NOT NULL) AS DOUBLE) / count(*)
        * 100, 6) AS completeness_pct,
      CASE WHEN count(user_name) >= 0.999 * count(*) THEN 'PASS' ELSE 'FAIL' END AS "result"
    FROM enriched_left""")
def _(t: Tables):
    return gates.completeness(t.enriched_left, ["user_id", "user_name"])


@query("dq_freshness", """
    SELECT max(event_timestamp) AS newest, max(processing_time) AS as_of,
      date_sub('second', max(event_timestamp), max(processing_time)) AS lag_seconds,
      CASE WHEN date_sub('second', max(event_timestamp), max(processing_time)) <= 300 THEN 'PASS'
        ELSE 'FAIL' END AS "result"
    FROM user_events""")
def _(t: Tables):
    return gates.freshness(t.user_events, "event_timestamp", F.col("processing_time"))


@query("referential_integrity", """
    SELECT count(*) AS events, count(c.c_custkey) AS with_user,
      round(CAST(count(c.c_custkey) AS DOUBLE) / count(*) * 100, 6) AS integrity_pct,
      CASE WHEN count(c.c_custkey) >= 0.995 * count(*) THEN 'PASS' ELSE 'FAIL' END AS "result"
    FROM events_of_strangers e LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def _(t: Tables):
    return gates.referential_integrity(t.events_of_strangers, t.users)


@query("sink_metrics", """
    SELECT 'user_enrichment_completeness' AS test_name,
      CASE WHEN count(*) = count(user_name) AND count(*) = count(user_email) THEN 'PASS' ELSE 'FAIL' END
        AS "result" FROM enriched
    UNION ALL SELECT 'join_accuracy_validation',
      CASE WHEN count(user_name) >= 0.95 * count(*) THEN 'PASS' ELSE 'FAIL' END FROM enriched_left""")
def _(t: Tables):
    """Check rows appended to the metrics table, read back."""
    path = t.scratch("metrics")
    rows = checks.union_checks(
        [checks.enrichment_completeness(t.enriched), checks.join_accuracy(t.enriched_left)],
        ["test_result", "join_test_result"],
    )
    sinks.append_metrics(rows, path)
    return t.spark.read.parquet(path).select("test_name", "result")


