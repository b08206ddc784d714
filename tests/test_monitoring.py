import json
import random

from helpers import at, rows
from pyspark.sql import functions as F

from eventloom.operators import flow, gates, monitoring, results


def logs(spark, data):
    rows_ = [(at(sec), source, json.dumps(raw) if isinstance(raw, dict) else raw) for sec, source, raw in data]
    return spark.createDataFrame(rows_, "ts timestamp_ntz, source_category string, raw string")


def test_checkpoint_failures_above_the_default_limit(spark):
    failed = {"job_name": "j", "checkpoint_status": "FAILED"}
    data = [(i, "kafka/flink", failed) for i in (0, 100, 200, 599)] + [(600, "kafka/flink", failed)]
    assert rows(monitoring.checkpoint_failure_alert(logs(spark, data))) == [("j", at(0), 4)]


def test_lag_alert_reads_dotted_key_and_category_pattern(spark):
    def line(lag):
        return {"consumer.lag": lag, "consumer_group": "g", "topic": "t"}

    data = [
        (0, "kafka/dev/metrics", line(10001)), (1, "kafka/prod/metrics", line("20000")),
        (2, "kafka/dev/metrics", line(10000)), (3, "kafka/dev/logs", line(99999)),
        (4, "kafka/dev/metrics", "{broken"), (400, "kafka/dev/metrics", line(10001)),
    ]
    out = monitoring.consumer_lag_alert(logs(spark, data))
    assert rows(out) == [(at(0), "g", "t", 2, True), (at(300), "g", "t", 1, False)]


def test_period_compare_ignores_gaps(spark):
    series = spark.createDataFrame([(at(0), 10.0), (at(7200), 4.0), (at(10800), 1.0)], "b timestamp_ntz, v double")
    out = monitoring.period_compare(series, "b", "v", 1)
    assert rows(out) == [(at(10800), 1.0, 4.0, -75.0)]


def test_cooldown_against_a_loop(spark):
    rnd = random.Random(3)
    fired = [(f"r{rnd.randint(0, 2)}", rnd.randint(0, 200) * 60) for _ in range(300)]
    expected = []
    for rule in {r for r, _ in fired}:
        last = None
        for sec in sorted({s for r, s in fired if r == rule}):
            if last is None or sec >= last + 900:
                expected.append((rule, at(sec)))
                last = sec
    alerts = spark.createDataFrame([(r, at(s)) for r, s in fired], "rule string, fired_at timestamp_ntz")
    assert rows(monitoring.cooldown(alerts, max_per_hour=None)) == sorted(expected, key=repr)
    first, second = alerts.where("fired_at < '2024-01-01 01:40:00'"), alerts.where("fired_at >= '2024-01-01 01:40:00'")
    sent = monitoring.cooldown(first, max_per_hour=None)
    last = sent.groupBy("rule").agg(F.max("fired_at").alias("last_sent"))
    more = monitoring.cooldown(second, max_per_hour=None, last_sent=last)
    assert rows(sent.unionByName(more)) == sorted(expected, key=repr)


def test_hourly_cap_over_all_rules(spark):
    alerts = spark.createDataFrame([(f"r{i:02d}", at(i)) for i in range(30)], "rule string, fired_at timestamp_ntz")
    out = rows(monitoring.cooldown(alerts))
    assert [r for r, _ in out] == [f"r{i:02d}" for i in range(20)]


def test_suppression(spark):
    data = [("dev", "info", 12), ("dev", "critical", 12), ("prod", "warning", 2), ("prod", "warning", 6),
            ("prod", "critical", 3), ("prod", "info", 3)]
    alerts = spark.createDataFrame([(e, s, at(3600 * h)) for e, s, h in data],
                                   "environment string, severity string, fired_at timestamp_ntz")
    kept = {(r.environment, r.severity, r.fired_at.hour) for r in monitoring.suppress(alerts).collect()}
    assert kept == {("dev", "critical", 12), ("prod", "warning", 6), ("prod", "critical", 3), ("prod", "info", 3)}


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(v,) for v in (0.1, 1.0, 1.5, 99.0, None)], "v double")
    out = monitoring.histogram(df, F.col("v"), [0.5, 1, 10])
    assert [tuple(r) for r in out.collect()] == [("0.5", 1), ("1", 2), ("10", 3), ("+Inf", 4)]


def results_table(spark, data):
    full = [(t, "s", status, float(d), at(sec), msg, None, "dev", None) for t, status, d, sec, msg in data]
    return spark.createDataFrame(
        full,
        "test_name string, test_suite string, status string, duration double, timestamp timestamp_ntz, "
        "error_message string, error_type string, environment string, component string",
    )


def test_trend_of_one_day_is_zero_and_latest_error_is_newest(spark):
    table = results_table(spark, [("a", "FAILED", 1, 10, "new"), ("a", "FAILED", 3, 5, "old"), ("a", "PASSED", 2, 0, None)])
    row = results.trends(table).first()
    assert row.success_rate_trend == 0.0 and row.average_duration == 2.0
    top = results.top_failing_tests(table).first()
    assert (top.failure_count, top.latest_error) == (2, "new")
    assert results.flaky_tests(table).count() == 0
    score = results.flaky_tests(table, min_executions=3).first().flaky_score
    assert round(score, 9) == 33.333333333
    patterns = rows(results.failure_patterns(table))
    assert patterns == [("component", "Unknown", 2), ("error_type", "Unknown", 2)]
    locked = results.flaky_quarantine(table).first()
    assert locked.quarantined_until == at(10 + 7 * 86400)


def test_slope(spark):
    series = spark.createDataFrame([(i, float(3 * i + 1)) for i in range(5)], "d int, v double")
    row = results.linear_trend(series, "d", ["v"]).first()
    assert (row.v_trend, row.average_v) == (3.0, 7.0)


def test_summary_of_nothing(spark):
    row = results.summary(results_table(spark, [])).first()
    assert (row.total_tests, row.success_rate, row.average_duration) == (0, 0.0, 0.0)


def test_health_and_critical_suites(spark):
    checks = spark.createDataFrame([("PASS", True), ("FAIL", False)], "status string, critical boolean")
    assert results.health_rollup(checks).first().overall_status == "WARNING"
    assert results.health_rollup(checks.where("status = 'PASS'")).first().overall_status == "HEALTHY"
    bad = checks.unionByName(spark.createDataFrame([(None, True)], checks.schema))
    assert results.health_rollup(bad).first().overall_status == "CRITICAL"
    suites = spark.createDataFrame([("a", "PASSED"), ("b", "PASSED")], "test_suite string, status string")
    assert results.critical_suites_gate(suites, ["a"]).first().gate_result == "PASS"
    assert results.critical_suites_gate(suites, ["a", "missing"]).first().gate_result == "FAIL"


def test_ordering_equals_a_loop(spark):
    rnd = random.Random(5)
    data = [(rnd.randint(0, 2), rnd.randint(0, 5000), i) for i in range(200)]
    df = spark.createDataFrame([(k, at(s), q) for k, s, q in data], "k int, t timestamp_ntz, q int")
    expected = []
    for key in (0, 1, 2):
        seq = [q for _, q in sorted((s, q) for k, s, q in data if k == key)]
        falls = sum(b < a for a, b in zip(seq, seq[1:], strict=False))
        expected.append((key, len(seq), falls, "FAIL"))
    for slot in (3600, 60, 1):
        assert rows(flow.ordering(df, "k", "q", "t", slot_seconds=slot)) == expected


def test_integrity_sees_every_kind(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    sink = spark.createDataFrame([(1, "a"), (1, "a"), (2, "x"), (4, "d")], "id int, v string")
    row = flow.integrity(source, sink, "id", ["v"]).first()
    assert (row.missing, row.unexpected, row.changed, row.result) == (1, 1, 1, "FAIL")
    assert flow.integrity(source, source, "id", ["v"]).first().result == "PASS"


def test_gates(spark):
    metrics = spark.createDataFrame([("test_success_rate", 92.0), ("flaky_test_rate", 9.0), ("other", 1.0)],
                                    "metric string, value double")
    for environment, verdict in (("development", "PASS"), ("production", "FAIL")):
        out = gates.evaluate(metrics, gates.gate_table(spark, environment=environment))
        found = {r.metric: r.result for r in out.collect()}
        given = {m: found.pop(m) for m in ("test_success_rate", "flaky_test_rate")}
        assert given == {"test_success_rate": verdict, "flaky_test_rate": "FAIL"}
        assert set(found.values()) == {"MISSING"} and "other" not in found
        assert gates.overall(out).first().result == "FAIL"  # blocking metrics are missing
    scores = spark.createDataFrame([(m, 85.0) for m in gates.SCORE_WEIGHTS], "metric string, value double")
    row = gates.quality_score(scores).first()
    assert (row.score, row.result, row.main_branch_result) == (85.0, "PASS", "FAIL")


def test_cooldown_over_slots_with_a_hot_rule(spark):
    rnd = random.Random(5)
    fired = [("hot", rnd.randint(0, 4 * 86400)) for _ in range(1500)]
    fired += [(f"r{rnd.randint(0, 9)}", rnd.randint(0, 4 * 86400)) for _ in range(300)]
    # Around midnight, where a pause reaches into the next slot.
    fired += [("edge", 86400 * d + s) for d in (1, 2, 3) for s in (-901, -900, -899, -1, 0, 1, 898, 899, 900, 901)]
    alerts = spark.createDataFrame([(r, at(s)) for r, s in fired], "rule string, fired_at timestamp_ntz")
    for minutes in (15, 60 * 30):
        expected = []
        for rule in {r for r, _ in fired}:
            last = None
            for sec in sorted({s for r, s in fired if r == rule}):
                if last is None or sec >= last + 60 * minutes:
                    expected.append((rule, at(sec)))
                    last = sec
        assert rows(monitoring.cooldown(alerts, minutes, max_per_hour=None)) == sorted(expected, key=repr)
