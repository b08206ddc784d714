"""Gates that cannot vanish, part seconds, consumer groups, and a driver in another zone."""

import os
import time
from datetime import timedelta

import pytest
from helpers import START, at, rows
from pyspark.sql import functions as F

from eventloom.operators import flow, gates, monitoring
from eventloom.streaming import jobs


def test_a_missing_blocking_metric_fails_the_whole(spark):
    table = gates.gate_table(spark)
    good = {m: t for m, _, t, _ in gates.PIPELINE_GATES}
    blocking = [m for m, _, _, b in gates.PIPELINE_GATES if b]
    for left_out, want in ((None, "PASS"), (blocking[0], "FAIL"), ("flaky_test_rate", "PASS")):
        values = [(m, v) for m, v in good.items() if m != left_out]
        out = gates.evaluate(spark.createDataFrame(values, "metric string, value double"), table)
        found = {r["metric"]: r["result"] for r in out.collect()}
        assert len(found) == len(good) and (left_out is None or found[left_out] == "MISSING")
        assert gates.overall(out).first()["result"] == want


def test_a_metric_without_a_pair_is_missing(spark):
    now = spark.createDataFrame([("latency", 100.0), ("throughput", 5.0)], "metric string, value double")
    before = spark.createDataFrame([("latency", 99.0)], "metric string, value double")
    found = {r["metric"]: r["result"] for r in gates.perf_regression(now, before).collect()}
    assert found == {"latency": "PASS", "memory": "MISSING", "throughput": "MISSING"}


def test_a_rule_without_a_value_stays(spark):
    rules = spark.createDataFrame(
        [("a", "GreaterThan", 1.0, "info"), ("b", "GreaterThan", 1.0, "info")],
        "rule string, comparison string, threshold double, severity string",
    )
    values = spark.createDataFrame([("a", 2.0)], "rule string, value double")
    found = {r["rule"]: r["fires"] for r in monitoring.evaluate_rules(values, rules).collect()}
    assert found == {"a": True, "b": None}


def test_part_seconds_count(spark):
    data = [(1, at(0), at(30.9)), (2, at(0), at(30)), (3, at(0), at(5.9)), (4, at(0), at(5))]
    df = spark.createDataFrame(data, "event_id bigint, event_timestamp timestamp_ntz, processing_time timestamp_ntz")
    assert flow.delivery_sla(df, "event_timestamp", "processing_time").first()["within_sla"] == 3
    late = flow.late_split(df).where("is_late").select("event_id")
    assert rows(late) == [(1,), (2,), (3,)]


def test_every_group_lags_on_every_partition(spark):
    produced = spark.createDataFrame([(0, 9), (1, 19)], "partition int, offset bigint")
    committed = spark.createDataFrame([("a", 0, 4), ("b", 0, 9), ("b", 1, 10)], "consumer_group string, partition int, committed bigint")
    found = flow.consumer_lag(produced, committed).select("consumer_group", "partition", "lag")
    assert rows(found) == [("a", 0, 5), ("a", 1, 20), ("b", 0, 0), ("b", 1, 9)]


def test_all_partitions_lag_without_commits(spark):
    produced = spark.createDataFrame([(0, 9), (1, 19)], "partition int, offset bigint")
    committed = spark.createDataFrame([], "consumer_group string, partition int, committed bigint")
    found = flow.consumer_lag(produced, committed).select("consumer_group", "partition", "lag")
    assert rows(found) == [(None, 0, 10), (None, 1, 20)]


def test_category_names_may_hold_wildcards(spark):
    df = spark.createDataFrame([("a_b/x",), ("acb/x",), ("a%/x",)], "source_category string")
    assert rows(df.where(monitoring.category("a_b/*"))) == [("a_b/x",)]
    assert rows(df.where(monitoring.category("a%/*"))) == [("a%/x",)]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_anomaly_stream_in_a_drivers_zone(spark, tmp_path, zone):
    before = os.environ.get("TZ")
    os.environ["TZ"] = zone
    time.tzset()
    try:
        write = jobs.anomaly_writer(spark, str(tmp_path / "job"))
        schema = "event_id bigint, user_id bigint, event_timestamp timestamp_ntz, event_type string, payload string"
        for batch in range(6):
            data = [(h, 1, START + timedelta(hours=h), "view", None) for h in range(batch * 8, batch * 8 + 8)]
            write(spark.createDataFrame(data, schema).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")), batch)
        judged = spark.read.parquet(str(tmp_path / "job" / "flagged")).select("event_id")
        assert sorted(r[0] for r in rows(judged)) == list(range(47))  # the last is ahead of the watermark
    finally:
        if before is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = before
        time.tzset()


def test_flow_tables_are_cut_by_the_size_of_their_files(spark, tmp_path, monkeypatch):
    """Tasks of the join, and of what is grouped by its key, stay of one size whatever the table's."""
    from eventloom.sources import testdata

    path = f"{tmp_path}/events.parquet"
    data = spark.range(5000).selectExpr(
        "nullif(id % 4000, 7) AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 50 AS user_id",
        "'view' AS event_type", "CAST(id AS DOUBLE) AS value", "'{\"k\": 1}' AS props",
    )
    data.repartition(4).write.parquet(path)
    assert testdata._parts_of(spark, path) == 1 and testdata._parts_of(spark, path, mb=1 << 30) == 1
    whole = sorted(tuple(r) for r in testdata.flow_sink(spark, str(tmp_path)).collect())
    monkeypatch.setattr(testdata, "_parts_of", lambda _spark, _path: 37)
    cut = testdata.flow_sink(spark, str(tmp_path))
    assert "37), REPARTITION_BY_NUM" in cut._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in cut.collect()) == whole
