"""Canonical input tables derived from the TPC-H-like test tables (whole tables, no subsets)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.exprs import json_value, micros
from eventloom.session import configure

START = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _start():
    return F.lit(START).cast("timestamp_ntz")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(raw_events(spark, sf_dir))


def raw_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a stream."""
    schema = raw_events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")


def events_of(raw: DataFrame) -> DataFrame:
    """The user event stream, from a table or a stream of raw events."""
    amount = (F.col("value").cast("decimal(10,2)") * 10).cast("decimal(10,2)")
    payload = F.concat(
        F.lit('{"amount": '), amount.cast("string"),
        F.lit(', "product_id": "p'), json_value("props", "$.k"),
        F.lit('", "processing_time_ms": '), (F.col("event_id") % 250).cast("string"), F.lit("}"),
    )
    delay = F.when(F.col("event_id") % 100 == 0, 120).otherwise(F.col("event_id") % 5)
    return raw.select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") == "signup", "login").otherwise(F.col("event_type"))
        .alias("event_type"),
        F.col("ts").alias("event_timestamp"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd"))
        .alias("session_id"),
        payload.alias("payload"),
        F.timestamp_add("SECOND", delay, F.col("ts")).alias("processing_time"),
    )


def dense(events: DataFrame) -> DataFrame:
    """The same events with their 30 days squeezed into about eleven minutes."""
    offset = micros("event_timestamp") - micros(_start())
    squeezed = F.timestamp_add(
        "MICROSECOND", F.call_function("div", offset, F.lit(4000).cast("bigint")), _start()
    )
    return events.withColumn("event_timestamp", squeezed)


def user_events_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense(user_events(spark, sf_dir))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions per customer; every tenth customer lacks the first one."""
    key = F.col("c_custkey")
    later = F.when(F.col("ver") == 1, 1 + key % 28).otherwise(F.lit(0).cast("bigint"))
    tier = (key + F.col("ver")) % 3
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        customers.withColumn("ver", F.explode(F.array(F.lit(0), F.lit(1))))
        .where(~((key % 10 == 9) & (F.col("ver") == 0)))
        .select(
            key.alias("user_id"),
            "ver",
            F.timestamp_add("DAY", later, _start()).alias("valid_from"),
            F.col("c_name").alias("user_name"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
            .alias("user_email"),
            F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int"))
            .alias("registration_date"),
            F.when(tier == 0, "premium").when(tier == 1, "gold").otherwise("basic")
            .alias("user_tier"),
            F.col("n_name").alias("country"),
            (10 + key % 60).alias("age"),
        )
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ts, source_category, environment, raw)``: metrics, connector and job log lines."""
    raw = raw_events(spark, sf_dir)
    value = F.col("value").cast("decimal(10,2)")
    failed = F.col("event_type") == "error"
    status = F.when(failed, "FAILED").otherwise("RUNNING")
    kind = F.col("event_id") % 3

    def line(*parts):
        return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])

    metrics = line(
        '{"consumer.lag": ', F.round(F.col("value") * 40).cast("bigint").cast("string"),
        ', "consumer_group": "g', (F.col("user_id") % 3).cast("string"),
        '", "topic": "', F.col("event_type"),
        '", "throughput": ', value.cast("string"), ', "partitions": 6}',
    )
    connectors = line(
        '{"connector_name": "c', (F.col("user_id") % 20).cast("string"),
        '", "status": "', status,
        '", "level": "', F.when(failed, "ERROR").otherwise("INFO"), '"}',
    )
    jobs = line(
        '{"job_name": "j', (F.col("user_id") % 4).cast("string"),
        '", "job_id": ', F.col("user_id").cast("string"),
        ', "job_status": "', status,
        '", "checkpoint_status": "', F.when(failed, "FAILED").otherwise("COMPLETED"),
        '", "processing_latency": ', (value / 100).cast("decimal(10,4)").cast("string"),
        ', "checkpoint_duration": ', (value / 10).cast("decimal(10,3)").cast("string"), "}",
    )
    return raw.select(
        "ts",
        F.when(kind == 0, "kafka/dev/metrics").when(kind == 1, "kafka/connectors")
        .otherwise("kafka/flink").alias("source_category"),
        F.when(kind == 0, metrics).when(kind == 1, connectors).otherwise(jobs).alias("raw"),
    )


def test_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.col("event_id") % 3
    failed = F.col("event_type") == "error"
    status = (
        F.when(F.col("event_id") % 17 == 0, "SKIPPED").when(failed, "FAILED").otherwise("PASSED")
    )
    return raw_events(spark, sf_dir).select(
        F.concat(F.lit("test_"), F.col("user_id").cast("string")).alias("test_name"),
        F.concat(F.lit("suite_"), (F.col("user_id") % 5).cast("string")).alias("test_suite"),
        status.alias("status"),
        F.col("value").cast("decimal(10,2)").alias("duration"),
        F.col("ts").alias("timestamp"),
        F.when(status == "FAILED", F.concat(F.lit("err "), F.col("event_id").cast("string")))
        .alias("error_message"),
        F.when(third == 0, "Failure").when(third == 1, "Error").alias("error_type"),
        F.when(third == 0, "dev").when(third == 1, "staging").otherwise("prod")
        .alias("environment"),
        F.when(
            F.col("user_id") % 7 != 0,
            F.concat(F.lit("comp_"), (F.col("user_id") % 4).cast("string")),
        ).alias("component"),
    )


def spread(events: DataFrame, path: str, mb: int = 4) -> DataFrame:
    """Raw events in tasks of about equal size, one per so many megabytes of their files at ``path``:
    a file is read by as many tasks as it has row groups, which may be few and uneven."""
    parts = _parts_of(events.sparkSession, path, mb)
    return events.repartition(parts, "event_id") if parts > 1 else events


def flow_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Produced records. ``event_id`` rises with time, so it serves as the partition's offset."""
    events = user_events(spark, sf_dir).drop("payload")
    raw = raw_events(spark, sf_dir).select("event_id", "value")
    parts = _parts_of(spark, f"{sf_dir}/events.parquet")
    if parts > 1:
        # Both sides of the join, and what is grouped by its key after it, in tasks of a bounded size.
        events, raw = (side.repartition(parts, "event_id") for side in (events, raw))
    return _flow(events, raw)


def _parts_of(spark: SparkSession, path: str, mb: int = 2) -> int:
    """Partitions for a table, one per so many megabytes of its compressed files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return -(-size // (mb << 20))


def _flow(events: DataFrame, values: DataFrame) -> DataFrame:
    return events.join(values, "event_id").select(
        "event_id",
        "user_id",
        "event_type",
        "event_timestamp",
        F.col("value").cast("decimal(10,2)").alias("value"),
        F.col("processing_time").alias("delivered_at"),
        (F.col("user_id") % 6).alias("partition"),
        F.col("event_id").alias("offset"),
    )


def flow_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered records: some lost, some doubled, some changed."""
    key = F.col("event_id")
    copies = F.when(key % 991 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = F.when(key % 983 == 0, F.col("value") + 1).otherwise(F.col("value"))
    return (
        flow_source(spark, sf_dir)
        .where(key % 997 != 0)
        .withColumn("value", changed.cast("decimal(10,2)"))
        .withColumn("_copy", F.explode(copies))
        .drop("_copy")
    )


def committed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        flow_source(spark, sf_dir)
        .groupBy("partition")
        .agg(F.max("offset").alias("_max"))
        .select(
            F.lit("group_a").alias("consumer_group"),
            "partition",
            (F.col("_max") - F.col("partition") * 3).alias("committed"),
        )
    )


def transform_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text records for the per-record transforms, with some unparsable ids."""
    key = F.col("c_custkey")
    email = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
    user_id = F.when(key % 101 == 0, "bad").otherwise(key.cast("string"))
    return table(spark, sf_dir, "customer").select(
        key.alias("record_id"),
        F.col("c_name").alias("user_name"),
        email.alias("user_email"),
        user_id.alias("user_id"),
        F.when(key % 2 == 0, "true").otherwise("false").alias("active"),
        F.col("c_acctbal").cast("decimal(10,2)").cast("string").alias("score"),
        (1692144000 + key).cast("string").alias("login_time"),
        F.struct(
            user_id.alias("user_id"),
            F.struct(F.col("c_name").alias("name"), email.alias("email")).alias("details"),
        ).alias("nested"),
    )


def json_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per event, ``(event_id, value)``; a fixed share breaks one rule each."""
    key = F.col("event_id")
    ms = F.call_function("div", micros("ts"), F.lit(1000).cast("bigint")).cast("string")
    kind = (
        F.when(F.col("event_type") == "signup", "LOGIN")
        .when(F.col("event_type") == "error", "INVALID_TYPE")
        .otherwise(F.upper("event_type"))
    )
    user = F.concat(F.lit('"user'), F.col("user_id").cast("string"), F.lit('"'))
    text = F.concat(
        F.lit('{"user_id": '), F.when(key % 41 == 0, F.lit('""')).otherwise(user),
        F.lit(', "event_type": "'), kind, F.lit('", "timestamp": '),
        F.when(key % 37 == 0, F.lit("-1"))
        .when(key % 43 == 0, F.lit('"late"'))
        .when(key % 47 == 0, F.lit("0"))
        .otherwise(ms),
        F.lit(', "properties": {"k": '),
        F.when(key % 31 == 0, F.lit("7")).otherwise(F.lit('"7"')), F.lit("}"),
        F.when(key % 29 == 0, F.lit(', "extra": 1'))
        .when(key % 23 == 0, F.lit(', "session_id": null'))
        .otherwise(F.lit(', "session_id": "s1"')),
        F.when(key % 53 == 0, F.lit("")).otherwise(F.lit("}")),
    )
    return raw_events(spark, sf_dir).select("event_id", text.alias("value"))


def csv_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text rows as a CSV reader gives them."""
    key = F.col("event_id")
    ms = F.call_function("div", micros("ts"), F.lit(1000).cast("bigint")).cast("string")
    return raw_events(spark, sf_dir).select(
        "event_id",
        F.when(key % 41 != 0, F.concat(F.lit("user"), F.col("user_id").cast("string")))
        .alias("user_id"),
        F.when(key % 59 == 0, "").otherwise(F.upper("event_type")).alias("event_type"),
        F.when(key % 37 == 0, "-1").when(key % 43 == 0, "late").otherwise(ms).alias("timestamp"),
        F.col("props").alias("properties"),
        F.lit("s1").alias("session_id"),
    )


def events_of_strangers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, but every ninetieth user is unknown."""
    user = F.col("user_id")
    return user_events(spark, sf_dir).withColumn("user_id", F.when(user % 90 == 0, -user).otherwise(user))


def xml_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``<event>`` element per event, ``(event_id, value)``; a fixed share breaks one rule each."""
    key = F.col("event_id")
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    kind = F.when(F.col("event_type") == "signup", "LOGIN").otherwise(F.upper("event_type"))
    text = F.concat(
        F.lit("<event><session_id>"), key.cast("string"), F.lit("</session_id><user_id>"),
        F.when(key % 41 == 0, F.lit("")).otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"))),
        F.lit("</user_id><event_type>"), kind, F.lit("</event_type><timestamp>"),
        F.when(key % 37 == 0, F.lit("-1")).when(key % 43 == 0, F.lit("late")).otherwise(ms),
        # An element that is never closed: the record does not parse.
        F.when(key % 53 == 0, F.lit("</event>")).otherwise(F.lit("</timestamp></event>")),
    )
    return raw_events(spark, sf_dir).select("event_id", text.alias("value"))


def access_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected against actual access, one row per event."""
    key = F.col("event_id")
    return raw_events(spark, sf_dir).select(
        F.concat(F.lit("sa_"), (F.col("user_id") % 10).cast("string")).alias("service_account"),
        F.col("event_type").alias("operation"),
        (key % 3 != 0).alias("expected_success"),
        ((key % 3 != 0) != (key % 19 == 0)).alias("actual_success"),
    )
