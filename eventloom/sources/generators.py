"""Seeded record generators for load tests. Each row depends on its id and the seed only, so
any partition can be rebuilt on its own after an executor is lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the generated records.
EVENT_TYPES = ("login", "logout", "purchase", "view", "click")
BROWSERS = ("Chrome", "Firefox", "Safari", "Edge")
PLATFORMS = ("web", "mobile", "desktop")
VERSIONS = ("1.0.0", "1.1.0", "2.0.0")


def _pick(choices: Sequence[str], salt: int, seed: int) -> Column:
    index = _draw(len(choices), salt, seed)
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (index + 1).cast("int"))


def _draw(bound: int, salt: int, seed: int) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(salt), F.lit(seed)), F.lit(bound))


def user_events(
    spark: SparkSession,
    users: int = 1000,
    events_per_user: int = 100,
    hours: int = 24,
    late_pct: float = 5,
    error_pct: float = 1,
    seed: int = 42,
    start: str = "2024-01-01 00:00:00",
    partitions: int | None = None,
) -> DataFrame:
    """Events of many users over a time span; some arrive late, some have a broken payload."""
    span = hours * 3600 * 1_000_000
    base = F.lit(start).cast("timestamp")
    ts = F.timestamp_add("MICROSECOND", _draw(span, 1, seed), base)
    late = _draw(10_000, 2, seed) < int(late_pct * 100)
    broken = _draw(10_000, 3, seed) < int(error_pct * 100)
    amount = (_draw(100_000, 4, seed) / 100).cast("decimal(10,2)")
    payload = F.concat(
        F.lit('{"amount": '), amount.cast("string"), F.lit(', "product_id": "p'),
        _draw(500, 5, seed).cast("string"), F.lit('", "processing_time_ms": '),
        _draw(250, 6, seed).cast("string"), F.lit("}"),
    )
    user = (F.col("id") % users).cast("bigint")
    rows = spark.range(0, users * events_per_user, 1, partitions or spark.sparkContext.defaultParallelism)
    delay = F.when(late, 60 + _draw(240, 7, seed)).otherwise(_draw(5, 8, seed))
    return rows.select(
        F.col("id").alias("event_id"),
        F.concat(F.lit("user_"), (user + 1).cast("string")).alias("user_id"),
        _pick(EVENT_TYPES, 9, seed).alias("event_type"),
        ts.alias("event_timestamp"),
        F.concat(
            F.lit("session_"), (user + 1).cast("string"), F.lit("_"),
            F.date_format(ts, "yyyyMMddHH"),
        ).alias("session_id"),
        F.when(broken, F.lit("{broken")).otherwise(payload).alias("payload"),
        F.timestamp_add("SECOND", delay, ts).alias("processing_time"),
    )


def messages(
    spark: SparkSession, count: int, run_id: str = "test", seed: int = 42,
    start: str = "2024-01-01 00:00:00", partitions: int | None = None,
) -> DataFrame:
    """End-to-end test messages with nested properties."""
    at = F.timestamp_add("MICROSECOND", F.col("id") * 1000, F.lit(start).cast("timestamp"))
    rows = spark.range(1, count + 1, 1, partitions or spark.sparkContext.defaultParallelism)
    return rows.select(
        F.col("id").cast("string").alias("id"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.concat(F.lit("user_"), (_draw(1000, 1, seed) + 1).cast("string")).alias("user_id"),
        _pick(EVENT_TYPES, 2, seed).alias("event_type"),
        F.concat(F.lit("session_"), F.col("id").cast("string")).alias("session_id"),
        F.struct(
            _pick(BROWSERS, 3, seed).alias("browser"),
            _pick(PLATFORMS, 4, seed).alias("platform"),
            _pick(VERSIONS, 5, seed).alias("version"),
        ).alias("properties"),
        _draw(1000, 6, seed).cast("int").alias("value"),
        F.lit(run_id).alias("test_run_id"),
    )


def transform_records(spark: SparkSession, scenario: str, count: int = 1000) -> DataFrame:
    """Records for the rename and cast performance runs."""
    rows, i = spark.range(1, count + 1), F.col("id")
    if scenario == "field_renaming":
        return rows.select(
            F.concat(F.lit("user"), i.cast("string")).alias("user_name"),
            F.concat(F.lit("user"), i.cast("string"), F.lit("@example.com")).alias("user_email"),
            (20 + i % 50).alias("user_age"),
        )
    if scenario == "data_type_conversion":
        return rows.select(
            i.cast("string").alias("user_id"),
            (1692144000 + i).cast("string").alias("timestamp"),
            F.lit("true").alias("active"),
            F.concat((90 + i % 10).cast("string"), F.lit(".5")).alias("score"),
        )
    raise ValueError(f"unknown scenario {scenario!r}")


def json_events(spark: SparkSession, count: int) -> DataFrame:
    """Valid UserEvent lines for the format performance run."""
    i = F.col("id")
    return spark.range(1, count + 1).select(
        F.concat(
            F.lit('{"user_id":"user'), i.cast("string"),
            F.lit('","event_type":"LOGIN","timestamp":'),
            (1692144000000 + i * 1000).cast("string"),
            F.lit(',"properties":{"test":"data"},"session_id":"sess'), i.cast("string"),
            F.lit('"}'),
        ).alias("value")
    )


def event_rate_stream(spark: SparkSession, rows_per_second: int = 1000, users: int = 1000) -> DataFrame:
    """An endless stream of the same shape, for soak tests."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    rows = rate.withColumnRenamed("value", "id")
    return rows.select(
        F.col("id").alias("event_id"),
        F.concat(F.lit("user_"), (F.col("id") % users).cast("string")).alias("user_id"),
        _pick(EVENT_TYPES, 1, 42).alias("event_type"),
        F.col("timestamp").alias("event_timestamp"),
        F.concat(F.lit("session_"), (F.col("id") % users).cast("string")).alias("session_id"),
        F.concat(F.lit('{"amount": '), _draw(1000, 2, 42).cast("string"), F.lit("}")).alias("payload"),
        F.col("timestamp").alias("processing_time"),
    )
