"""Threshold gates over metrics in long form ``(metric, value)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.exprs import percent, verdict

# Gates as (metric, min or max, threshold, blocking), and what an environment
# sets differently.
PIPELINE_GATES = (
    ("data_completeness", "min", 99.9, True),
    ("data_error_rate", "max", 0.1, True),
    ("join_success_rate", "min", 95.0, True),
    ("late_data_percentage", "max", 5.0, True),
    ("throughput_events_per_second", "min", 1000.0, False),
    ("processing_latency_seconds", "max", 5.0, False),
    ("test_success_rate", "min", 95.0, True),
    ("flaky_test_rate", "max", 5.0, False),
)
ENVIRONMENT_GATES = {
    "development": {"test_success_rate": 90.0},
    "staging": {"test_success_rate": 95.0},
    "production": {"test_success_rate": 99.0},
}
SCORE_WEIGHTS = {
    "test_success_rate": 40,
    "code_coverage": 20,
    "performance_metrics": 15,
    "security_score": 15,
    "documentation_score": 10,
}
# Largest allowed change in percent against the baseline; "min" bounds a fall.
REGRESSION_LIMITS = (("latency", "max", 10.0), ("memory", "max", 20.0), ("throughput", "min", 0.0))


def gate_table(
    spark: SparkSession,
    gates: Sequence[tuple[str, str, float, bool]] = PIPELINE_GATES,
    environment: str | None = None,
    overrides: Mapping[str, Mapping[str, float]] = ENVIRONMENT_GATES,
) -> DataFrame:
    changed = overrides[environment] if environment else {}
    rows = [(m, op, float(changed.get(m, t)), b) for m, op, t, b in gates]
    return spark.createDataFrame(
        rows, "metric string, bound string, threshold double, blocking boolean"
    )


def holds(value: Column, bound: Column, threshold: Column) -> Column:
    return F.when(bound == "min", value >= threshold).when(bound == "max", value <= threshold)


def long_metrics(metrics: DataFrame) -> DataFrame:
    """One row of named numbers -> ``(metric, value)`` rows."""
    rows = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in metrics.columns
    ]
    return metrics.select(F.inline(F.array(*rows)))


def evaluate(metrics: DataFrame, gates: DataFrame) -> DataFrame:
    """PASS, FAIL or, for a gate without a metric, MISSING. Gates are a few configured rows."""
    ok = holds(F.col("value"), F.col("bound"), F.col("threshold"))
    result = F.when(F.col("value").isNull(), "MISSING").otherwise(verdict(ok))
    return gates.join(metrics, "metric", "left").select(
        "metric", "value", "bound", "threshold", "blocking", result.alias("result")
    )


def gates_by_environment(
    spark: SparkSession, environments: Sequence[str | None] = (None, *ENVIRONMENT_GATES), **options
) -> DataFrame:
    """The thresholds of several environments in one table; None stands for the defaults."""
    tables = [
        gate_table(spark, environment=e, **options).withColumn("environment", F.lit(e or "default"))
        for e in environments
    ]
    return reduce(DataFrame.unionByName, tables)


def join_thresholds(metrics: Sequence[DataFrame], gates: DataFrame) -> DataFrame:
    """Every measured number beside every threshold that is set for it, whatever environment sets it.

    ``metrics`` are tables of one row of named numbers; a number that none of them has gives
    a row without a value, and one without a threshold is reported as UNGATED.
    """
    measured = reduce(DataFrame.unionByName, map(long_metrics, metrics))
    ok = holds(F.col("value"), F.col("bound"), F.col("threshold"))
    result = (
        F.when(F.col("threshold").isNull(), "UNGATED").when(F.col("value").isNull(), "MISSING").otherwise(verdict(ok))
    )
    margin = F.when(F.col("bound") == "min", F.col("value") - F.col("threshold")).otherwise(
        F.col("threshold") - F.col("value")
    )
    return gates.join(measured, "metric", "full").select(
        "environment", "metric", "value", "bound", "threshold", margin.alias("margin"), result.alias("result")
    )


def overall(evaluated: DataFrame) -> DataFrame:
    """A blocking gate that is not passed, be it failed or missing, fails the whole."""
    failed = F.col("result") != "PASS"
    return evaluated.agg(
        F.count(F.lit(1)).alias("gates"),
        F.count_if(failed).alias("failed"),
        F.count_if(failed & F.col("blocking")).alias("blocking_failed"),
    ).withColumn("result", verdict(F.col("blocking_failed") == 0))


def quality_score(
    scores: DataFrame, weights: Mapping[str, int] = SCORE_WEIGHTS, passing: float = 80,
    main_branch: float = 90,
) -> DataFrame:
    """Weighted mean of ``(metric, value)`` scores out of 100; an absent component scores 0."""
    weight = F.coalesce(
        *[F.when(F.col("metric") == m, F.lit(float(w))) for m, w in weights.items()], F.lit(0.0)
    )
    total = float(sum(weights.values()))
    m = scores.agg((F.coalesce(F.sum(F.col("value") * weight), F.lit(0.0)) / total).alias("score"))
    return m.select(
        "score",
        verdict(F.col("score") >= passing).alias("result"),
        verdict(F.col("score") >= main_branch).alias("main_branch_result"),
    )


def perf_regression(
    current: DataFrame, baseline: DataFrame,
    limits: Sequence[tuple[str, str, float]] = REGRESSION_LIMITS,
) -> DataFrame:
    """Change in percent per metric; ``max`` bounds a rise, ``min`` a fall. A metric without a pair
    of values is MISSING."""
    spark = current.sparkSession
    rules = spark.createDataFrame(list(limits), "metric string, bound string, limit_pct double")
    joined = rules.join(current, "metric", "left").join(
        baseline.withColumnRenamed("value", "baseline"), "metric", "left"
    )
    change = percent(F.col("value") - F.col("baseline"), F.col("baseline"))
    return joined.withColumn("change_pct", change).select(
        "metric", "value", "baseline", "change_pct", "bound", "limit_pct",
        F.when(change.isNull(), "MISSING")
        .otherwise(verdict(holds(change, F.col("bound"), F.col("limit_pct")))).alias("result"),
    )


def completeness(df: DataFrame, required: Sequence[str], minimum: float = 99.9) -> DataFrame:
    filled = F.lit(True)
    for name in required:
        filled = filled & F.col(name).isNotNull()
    m = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(filled).alias("complete"))
    rate = percent(F.col("complete"), F.col("total"))
    return m.withColumn("completeness_pct", rate).withColumn("result", verdict(rate >= minimum))


def compliance(validated: DataFrame, minimum: float = 100) -> DataFrame:
    m = validated.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_valid").alias("valid"))
    rate = percent(F.col("valid"), F.col("total"))
    return m.withColumn("compliance_pct", rate).withColumn("result", verdict(rate >= minimum))


def freshness(df: DataFrame, ts: str, as_of: Column, max_seconds: int = 300) -> DataFrame:
    m = df.agg(F.max(ts).alias("newest"), F.max(as_of).alias("as_of"))
    lag = F.timestamp_diff("SECOND", F.col("newest"), F.col("as_of"))
    return m.withColumn("lag_seconds", lag).withColumn(
        "result", verdict(F.col("lag_seconds") <= max_seconds)
    )


def referential_integrity(
    events: DataFrame, users: DataFrame, key: str = "user_id", minimum: float = 99.5
) -> DataFrame:
    """Share of events whose user exists.

    Events are counted per user first, so the join sees one row per user on each side.
    """
    per_user = events.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = users.select(key).distinct().withColumn("_known", F.lit(True))
    joined = per_user.join(known, key, "left")
    m = joined.agg(
        F.sum("_n").alias("events"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col("_n"))), F.lit(0)).alias("with_user"),
    )
    rate = percent(F.col("with_user"), F.col("events"))
    return m.withColumn("integrity_pct", rate).withColumn("result", verdict(rate >= minimum))
