"""Assertion queries over the derived tables: one row each, with a PASS or FAIL column.

An input without rows gives unknown comparisons, which count as FAIL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.exprs import elapsed, int_div, percent, ratio, verdict


def _rows() -> Column:
    return F.count(F.lit(1))


def _mean(column: Column | str) -> Column:
    """Mean of an exact (integer or decimal) column as a double, from its exact sum."""
    return ratio(F.sum(column), F.count(column))


def _named(name: str, metrics: DataFrame, *columns: str | Column) -> DataFrame:
    return metrics.select(F.lit(name).alias("test_name"), *columns)


# --- transformation checks -----------------------------------------------------------------

def enrichment_completeness(enriched: DataFrame) -> DataFrame:
    m = enriched.agg(
        _rows().alias("total_events"),
        F.count("user_name").alias("events_with_user_name"),
        F.count("user_email").alias("events_with_user_email"),
    )
    complete = (F.col("total_events") == F.col("events_with_user_name")) & (
        F.col("total_events") == F.col("events_with_user_email")
    )
    return _named(
        "user_enrichment_completeness", m, *m.columns,
        verdict(complete).alias("test_result"),
        percent(F.col("events_with_user_name"), F.col("total_events")).alias("enrichment_rate"),
    )


def purchase_amounts(enriched: DataFrame, maximum: int = 10000) -> DataFrame:
    amount = F.col("purchase_amount")
    m = enriched.where((F.col("event_type") == "purchase") & (amount > 0)).agg(
        _rows().alias("total_purchase_events"),
        F.sum(amount).alias("total_calculated_amount"),
        _mean(amount).alias("avg_purchase_amount"),
        F.min(amount).alias("min_purchase_amount"),
        F.max(amount).alias("max_purchase_amount"),
    )
    in_range = (F.col("min_purchase_amount") >= 0) & (F.col("max_purchase_amount") <= maximum)
    return _named(
        "purchase_amount_calculation", m, *m.columns, verdict(in_range).alias("test_result")
    )


def temporal_join(enriched: DataFrame) -> DataFrame:
    m = enriched.agg(
        _rows().alias("total_joined_events"),
        F.count_distinct("user_id").alias("unique_users"),
        (_rows() - F.count("user_name")).alias("missing_user_data"),
        F.min("event_time").alias("earliest_event"),
        F.max("event_time").alias("latest_event"),
    )
    return _named(
        "temporal_join_accuracy", m,
        "total_joined_events", "unique_users", "missing_user_data",
        verdict(F.col("missing_user_data") == 0).alias("test_result"),
        "earliest_event", "latest_event",
    )


def hourly_aggregation(hourly: DataFrame) -> DataFrame:
    m = hourly.agg(
        _rows().alias("total_windows"),
        F.sum("total_events").alias("sum_of_events_in_windows"),
        _mean("total_events").alias("avg_events_per_window"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
    )
    return _named(
        "hourly_aggregation_accuracy", m, *m.columns,
        verdict(F.col("avg_conversion_rate").between(0, 100)).alias("test_result"),
    )


def revenue(hourly: DataFrame) -> DataFrame:
    m = hourly.where(F.col("total_revenue") > 0).agg(
        _rows().alias("windows_with_revenue"),
        F.sum("total_revenue").alias("total_calculated_revenue"),
        _mean("avg_purchase_amount").alias("avg_calculated_purchase_amount"),
        F.min("total_revenue").alias("min_window_revenue"),
        F.max("total_revenue").alias("max_window_revenue"),
    )
    positive = (F.col("total_calculated_revenue") > 0) & (
        F.col("avg_calculated_purchase_amount") > 0
    )
    return _named(
        "revenue_calculation_accuracy", m,
        "windows_with_revenue", "total_calculated_revenue", "avg_calculated_purchase_amount",
        verdict(positive).alias("test_result"),
        "min_window_revenue", "max_window_revenue",
    )


def sliding_windows(sliding: DataFrame, min_levels: int = 2) -> DataFrame:
    m = sliding.agg(
        _rows().alias("total_sliding_windows"),
        _mean("events_last_5min").alias("avg_events_per_5min_window"),
        F.count_distinct("activity_level").alias("unique_activity_levels"),
    )
    good = (F.col("unique_activity_levels") >= min_levels) & (
        F.col("avg_events_per_5min_window") >= 0
    )
    return _named("sliding_window_accuracy", m, *m.columns, verdict(good).alias("test_result"))


def session_analysis(sessions: DataFrame, min_types: int = 3) -> DataFrame:
    m = sessions.agg(
        _rows().alias("total_sessions"),
        _mean("session_duration_minutes").alias("avg_session_duration"),
        F.count_distinct("session_type").alias("unique_session_types"),
        F.sum("session_value").alias("total_session_value"),
    )
    good = (F.col("avg_session_duration") >= 0) & (F.col("unique_session_types") >= min_types)
    return _named("session_analysis_accuracy", m, *m.columns, verdict(good).alias("test_result"))


def daily_rollup(daily: DataFrame, min_segments: int = 3) -> DataFrame:
    m = daily.agg(
        _rows().alias("total_daily_records"),
        _mean("daily_events").alias("avg_daily_events"),
        F.count_distinct("customer_segment").alias("unique_segments"),
        _mean("daily_revenue").alias("avg_daily_revenue"),
    )
    good = (F.col("unique_segments") >= min_segments) & (F.col("avg_daily_revenue") >= 0)
    return _named("daily_analytics_accuracy", m, *m.columns, verdict(good).alias("test_result"))


def anomaly_logic(anomalies: DataFrame, min_flags: int = 2) -> DataFrame:
    m = anomalies.agg(
        _rows().alias("total_analyzed_events"),
        F.count_distinct("anomaly_flag").alias("unique_anomaly_types"),
        F.count_if(F.col("anomaly_flag") != "NORMAL").alias("flagged_events"),
        _mean("risk_score").alias("avg_risk_score"),
    )
    good = (F.col("unique_anomaly_types") >= min_flags) & F.col("avg_risk_score").between(1, 5)
    return _named(
        "anomaly_detection_accuracy", m, *m.columns,
        verdict(good).alias("test_result"),
        percent(F.col("flagged_events"), F.col("total_analyzed_events")).alias("anomaly_rate"),
    )


def one_row(metrics: dict[str, DataFrame]) -> DataFrame:
    """Puts one-row, one-column aggregates side by side as uncorrelated scalar subqueries."""
    spark = next(iter(metrics.values())).sparkSession
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in metrics.items()])


def stacked_scalars(metrics: dict[str, DataFrame]) -> DataFrame:
    """The same for BIGINT aggregates without subqueries: stack the one-row results, then
    fold them into one row. It stands where others write a cross join of one-row tables."""
    parts = [
        df.select(F.lit(name).alias("_name"), F.col(df.columns[0]).cast("bigint").alias("_value"))
        for name, df in metrics.items()
    ]
    return reduce(DataFrame.unionByName, parts).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in metrics]
    )


def cross_consistency(
    enriched: DataFrame, hourly: DataFrame, sessions: DataFrame, daily: DataFrame,
    share: float = 0.01, at_least: int = 10,
) -> DataFrame:
    m = stacked_scalars(
        {
            "total_events_enriched": enriched.agg(_rows()),
            "total_events_hourly": hourly.agg(F.sum("total_events")),
            "total_events_sessions": sessions.agg(F.sum("session_events")),
            "total_events_daily": daily.agg(F.sum("daily_events")),
        }
    )
    difference = F.abs(F.col("total_events_enriched") - F.col("total_events_hourly"))
    allowed = F.greatest(F.col("total_events_enriched") * share, F.lit(float(at_least)))
    return _named(
        "cross_transformation_consistency", m, *m.columns,
        verdict(difference <= allowed).alias("test_result"),
        difference.alias("event_count_difference"),
    )


# --- validation queries --------------------------------------------------------------------

def _latency() -> Column:
    return elapsed("SECOND", "event_time", "processing_time")


def _both_times(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("processing_time").isNotNull() & F.col("event_time").isNotNull())


def throughput(enriched: DataFrame, minimum: float = 1000) -> DataFrame:
    m = enriched.where(F.col("processing_time").isNotNull()).agg(
        _rows().alias("processed_events"),
        F.count_distinct("user_id").alias("unique_users_processed"),
        elapsed("SECOND", F.min("processing_time"), F.max("processing_time"))
        .alias("processing_window_seconds"),
    )
    rate = ratio(F.col("processed_events"), F.col("processing_window_seconds"))
    return _named(
        "throughput_validation", m, *m.columns,
        rate.alias("events_per_second"),
        verdict(rate >= minimum).alias("performance_test_result"),
    )


def latency(enriched: DataFrame, maximum: float = 5) -> DataFrame:
    m = _both_times(enriched).agg(
        _rows().alias("measured_events"),
        _mean(_latency()).alias("avg_latency_seconds"),
        F.max(_latency()).alias("max_latency_seconds"),
        F.min(_latency()).alias("min_latency_seconds"),
    )
    return _named(
        "latency_validation", m, *m.columns,
        verdict(F.col("avg_latency_seconds") <= maximum).alias("latency_test_result"),
    )


def resource_usage(enriched: DataFrame, maximum: int = 10000) -> DataFrame:
    m = enriched.agg(
        _rows().alias("total_processed_events"),
        F.count_distinct(F.to_date("event_time")).alias("processing_days"),
        F.count_distinct("user_id").alias("unique_users"),
    )
    per_user = int_div(F.col("total_processed_events"), F.col("unique_users"))
    return _named(
        "resource_usage_validation", m, *m.columns,
        per_user.alias("avg_events_per_user"),
        verdict(per_user <= maximum).alias("resource_test_result"),
    )


def window_boundaries(hourly: DataFrame, minutes: int = 60) -> DataFrame:
    m = hourly.agg(
        _rows().alias("total_windows"),
        F.count_distinct("window_start").alias("unique_start_times"),
        F.count_distinct("window_end").alias("unique_end_times"),
        _mean(elapsed("MINUTE", "window_start", "window_end"))
        .alias("avg_window_duration_minutes"),
    )
    return _named(
        "window_boundary_validation", m, *m.columns,
        verdict(F.col("avg_window_duration_minutes") == minutes).alias("window_test_result"),
    )


def late_data(enriched: DataFrame, late_after: int = 60, maximum: float = 5) -> DataFrame:
    """By this rule late rows are on time too; the two counts overlap."""
    m = _both_times(enriched).agg(
        _rows().alias("total_events"),
        F.count_if(F.col("event_time") < F.col("processing_time")).alias("on_time_events"),
        F.count_if(_latency() > late_after).alias("late_events"),
    )
    share = percent(F.col("late_events"), F.col("total_events"))
    return _named(
        "late_data_handling", m, *m.columns,
        share.alias("late_data_percentage"),
        verdict(share <= maximum).alias("late_data_test_result"),
    )


def event_times(enriched: DataFrame) -> DataFrame:
    m = enriched.agg(
        _rows().alias("events_with_event_time"),
        F.min("event_time").alias("earliest_event_time"),
        F.max("event_time").alias("latest_event_time"),
        F.count_distinct(F.to_date("event_time")).alias("unique_event_dates"),
    )
    known = F.col("earliest_event_time").isNotNull() & F.col("latest_event_time").isNotNull()
    return _named(
        "event_time_validation", m, *m.columns,
        verdict(known).alias("event_time_test_result"),
        elapsed("DAY", "earliest_event_time", "latest_event_time").alias("time_span_days"),
    )


def join_accuracy(enriched: DataFrame, minimum: float = 95) -> DataFrame:
    m = enriched.agg(
        _rows().alias("total_join_attempts"),
        F.count("user_name").alias("successful_joins"),
        (_rows() - F.count("user_name")).alias("failed_joins"),
    )
    rate = percent(F.col("successful_joins"), F.col("total_join_attempts"))
    return _named(
        "join_accuracy_validation", m, *m.columns,
        rate.alias("join_success_rate"),
        verdict(rate >= minimum).alias("join_test_result"),
    )


def aggregation_accuracy(hourly: DataFrame) -> DataFrame:
    m = hourly.agg(
        _rows().alias("total_aggregation_windows"),
        F.sum("total_events").alias("sum_of_events"),
        F.sum("total_revenue").alias("sum_of_revenue"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
        F.stddev_samp("conversion_rate").alias("conversion_rate_stddev"),
    )
    good = (
        F.col("avg_conversion_rate").between(0, 100)
        & (F.col("sum_of_events") > 0)
        & (F.col("sum_of_revenue") >= 0)
    )
    return _named(
        "aggregation_accuracy_validation", m, *m.columns,
        verdict(good).alias("aggregation_test_result"),
    )


def data_types(enriched: DataFrame) -> DataFrame:
    m = enriched.agg(
        _rows().alias("total_records"),
        F.count_if(F.col("purchase_amount") >= 0).alias("valid_amounts"),
        F.count_if(F.col("tier_multiplier") >= 1.0).alias("valid_multipliers"),
        F.count("event_time").alias("valid_timestamps"),
    )
    total = F.col("total_records")
    good = (
        (total == F.col("valid_amounts"))
        & (total == F.col("valid_multipliers"))
        & (total == F.col("valid_timestamps"))
    )
    return _named(
        "data_type_validation", m, *m.columns, verdict(good).alias("data_type_test_result")
    )


def quality_comprehensive(
    enriched: DataFrame, hourly: DataFrame, sliding: DataFrame, sessions: DataFrame,
    daily: DataFrame,
) -> DataFrame:
    m = one_row(
        {
            "enriched_count": enriched.agg(_rows()),
            "complete_enrichments": enriched.agg(F.count("user_name")),
            "hourly_aggregations": hourly.agg(_rows()),
            "sliding_aggregations": sliding.agg(_rows()),
            "session_count": sessions.agg(_rows()),
            "avg_session_duration": sessions.agg(_mean("session_duration_minutes")),
            "daily_records": daily.agg(_rows()),
            "total_daily_revenue": daily.agg(F.sum("daily_revenue")),
        }
    )
    good = (
        (F.col("enriched_count") > 0)
        & (F.col("complete_enrichments") == F.col("enriched_count"))
        & (F.col("hourly_aggregations") > 0)
        & (F.col("sliding_aggregations") > 0)
        & (F.col("session_count") > 0)
        & (F.col("avg_session_duration") > 0)
        & (F.col("daily_records") > 0)
        & (F.col("total_daily_revenue") >= 0)
    )
    return _named(
        "data_quality_comprehensive", m, *m.columns,
        verdict(good).alias("comprehensive_test_result"),
        percent(F.col("complete_enrichments"), F.col("enriched_count"))
        .alias("data_completeness_percentage"),
    )


def union_checks(checks: list[DataFrame], verdict_columns: list[str]) -> DataFrame:
    """Stacks check rows as (test_name, result, metrics JSON), whatever their own columns."""
    rows = [
        df.select(
            "test_name",
            F.col(v).alias("result"),
            F.to_json(F.struct(*[c for c in df.columns if c not in ("test_name", v)]))
            .alias("metrics"),
        )
        for df, v in zip(checks, verdict_columns, strict=True)
    ]
    return reduce(DataFrame.unionByName, rows)
