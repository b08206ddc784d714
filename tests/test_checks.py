from helpers import events

from eventloom.operators import checks, enrich, windows

USERS = (
    "user_id bigint, valid_from timestamp_ntz, user_name string, user_email string, "
    "registration_date date, user_tier string, country string"
)


def test_empty_tables_fail(spark):
    stream = events(spark, [])
    enriched = enrich.enrich_events(stream, spark.createDataFrame([], USERS))
    hourly, sessions = windows.hourly_activity(stream), windows.user_sessions(stream)
    daily, sliding = windows.daily_analytics(stream), windows.sliding_activity(stream)
    found = [
        (checks.purchase_amounts(enriched), "test_result"),
        (checks.hourly_aggregation(hourly), "test_result"),
        (checks.revenue(hourly), "test_result"),
        (checks.sliding_windows(sliding), "test_result"),
        (checks.session_analysis(sessions), "test_result"),
        (checks.daily_rollup(daily), "test_result"),
        (checks.throughput(enriched), "performance_test_result"),
        (checks.latency(enriched), "latency_test_result"),
        (checks.late_data(enriched), "late_data_test_result"),
        (checks.event_times(enriched), "event_time_test_result"),
        (checks.join_accuracy(enriched), "join_test_result"),
        (checks.aggregation_accuracy(hourly), "aggregation_test_result"),
        (checks.quality_comprehensive(enriched, hourly, sliding, sessions, daily),
         "comprehensive_test_result"),
    ]
    stacked = checks.union_checks([df for df, _ in found], [v for _, v in found]).collect()
    assert len(stacked) == len(found)
    assert {r.result for r in stacked} == {"FAIL"}


def test_counts_of_empty_tables_agree(spark):
    """Without rows every count is zero and so equal: these rules hold by their own wording."""
    enriched = enrich.enrich_events(events(spark, []), spark.createDataFrame([], USERS))
    assert checks.enrichment_completeness(enriched).first().test_result == "PASS"
    assert checks.data_types(enriched).first().data_type_test_result == "PASS"


def test_single_instant_has_no_rate(spark):
    stream = events(spark, [(1, "view", 0)]).selectExpr("*", "event_timestamp as processing_time")
    users = spark.createDataFrame(
        [(1, None, "n", "e", None, "gold", "c")], USERS
    ).selectExpr("* except (valid_from)", "timestamp_ntz'2023-01-01' as valid_from")
    row = checks.throughput(enrich.enrich_events(stream, users)).first()
    assert row.processing_window_seconds == 0 and row.events_per_second is None
    assert row.performance_test_result == "FAIL"


def test_consistency_tolerance(spark):
    def table(column, n):
        return spark.createDataFrame([(n,)], f"{column} bigint")

    enriched = spark.range(100)
    for total, verdict in ((110, "PASS"), (111, "FAIL")):
        row = checks.cross_consistency(
            enriched, table("total_events", total), table("session_events", 1), table("daily_events", 1)
        ).first()
        assert (row.test_result, row.event_count_difference) == (verdict, total - 100)
