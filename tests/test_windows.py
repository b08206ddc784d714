from decimal import Decimal

from helpers import at, events, rows
from pyspark.sql import functions as F

from eventloom.operators import windows
from eventloom.sources import generators


def test_hour_edges_and_amounts(spark):
    out = windows.hourly_activity(
        events(
            spark,
            [(1, "purchase", 0, '{"amount": 10.005}'), (1, "purchase", 3599, '{"amount": "x"}'),
             (1, "view", 3599.999999), (1, "login", 3600), (1, "purchase", 3601, None)],
        )
    ).orderBy("window_start").collect()
    first, second = out
    assert (first.window_start, first.window_end) == (at(0), at(3600))
    assert (first.total_events, first.purchase_count, first.view_count) == (3, 2, 1)
    assert first.total_revenue == Decimal("10.01")  # half up; the unparsable amount adds nothing
    assert first.avg_purchase_amount == Decimal("10.010000")
    assert round(first.conversion_rate, 4) == 66.6667
    assert second.avg_purchase_amount is None and second.login_count == 1


def test_each_event_is_in_five_hops(spark):
    stream = generators.user_events(spark, users=20, events_per_user=30)
    hops = windows.sliding_activity(stream)
    assert hops.agg(F.sum("events_last_5min")).first()[0] == 5 * 600


def test_hop_bounds_multiset_and_levels(spark):
    data = [(1, "view", 61)] * 2 + [(1, "click", 61)]
    hops = windows.sliding_activity(events(spark, data)).orderBy("window_start").collect()
    assert [h.window_start for h in hops] == [at(60 * m) for m in range(-3, 2)]
    assert hops[0].event_types_array == {"click": 1, "view": 2}
    spelled = windows.sliding_activity(events(spark, data), as_array=True).first()
    assert spelled.event_types_array == ["click", "view", "view"]
    for n, level in ((101, "HIGH"), (100, "MEDIUM"), (51, "MEDIUM"), (50, "LOW")):
        first = windows.sliding_activity(events(spark, [(1, "view", 61)] * n)).first()
        assert first.activity_level == f"{level}_ACTIVITY"


def test_session_types_in_order(spark):
    data = [(1, "purchase", 0)] + [(2, "view", i) for i in range(21)] + [(3, "view", 0)]
    data += [(4, "view", i) for i in range(5)] + [(4, "click", 179)]
    out = windows.user_sessions(events(spark, data)).orderBy("user_id").collect()
    assert [r.session_type for r in out] == ["CONVERTER", "BROWSER", "QUICK_VISIT", "REGULAR"]
    assert out[3].session_duration_minutes == 2 and out[3].unique_event_types_in_session == 2


def test_parts_of_a_session_add_up(spark):
    data = [(1, "view", 0), (1, "purchase", 100, '{"amount": 2}'), (1, "click", 50), (2, "view", 9)]
    stream = events(spark, data)
    halves = [windows.session_parts(stream.where(c)) for c in ("event_id < 2", "event_id >= 2")]
    merged = windows.merge_sessions(halves[0].unionByName(halves[1]))
    assert rows(windows.describe_sessions(merged)) == rows(windows.user_sessions(stream))


def test_daily_trend_uses_previous_emitted_day(spark):
    day = 86400
    data = [(1, "view", 0), (1, "view", 3600), (1, "click", 3700), (1, "view", 3 * day), (2, "view", day)]
    data += [(1, "view", 4 * day), (1, "view", 4 * day + 1)]
    out = windows.daily_analytics(events(spark, data)).where("user_id = 1").orderBy("date_window")
    got = [(r.daily_events, r.active_hours, r.previous_day_events, r.activity_growth_rate) for r in out.collect()]
    assert got[0] == (3, 2, None, 0.0)
    assert got[1][:3] == (1, 1, 3) and round(got[1][3], 3) == -66.667
    assert got[2] == (2, 1, 1, 100.0)


def test_daily_distinct_counts_over_sessions(spark):
    stream = events(spark, [(1, "view", 0), (1, "click", 5), (1, "view", 7200), (1, "login", 9)])
    stream = stream.withColumn("session_id", F.concat(F.lit("s"), F.col("event_id") % 3))
    row = windows.daily_totals(stream).first()
    assert (row.daily_sessions, row.unique_event_types, row.active_hours) == (3, 3, 2)


def test_segments(spark):
    data = [(1, "purchase", i) for i in range(6)] + [(1, "view", i) for i in range(95)]
    data += [(2, "purchase", i) for i in range(3)] + [(2, "view", i) for i in range(48)]
    data += [(3, "view", i) for i in range(21)] + [(4, "view", 0)]
    out = windows.daily_analytics(events(spark, data)).orderBy("user_id").collect()
    assert [r.customer_segment for r in out] == [
        "HIGH_VALUE_CUSTOMER", "REGULAR_CUSTOMER", "BROWSER", "OCCASIONAL_USER"
    ]


def test_gap_of_exactly_the_limit_merges(spark):
    data = [(1, "view", 0), (1, "view", 1800), (1, "view", 3600.000001), (2, "view", 0)]
    out = rows(windows.gap_sessions(events(spark, data)))
    assert out == [
        (1, at(0), at(1800), 2), (1, at(3600.000001), at(3600.000001), 1), (2, at(0), at(0), 1)
    ]


def test_tumbling_counts_add_up(spark):
    stream = generators.user_events(spark, users=50, events_per_user=20, seed=3)
    assert windows.hourly_activity(stream).agg(F.sum("total_events")).first()[0] == 1000


def test_empty_input(spark):
    empty = events(spark, [])
    for build in (windows.hourly_activity, windows.sliding_activity, windows.user_sessions,
                  windows.daily_analytics, windows.gap_sessions):
        assert build(empty).count() == 0
