import random

import pytest
from helpers import at, events, rows

from eventloom.operators.anomaly import anomaly_detection
from eventloom.operators.trailing import trailing_counts

COUNTS = {"m5": 300, "h1": 3600}
DISTINCT = {"kinds": ("event_type", 60)}


def brute(data, counts, distinct_seconds):
    out = []
    for i, (user, _, sec) in enumerate(data):
        same = [(k, s) for u, k, s in data if u == user]
        row = [sum(1 for _, s in same if sec - w <= s <= sec) for w in counts.values()]
        kinds = {k for k, s in same if sec - distinct_seconds <= s <= sec and k is not None}
        out.append((i, *row, len(kinds)))
    return sorted(out, key=repr)


def run(spark, data, **options):
    frame = events(spark, data).select("event_id", "user_id", "event_timestamp", "event_type")
    out = trailing_counts(frame, "user_id", "event_timestamp", COUNTS, DISTINCT, **options)
    return rows(out.select("event_id", *COUNTS, "kinds"))


def sample(seed, n=300, span=9000):
    rnd = random.Random(seed)
    kinds = ["view", "click", "login", None]
    return [
        (rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice(kinds), rnd.choice([rnd.randint(0, span), 60 * rnd.randint(0, span // 60)]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("options", [{}, {"slot_seconds": 300}, {"slot_seconds": 7}])
def test_any_slots_equal_brute_force(spark, seed, options):
    data = sample(seed)
    assert run(spark, data, **options) == brute(data, COUNTS, 60)


def test_both_ends_of_the_range_count(spark):
    data = [(1, "view", 0), (1, "click", 60), (1, "view", 300), (1, "view", 301)]
    for options in ({}, {"slot_seconds": 100}):
        assert run(spark, data, **options) == [(0, 1, 1, 1), (1, 2, 2, 2), (2, 3, 3, 1), (3, 3, 4, 1)]


def test_flags_and_scores(spark):
    burst = [(1, "view", i) for i in range(60)]
    dear = [(2, "purchase", 0, '{"amount": 1000.01}'), (2, "purchase", 9000, '{"amount": 1000}'),
            (2, "purchase", 20000, "{broken"), (2, "view", 40000, '{"amount": 5000}')]
    kinds = [(3, k, i) for i, k in enumerate(["a", "b", "c", "d", "e", "f"])]
    out = anomaly_detection(events(spark, burst + dear + kinds), keep=("event_id",))
    by_id = {r.event_id: (r.anomaly_flag, r.risk_score) for r in out.collect()}
    assert by_id[15] == ("NORMAL", 2) and by_id[14] == ("NORMAL", 1)
    assert by_id[20] == ("SUSPICIOUS_ACTIVITY", 2) and by_id[19] == ("NORMAL", 2)
    assert by_id[30] == ("SUSPICIOUS_ACTIVITY", 3) and by_id[50] == ("SUSPICIOUS_ACTIVITY", 5)
    assert [by_id[i][0] for i in range(60, 64)] == ["HIGH_VALUE_TRANSACTION", "NORMAL", "NORMAL", "NORMAL"]
    assert by_id[69][0] == "RAPID_BEHAVIOR_CHANGE" and by_id[68][0] == "NORMAL"


def test_day_range(spark):
    out = anomaly_detection(events(spark, [(1, "view", 0), (1, "view", 86400), (1, "view", 86401)]))
    assert [r.events_last_day for r in out.orderBy("event_timestamp").collect()] == [1, 2, 2]
    assert out.where(out.event_timestamp == at(86400)).first().events_last_hour == 1
