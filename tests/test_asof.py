import random

import pytest
from helpers import at, events, rows
from pyspark.sql import functions as F

from eventloom.operators import enrich
from eventloom.operators.asof import asof_join, busy_keys, latest_per_key

USERS = "user_id bigint, valid_from timestamp_ntz, seq int, tier string"


def versions(spark, data):
    return spark.createDataFrame([(u, at(s), q, t) for u, s, q, t in data], USERS)


def join(spark, left, right, **options):
    out = asof_join(
        events(spark, left).select("event_id", "user_id", "event_timestamp"), versions(spark, right),
        "user_id", "event_timestamp", "valid_from", ["tier"], tie_break="seq", **options,
    )
    return rows(out.select("event_id", "tier"))


LEFT = [(1, "view", 5), (1, "view", 10), (1, "view", 20), (2, "view", 7), (None, "view", 9)]
RIGHT = [(1, 10, 0, "a"), (1, 20, 0, "b"), (1, 20, 1, "c"), (2, 8, 0, "x"), (None, 0, 0, "n")]


def test_version_at_event_time_counts_and_earlier_events_drop(spark):
    assert join(spark, LEFT, RIGHT) == [(1, "a"), (2, "c")]


def test_left_form_keeps_unmatched_and_null_keys(spark):
    expected = [(0, None), (1, "a"), (2, "c"), (3, None), (4, None)]
    assert join(spark, LEFT, RIGHT, how="left") == expected


def test_tolerance(spark):
    left = [(1, "view", 13), (1, "view", 14)]
    for how, more in (("inner", []), ("left", [(1, None)])):
        assert join(spark, left, [(1, 10, 0, "a")], tolerance_seconds=3, how=how) == [(0, "a"), *more]


def test_unknown_options(spark):
    with pytest.raises(ValueError):
        join(spark, LEFT, RIGHT, how="outer")


def test_text_breaks_ties(spark):
    out = asof_join(
        events(spark, [(1, "view", 20)]).select("event_id", "user_id", "event_timestamp"),
        versions(spark, [(1, 20, 0, "b"), (1, 20, 0, "c"), (1, 20, 0, "a")]),
        "user_id", "event_timestamp", "valid_from", ["tier"], tie_break="tier",
    )
    assert rows(out.select("event_id", "tier")) == [(0, "c")]


@pytest.mark.parametrize("slot_seconds", [1, 900])
def test_tombstone_hides_earlier_versions_until_the_next(spark, slot_seconds):
    left = [(1, "view", s) for s in (10, 20, 25, 30)]
    right = [(1, 5, 0, "a"), (1, 20, 1, None), (1, 30, 2, "b")]
    options = {"deleted": F.col("tier").isNull(), "slot_seconds": slot_seconds}
    assert join(spark, left, right, **options) == [(0, "a"), (3, "b")]
    kept = join(spark, left, right, how="left", **options)
    assert kept == [(0, "a"), (1, None), (2, None), (3, "b")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_keys_equal_brute_force(spark, how):
    """Half of the rows belong to one user; slots of 50 seconds force carried versions."""
    rnd = random.Random(7)
    left = [
        (1 if rnd.random() < 0.5 else rnd.randint(2, 6), "view", rnd.randint(0, 600))
        for _ in range(400)
    ]
    right = [
        (1 if rnd.random() < 0.5 else rnd.randint(2, 6), rnd.randint(0, 600), q, f"t{q}")
        for q in range(40)
    ]
    expected = []
    for i, (user, _, sec) in enumerate(left):
        known = [(s, q, t) for u, s, q, t in right if u == user and s <= sec]
        if known or how == "left":
            expected.append((i, max(known)[2] if known else None))
    for slot_seconds in (900, 50, 1):
        out = join(spark, left, right, how=how, slot_seconds=slot_seconds)
        assert out == sorted(expected, key=repr)


@pytest.mark.parametrize("busy", [[], [1], [1, 2, 3]])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_busy_keys_alone_are_cut_and_all_rows_match(spark, how, busy):
    rnd = random.Random(3)
    left = [(rnd.choice([1, 1, 2, 3, None]), "view", rnd.randint(0, 300)) for _ in range(120)]
    right = [(rnd.choice([1, 2, 3, None]), rnd.randint(0, 300), q, f"t{q}") for q in range(30)]
    expected = join(spark, left, right, how=how)
    for slot_seconds in (900, 20, 1):
        assert join(spark, left, right, how=how, slot_seconds=slot_seconds, busy=busy) == expected


def test_keys_that_are_not_busy_cost_one_shuffle(spark):
    out = asof_join(
        events(spark, LEFT), versions(spark, RIGHT), "user_id", "event_timestamp", "valid_from", ["tier"], busy=[]
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan


def test_busy_keys_count_both_sides_and_no_nulls(spark):
    left, right = events(spark, LEFT), versions(spark, RIGHT)  # user 1: 3 + 3 rows, user 2: 1 + 1
    assert busy_keys(left, right, "user_id", over=5) == [1]
    assert sorted(busy_keys(left, right, "user_id", over=1)) == [1, 2]
    assert busy_keys(left, right, "user_id", over=6) == []


def test_latest_per_key_honours_tombstones(spark):
    changes = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 2, None)], "k int, seq int, v string"
    )
    kept = latest_per_key(changes, "k", ["seq"], F.col("v").isNull())
    assert rows(kept) == [(1, 2, "b")]


def test_enrichment_on_empty_input(spark):
    users = spark.createDataFrame(
        [],
        "user_id bigint, valid_from timestamp_ntz, user_name string, user_email string, "
        "registration_date date, user_tier string, country string",
    )
    out = enrich.enrich_events(events(spark, []), users)
    assert out.columns == list(enrich.ENRICHED_COLUMNS)
    assert out.count() == 0


def test_purchase_is_attributed_to_latest_view_within_the_hour(spark):
    stream = events(
        spark,
        [(1, "view", 0), (1, "view", 100), (1, "purchase", 3700), (1, "purchase", 3701),
         (2, "purchase", 50)],
    )
    out = enrich.attribute_purchases(stream).select("purchase_id", "view_id", "seconds_to_purchase")
    assert rows(out) == [(2, 1, 3600)]
