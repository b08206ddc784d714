"""The events arriving in spans of time, and the joins and windows that large tables are given."""

from datetime import datetime

from helpers import at, events, rows
from pyspark.sql import functions as F

from eventloom.operators import asof, enrich, windows
from eventloom.plans import check_queries, stream_queries
from eventloom.plans.catalog import Tables
from eventloom.sources import testdata
from eventloom.streaming import jobs

RAW = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
USERS = (
    "user_id bigint, valid_from timestamp_ntz, user_name string, user_email string, "
    "registration_date date, user_tier string, country string"
)


def test_spans_arrive_one_by_one_and_are_derived_once(spark, tmp_path, monkeypatch):
    """Days 0-9 and 20 on have events, also on two rows of one id; the second span is empty."""
    days = [(0, datetime(2024, 1, 1)), (1, datetime(2023, 12, 30)), (2, datetime(2024, 1, 10, 23)),
            (3, datetime(2024, 1, 21)), (3, datetime(2024, 1, 21)), (4, datetime(2024, 3, 1)),
            (5, datetime(2023, 1, 1)), (6, None)]
    raw = [(i, ts, 7, "view", 1.5, '{"k": 1}') for i, ts in days]
    spark.createDataFrame(raw, RAW).write.parquet(f"{tmp_path}/events.parquet")
    derived, derive = [], testdata.events_of
    monkeypatch.setattr(testdata, "events_of", lambda raw: derived.append(raw) or derive(raw))
    seen = []

    def write(batch, batch_id):
        seen.append((batch_id, rows(batch.select("event_id"))))

    def run(stream):
        jobs.start_batches(stream, write, f"{tmp_path}/checkpoint", once=True).awaitTermination()

    stream_queries.in_slices(Tables(spark, str(tmp_path)), run)
    # More than ten days before the first day: in no span. Without a time: in the last.
    assert seen == [(0, [(0,), (1,), (2,)]), (1, []), (2, [(3,), (3,), (4,), (6,)])]
    assert len(derived) == 1


def test_raw_events_are_spread_by_the_size_of_their_files(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/events.parquet"
    raw = spark.createDataFrame([(i, at(i), i % 3, "view", 1.0, None) for i in range(50)], RAW)
    raw.coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    assert testdata.spread(table, path) is table
    monkeypatch.setattr(testdata, "_parts_of", lambda *_: 5)
    wide = testdata.spread(table, path)
    assert rows(wide) == rows(table)
    assert "REPARTITION_BY_NUM" in wide._jdf.queryExecution().executedPlan().toString()


def test_enrich_writer_cuts_busy_users_only_and_gives_the_rows_of_the_join(spark, tmp_path, monkeypatch):
    data = [(user, kind, 700 * i) for user in (1, 2) for i, kind in enumerate(["view", "purchase", "error"] * 4)]
    batch = events(spark, data)
    users = spark.createDataFrame(
        [(u, at(s), f"n{u}-{s}", None, None, "gold", "c") for u, s in [(1, 0), (1, 2000), (2, 1500), (3, 0)]], USERS
    )
    batch = batch.withColumn("processing_time", F.col("event_timestamp"))
    expected = rows(enrich.enrich_events(batch, users))
    asked = []
    join = enrich.asof_join
    monkeypatch.setattr(enrich, "asof_join", lambda *a, **k: asked.append(k["busy"]) or join(*a, **k))
    find = asof.busy_keys
    for over, busy in ((100_000, []), (13, [1])):
        monkeypatch.setattr(jobs, "busy_keys", lambda *a, over=over: find(*a, over=over))
        jobs.enrich_writer(lambda: users, f"{tmp_path}/{over}")(batch, 0)
        assert rows(spark.read.parquet(f"{tmp_path}/{over}").drop("batch")) == expected
        assert asked.pop() == busy


def test_sliding_windows_of_a_table_shuffle_panes_and_equal_a_plain_count(spark):
    """Dense and sparse panes, several types in a pane, rows without a type or a user."""
    data = [(user, kind, s) for user in (1, None) for s in (0, 1, 59, 60, 130, 299, 300, 301, 5000, 5000)
            for kind in ("view", "click", None)] + [(2, "view", 10), (2, None, 4000)]
    stream = events(spark, data)
    for size, slide in ((5, 1), (7, 3), (4, 4)):
        out = windows.sliding_activity(stream, f"{size} minutes", f"{slide} minutes")
        expected = {}
        for user, kind, s in data:
            for start in range(-600, 6000, 60):
                if (int(at(0).timestamp()) + start) % (slide * 60) == 0 and start <= s < start + size * 60:
                    expected.setdefault((repr(user), at(start)), []).append(kind)
        got = {(repr(r.user_id), r.window_start): r for r in out.collect()}
        assert got.keys() == expected.keys()
        for key, kinds in expected.items():
            known = [k for k in kinds if k]
            assert got[key].events_last_5min == len(kinds)
            assert got[key].event_types_array == {k: known.count(k) for k in known}
            assert got[key].unique_event_types == len(set(known))
    wide = windows.sliding_activity(stream)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in wide[: wide.index("Expand")]  # printed from the result down


def test_the_derived_tables_of_the_checks_cut_busy_users_only(spark, tmp_path, monkeypatch):
    asked = []
    join = enrich.asof_join
    monkeypatch.setattr(enrich, "asof_join", lambda *a, **k: asked.append(k.get("busy")) or join(*a, **k))
    small = Tables(spark, "/root/testdata/sf0.001")
    saved = check_queries.materialised(small)
    assert asked == [[], []]
    for name in ("enriched", "enriched_left", "sessions"):
        assert rows(getattr(saved, name)) == rows(getattr(Tables(spark, small.sf_dir), name))
