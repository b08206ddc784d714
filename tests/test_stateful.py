import random
import time
from bisect import bisect_left, bisect_right
from datetime import timedelta

from helpers import START, at, events, rows
from pyspark.sql import functions as F

from eventloom.operators import monitoring
from eventloom.operators.anomaly import anomaly_detection
from eventloom.operators.asof import asof_join
from eventloom.streaming import jobs, stateful

MICROS = 1_000_000


def run_parts(spark, path, parts, build, schema=None, mode="append"):
    """One run of the job per part of the input, on one checkpoint; returns what it wrote."""
    for part in parts:
        part.write.mode("append").parquet(f"{path}/in")
        stream = build(spark.readStream.schema(part.schema).parquet(f"{path}/in"))
        jobs.start_table(stream, f"{path}/out", f"{path}/checkpoint", once=True, mode=mode).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def instants(df):
    return df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def numbered(spark, batches):
    offset, out = 0, []
    for data in batches:
        out.append(instants(events(spark, data).withColumn("event_id", F.col("event_id") + offset)))
        offset += len(data)
    return out


# --- anomalies ---


def test_trailing_figures_equal_counting():
    rng = random.Random(1)
    times = sorted(rng.choice([rng.randrange(0, 2 * 86400), rng.randrange(0, 7200)]) * MICROS + rng.choice([0, 0, 1]) for _ in range(800))
    kinds = [rng.choice(["a", "b", "c", None]) for _ in times]
    counts, minutes, got = {}, {}, []
    for a in range(0, len(times), 90):  # handled in batches, as the state is
        part = list(zip(times[a: a + 90], kinds[a: a + 90]))
        if part and a and part[0][0] == times[a - 1]:
            continue
        figures, changed = stateful.trailing(part, counts, lambda m: minutes[m])
        minutes |= changed
        counts |= {m: len(x[0]) for m, x in changed.items()}
        got += list(zip([p[0] for p in part], figures))
    held = sorted(x for m in minutes.values() for x in m[0])
    kind_at = sorted(((x, k) for m in minutes.values() for x, k in zip(*m)), key=lambda p: p[0])
    upto = {a: max(g[0] for g in got[a: a + 90]) for a in range(0, len(got), 90)}
    for n, (t, (burst, hour, day, types)) in enumerate(got):
        known = bisect_right(held, upto[n - n % 90])  # later batches were not there yet
        for found, seconds in ((burst, 300), (hour, 3600), (day, 86400)):
            assert found == bisect_right(held, t, 0, known) - bisect_left(held, t - seconds * MICROS)
        assert types == len({k for x, k in kind_at if t - 60 * MICROS <= x <= t and k is not None})


def test_anomaly_stream_equals_batch_whatever_the_order(spark, tmp_path):
    batches = [
        [(1, "view", 10 * i) for i in range(30)] + [(None, "click", 7), (1, "view", 10)],
        [(1, "click", 292 + i) for i in reversed(range(10))] + [(2, "purchase", 400, '{"amount": "5000"}')],
        [(1, "view", 200), (1, "view", 500), (3, "login", 100_000)],  # 200 is late
        [(1, "view", 100_010.000001), (1, "login", 86_700.5 + 99_000)],
        [(4, "view", 400_000)],
    ]
    parts = numbered(spark, batches)
    out = run_parts(spark, str(tmp_path), parts, lambda s: stateful.anomaly_stream(s, keep=("event_id",)))
    table = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4])
    accepted = table.where(~((F.col("event_timestamp") == F.lit(at(200))) & (F.col("event_id") > 40)))
    expected = anomaly_detection(accepted, keep=("event_id",)).where(F.col("event_timestamp") <= F.lit(at(400_000 - 5)))
    assert rows(out.select(expected.columns)) == rows(expected)


def state_rows(spark, path, name):
    reader = spark.read.format("statestore").option("stateVarName", name)
    return reader.load(f"{path}/checkpoint").count()


def test_anomaly_state_is_a_day(spark, tmp_path):
    """After days of events the state holds the minutes of the last one, and none of idle users."""
    day = 86400
    batches = [[(1, "view", d * day + 3600 * h) for h in range(24)] + [(2, "view", 5)] for d in range(4)]
    path = str(tmp_path)
    run_parts(spark, path, numbered(spark, [*batches, [(3, "view", 4 * day)]]), stateful.anomaly_stream)
    assert state_rows(spark, path, "counts") <= 25
    assert state_rows(spark, path, "pending") <= 1


def test_state_is_by_buckets_of_users(spark, tmp_path):
    """Many users with few events each: the rows of state, and so the calls for them, are those of the buckets."""
    path = str(tmp_path)
    table = numbered(spark, [[(u if u else None, "view", u + s) for u in range(300) for s in (0, 40, 4000)]])[0]
    out = run_parts(spark, path, [table, numbered(spark, [[(1, "view", 50_000)]])[0]], lambda s: stateful.anomaly_stream(s, buckets=4))
    assert rows(out) == rows(anomaly_detection(table).select(out.columns))
    assert 1 <= state_rows(spark, path, "counts") <= 4


def test_a_busy_minute_is_stored_for_itself(spark, tmp_path):
    path = str(tmp_path)
    parts = numbered(spark, [
        [(1, "view", i / 10) for i in range(400)] + [(2, "view", 5), (None, "click", 9)], [(1, "click", 50), (2, "view", 58)], [(3, "view", 9000)],
    ])
    out = run_parts(spark, path, parts, lambda s: stateful.anomaly_stream(s, keep=("event_id",)))
    expected = anomaly_detection(parts[0].unionByName(parts[1]), keep=("event_id",))
    assert rows(out.select(expected.columns)) == rows(expected)
    assert state_rows(spark, path, "minutes") == 1


# --- temporal join ---

USERS = "user_id bigint, valid_from timestamp, name string, gone boolean, seq int"


def versions(spark, data):
    return spark.createDataFrame([(u, at(s), name, gone, seq) for u, s, name, gone, seq in data], USERS)


def joined(spark, path, steps, how="inner", delay="5 seconds"):
    """``steps``: (events, versions) that arrive together."""
    for events_part, versions_part in steps:
        events_part.write.mode("append").parquet(f"{path}/events")
        versions_part.write.mode("append").parquet(f"{path}/users")
        stream = stateful.temporal_join_stream(
            spark.readStream.schema(events_part.schema).parquet(f"{path}/events"),
            spark.readStream.schema(versions_part.schema).parquet(f"{path}/users"),
            "user_id", "event_timestamp", "valid_from", ["name"], how, tie_break="seq", deleted=F.col("gone"), delay=delay,
        )
        jobs.start_table(stream, f"{path}/out", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def test_temporal_join_late_versions_ties_and_tombstones(spark, tmp_path):
    event_parts = numbered(spark, [
        [(1, "view", 5), (1, "view", 20), (2, "view", 10), (None, "view", 3)],
        [(1, "view", 100), (2, "view", 99), (3, "view", 98)],
        [(1, "view", 200), (9, "view", 1000)],
    ])
    version_parts = [
        versions(spark, [(1, 0, "a", False, 0), (1, 20, "b", False, 0), (2, 10, "x", False, 1), (2, 10, "y", False, 2), (8, 20, "clock", False, 0)]),
        # 97 comes after the event at 100 in its file and still counts; the tombstone hides user 2.
        versions(spark, [(1, 97, "c", False, 0), (2, 50, None, True, 0), (8, 100, "clock", False, 0)]),
        versions(spark, [(1, 60, "too late", False, 0), (2, 150, "z", False, 0), (9, 1000, "n", False, 0)]),
    ]
    closing = numbered(spark, [[(7, "view", 5000)]])[0], versions(spark, [(7, 5000, "end", False, 0)])
    for how in ("inner", "left"):
        out = joined(spark, str(tmp_path / how), [*zip(event_parts, version_parts), closing], how)
        table = event_parts[0].unionByName(event_parts[1]).unionByName(event_parts[2])
        users = version_parts[0].unionByName(version_parts[1]).unionByName(version_parts[2]).where("name IS NULL OR name <> 'too late'")
        expected = asof_join(table, users, "user_id", "event_timestamp", "valid_from", ["name"], how, tie_break="seq", deleted=F.col("gone"))
        assert rows(out) == rows(expected.select(out.columns))


def test_many_versions_are_one_step_each():
    n = 10_000
    changes = [(2 * i, 0, 0, None, False, (i,)) for i in range(n)]
    asked = [(2 * i + 1, 1, None, i, False, None) for i in range(0, n, 100)]
    out, current = stateful.merge_versions(sorted(changes + asked, key=lambda r: (r[0], r[1])), None)
    assert out == [(i, (i,)) for i in range(0, n, 100)] and current == (False, (n - 1,))


def test_versions_leave_one_row_of_state(spark, tmp_path):
    path = str(tmp_path)
    many = versions(spark, [(1, i, f"v{i}", False, 0) for i in range(500)])
    later = versions(spark, [(2, 10_000, "w", False, 0)])
    parts = numbered(spark, [[(1, "view", 250.5), (1, "view", 499.5)], [(2, "view", 10_000)]])
    out = joined(spark, path, [(parts[0], many), (parts[1], later)])
    assert sorted(r["name"] for r in out.collect()) == ["v250", "v499"]
    assert state_rows(spark, path, "current") == 1


# --- cool-down ---


def test_cooldown_stream_equals_the_batch_fold(spark, tmp_path):
    rng = random.Random(4)
    fired = sorted({(rng.choice("ab"), 30 * rng.randrange(0, 3000)) for _ in range(600)}, key=lambda r: r[1])
    cuts = [fired[i: i + 150] for i in range(0, 600, 150)]
    parts = [spark.createDataFrame([(r, at(s)) for r, s in cut], "rule string, fired_at timestamp") for cut in cuts]
    out = run_parts(spark, str(tmp_path), parts, lambda s: stateful.cooldown_stream(s, 15, delay="1 day"))
    everything = spark.createDataFrame([(r, at(s)) for r, s in fired], "rule string, fired_at timestamp")
    assert rows(out) == rows(monitoring.cooldown(everything, 15, max_per_hour=None))


def test_cooldown_state_is_cleared_after_the_pause(spark, tmp_path):
    path = str(tmp_path)
    schema = "rule string, fired_at timestamp"
    parts = [spark.createDataFrame([("a", at(0)), ("a", at(899))], schema), spark.createDataFrame([("b", at(5000))], schema),
             spark.createDataFrame([("a", at(5001))], schema)]
    out = run_parts(spark, path, parts, lambda s: stateful.cooldown_stream(s, 15))
    assert rows(out) == [("a", at(0)), ("a", at(5001)), ("b", at(5000))]
    assert state_rows(spark, path, "last") == 2  # the first of a is gone, replaced by the later one


# --- time to live ---


def test_idle_key_starts_afresh_and_a_busy_one_does_not(spark, tmp_path):
    hour = 3600
    busy = [(1, "purchase" if h % 10 == 0 else "view", h * hour // 2) for h in range(100)]
    idle = [(2, "view", 0), (2, "purchase", 60), (2, "view", 10 * hour), (2, "view", 10 * hour + 3600)]
    data = sorted(busy + idle, key=lambda r: r[2])
    parts = numbered(spark, [data[i: i + 20] for i in range(0, len(data), 20)] + [[(3, "view", 1000 * hour)]])
    out = run_parts(spark, str(tmp_path), parts, lambda s: stateful.idle_totals_stream(s, hour))
    assert rows(out.select("user_id", "first_event", "events", "purchases")) == [
        (1, START, 100, 10), (2, START, 2, 1), (2, START + timedelta(hours=10), 2, 0),
    ]


def test_spans_bridge_and_touch():
    assert stateful.merge_spans([(0, 5, 1, 0), (25, 25, 1, 1), (15, 15, 1, 0)], 10) == [(0, 25, 3, 1)]
    assert stateful.merge_spans([(0, 5, 1, 0), (16, 20, 1, 0)], 10) == [(0, 5, 1, 0), (16, 20, 1, 0)]


def test_clock_totals_expire_in_the_state_store(spark, tmp_path):
    parts = numbered(spark, [[(1, "view", 0), (1, "purchase", 1)], [(1, "view", 2)]])
    # Spark keeps on running empty batches for state on the machine's clock; one run must end here.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        for name, ttl_ms, wanted in (("long", 600_000, [2, 3]), ("brief", 500, [1, 2])):
            path = str(tmp_path / name)
            for part in parts:
                part.write.mode("append").parquet(f"{path}/in")
                stream = stateful.clock_totals_stream(spark.readStream.schema(part.schema).parquet(f"{path}/in"), ttl_ms)
                jobs.start_batches(stream, jobs.batch_writer(f"{path}/out"), f"{path}/checkpoint", once=True, mode="update").awaitTermination(60)
                time.sleep(1)
            assert sorted(r["events"] for r in spark.read.parquet(f"{path}/out").collect()) == wanted
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
