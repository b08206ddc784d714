from helpers import at, events, rows
from pyspark.sql import functions as F

from eventloom.operators import windows
from eventloom.operators.anomaly import anomaly_detection
from eventloom.streaming import jobs


def feed(spark, path, batches, run):
    """One run of the job per batch of events, on the same checkpoint."""
    offset = 0
    for data in batches:
        frame = events(spark, data).withColumn("event_id", F.col("event_id") + offset)
        frame = frame.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
        frame.write.mode("append").parquet(f"{path}/in")
        offset += len(data)
        run(spark.readStream.schema(frame.schema).parquet(f"{path}/in"))
    return spark.read.parquet(f"{path}/in")


def test_window_closes_with_the_watermark_and_late_rows_drop(spark, tmp_path):
    path = str(tmp_path)
    batches = [
        [(1, "view", 10), (1, "view", 3500)],
        [(1, "view", 3604)],                    # watermark 3599: the first hour stays open
        [(1, "view", 3599), (1, "view", 3605)],  # still accepted; watermark 3600 closes it
        [(1, "view", 20), (1, "view", 9000)],    # 20 is behind the watermark
    ]

    def run(stream):
        jobs.start_table(
            jobs.hourly_stream(stream), f"{path}/out", f"{path}/checkpoint", once=True
        ).awaitTermination()

    feed(spark, path, batches, run)
    out = spark.read.parquet(f"{path}/out").orderBy("window_start").collect()
    assert [(r.window_start, r.total_events) for r in out] == [(at(0), 3), (at(3600), 2)]


def test_anomaly_stream_equals_batch_and_keeps_late_rows_apart(spark, tmp_path):
    path = str(tmp_path)
    batches = [
        [(1, "view", 10 * i) for i in range(30)],
        [(1, "click", 290 + i) for i in range(10)] + [(2, "view", 400)],
        [(1, "view", 200), (1, "view", 500), (3, "login", 100_000)],  # 200 is late
        [(1, "view", 200_000)],
    ]
    write = jobs.anomaly_writer(spark, path)

    def run(stream):
        jobs.start_batches(stream, write, f"{path}/checkpoint", once=True).awaitTermination()

    table = feed(spark, path, batches, run)
    late = spark.read.parquet(f"{path}/late").select("event_timestamp").collect()
    assert [r[0] for r in late] == [at(200)]
    accepted = table.where(~((F.col("event_timestamp") == F.lit(at(200))) & (F.col("event_id") > 40)))
    done = F.col("event_timestamp") <= F.lit(at(200_000 - 5))
    expected = anomaly_detection(accepted, keep=("event_id",)).where(done)
    got = spark.read.parquet(f"{path}/flagged").drop("batch")
    assert rows(got.select(expected.columns)) == rows(expected)


def test_repeated_batch_replaces_its_output(spark, tmp_path):
    path = str(tmp_path)
    write = jobs.anomaly_writer(spark, path)
    first = events(spark, [(1, "view", i) for i in range(5)])
    first = first.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    later = first.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("interval 1 hour"))
    write(first, 0)
    write(later, 1)
    once = rows(spark.read.parquet(f"{path}/flagged"))
    write(later, 1)
    assert rows(spark.read.parquet(f"{path}/flagged")) == once


def test_cooldown_continues_over_batches(spark, tmp_path):
    path = str(tmp_path)
    write = jobs.cooldown_writer(spark, path)
    for i, seconds in enumerate([[0, 600, 900], [1000, 1799], [1800, 1900]]):
        batch = spark.createDataFrame([("r", at(s)) for s in seconds], "rule string, fired_at timestamp")
        write(batch, i)
    sent = spark.read.parquet(path).orderBy("fired_at").collect()
    assert [r.fired_at for r in sent] == [at(0), at(900), at(1800)]


def test_split_writer_and_session_parts(spark, tmp_path):
    path = str(tmp_path)
    stream = events(spark, [(1, "view", 0), (1, "error", 5), (2, "view", 9)])

    def classify(batch):
        return batch.withColumn("error_reason", F.when(F.col("event_type") == "error", "type"))

    jobs.split_writer(f"{path}/good", f"{path}/bad", classify)(stream, 0)
    assert spark.read.parquet(f"{path}/good").count() == 2
    assert [r.error_reason for r in spark.read.parquet(f"{path}/bad").collect()] == ["type"]
    write = jobs.session_parts_writer(f"{path}/parts")
    write(stream.where("event_id < 1"), 0)
    write(stream.where("event_id >= 1"), 1)
    assert rows(jobs.current_sessions(spark, f"{path}/parts")) == rows(windows.user_sessions(stream))


def test_read_files_are_archived_and_not_read_again(spark, tmp_path):
    from eventloom.sources import events as event_sources

    schema = event_sources.EVENT_SCHEMA
    drop, archive, out = tmp_path / "drop", tmp_path / "archive", str(tmp_path / "out")
    drop.mkdir()

    def run():
        stream = event_sources.object_store(
            spark, str(drop), schema, streaming=True, files_per_trigger=1, archive=str(archive)
        )
        jobs.start_table(stream.select("event_id"), out, f"{out}-checkpoint", once=True).awaitTermination()

    for i in range(3):
        (drop / f"f{i}.json").write_text(f'{{"event_id": {i}}}\n')
    run()
    archived = {p.name for p in archive.rglob("*.json")}
    assert archived and archived | {p.name for p in drop.iterdir()} == {"f0.json", "f1.json", "f2.json"}
    for i in range(2):
        (drop / f"f{i}.json").write_text('{"event_id": 99}\n')  # rewritten under a name that was read
    (drop / "f3.json").write_text('{"event_id": 3}\n')
    run()
    assert rows(spark.read.schema("event_id bigint").parquet(out)) == [(0,), (1,), (2,), (3,)]
