"""Sinks: tables, files, messages, rejects, upserts, metrics and retention."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.asof import latest_per_key
from eventloom.operators.transforms import good_rows, rejected_rows


# JSON text keeps microseconds; Spark's default would cut times to milliseconds.
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _as_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns), _JSON).alias("value")


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Materialises a derived table as parquet."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_by_date(df: DataFrame, path: str, ts: str, column: str = "event_date") -> None:
    """One folder per day, so that readers and retention prune by it.

    Rebalancing gathers a day's rows into few files, and AQE splits a day that is too large
    for one task.
    """
    dated = df.withColumn(column, F.date_format(F.col(ts), "yyyy-MM-dd"))
    dated.hint("rebalance", column).write.mode("append").partitionBy(column).parquet(path)


def write_lines(df: DataFrame, path: str, as_json: bool = True) -> None:
    """Line files for verification."""
    rows = df.select(_as_json(df)) if as_json else df
    rows.write.mode("overwrite").text(path)


def to_messages(df: DataFrame, key: str = "user_id") -> DataFrame:
    """``(key, value)`` messages with the whole row as JSON."""
    return df.select(F.col(key).cast("string").alias("key"), _as_json(df))


def write_kafka_stream(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str = "user_id"):
    """Needs the Kafka connector on the class path."""
    return (
        to_messages(df, key)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_split(split: DataFrame, good_path: str, reject_path: str, mode: str = "append") -> None:
    """Good rows to one table, rejected rows with their reason to another; one evaluation."""
    split = split.persist()
    try:
        good_rows(split).write.mode(mode).parquet(good_path)
        rejected_rows(split).write.mode(mode).parquet(reject_path)
    finally:
        split.unpersist()


def append_changes(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of an upsert table kept as change folders, one per batch.

    Writing costs what the batch costs, whatever the size of the table, and a repeated batch
    replaces its own folder. ``current_rows`` merges on read; where a database or a table
    format with MERGE is at hand, merge there instead.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def current_rows(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The upsert table: the last change per key wins, columns added later are NULL before."""
    changes = spark.read.option("mergeSchema", True).option("basePath", path).parquet(path)
    return latest_per_key(changes, keys, ["batch", *order]).drop("batch")


def compact_changes(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], keep: int = 1
) -> int | None:
    """Merges all change folders but the newest ``keep`` into the newest of those merged, and
    returns its batch (None where there is nothing to merge).

    Readers see the same table before, between and after the steps, also where it stops half
    way: the merged rows are written beside the table, their files are moved into the newest of
    the merged folders, whose rows they repeat, and only then are the older folders deleted. The
    last folder must stay unmerged while its batch may still be repeated.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    batches = sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("batch="))
    merged = batches[: len(batches) - keep]
    if len(merged) < 2:
        return None
    folders = [f"{path}/batch={b}" for b in merged]
    old = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*folders)
    beside = f"{path}/_compacted-{merged[-1]}"  # readers pass over names with an underscore
    latest_per_key(old, keys, ["batch", *order]).drop("batch").write.mode("overwrite").parquet(beside)
    for status in fs.listStatus(hadoop.Path(beside)):
        name = status.getPath().getName()
        if name.startswith("part-") and not fs.rename(status.getPath(), hadoop.Path(f"{folders[-1]}/{name}")):
            raise OSError(f"could not move {name} into {folders[-1]}")
    for folder in (*folders[:-1], beside):
        fs.delete(hadoop.Path(folder), True)
    return merged[-1]


def jdbc_upsert_batch(url: str, table: str, properties: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer into a database: appends the batch to a staging table named by
    the batch, from which the database merges by primary key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.jdbc(url, f"{table}_staging_{batch_id}", mode="overwrite", properties=properties)

    return write


def append_metrics(checks: DataFrame, path: str, measured_at: Column | None = None) -> None:
    """Check rows ``(test_name, result, metrics)`` into the metrics table."""
    stamp = F.current_timestamp() if measured_at is None else measured_at
    checks.withColumn("measured_at", stamp).write.mode("append").parquet(path)


def purge_dated(spark: SparkSession, path: str, oldest: str, column: str = "event_date") -> list[str]:
    """Drops whole day folders older than ``oldest`` (yyyy-MM-dd) without reading any data."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{column}=") and name.split("=", 1)[1] < oldest:
            fs.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)
