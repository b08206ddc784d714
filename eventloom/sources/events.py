"""Event sources: message streams, object-store files, and their shared record parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.asof import latest_per_key

# The stream's record. Times are instants, because watermarks need TIMESTAMP.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("processing_time", T.TimestampType()),
    ]
)

# The registered UserEvent record.
USER_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("session_id", T.StringType()),
        T.StructField("user_agent", T.StringType()),
    ]
)

# The end-to-end test message.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField("browser", T.StringType()),
                    T.StructField("platform", T.StringType()),
                    T.StructField("version", T.StringType()),
                ]
            ),
        ),
        T.StructField("value", T.IntegerType()),
        T.StructField("test_run_id", T.StringType()),
    ]
)

CORRUPT = "_corrupt_record"
# 9999-12-31T23:59:59.999Z: later milliseconds have no timestamp.
_LAST_MILLIS = 253_402_300_799_999


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def parse_messages(df: DataFrame, schema: T.StructType = EVENT_SCHEMA, value: str = "value") -> DataFrame:
    """Typed columns from a JSON message column; unparsable text is kept in ``_corrupt_record``."""
    text = F.col(value).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.select(F.from_json(text, with_corrupt(schema), options).alias("_m")).select("_m.*")


def millis_to_timestamp(millis: Column) -> Column:
    """Epoch milliseconds as an instant; NULL where no timestamp can hold them."""
    return F.when(F.abs(millis) <= _LAST_MILLIS, F.timestamp_millis(
        F.when(F.abs(millis) <= _LAST_MILLIS, millis)
    ))


def from_user_event(df: DataFrame) -> DataFrame:
    """Registered UserEvent records as rows of the event stream (types in lower case)."""
    return df.select(
        "user_id",
        F.lower("event_type").alias("event_type"),
        millis_to_timestamp(F.col("timestamp")).alias("event_timestamp"),
        "session_id",
        F.to_json("properties").alias("payload"),
    )


def has_source(spark: SparkSession, name: str) -> bool:
    """Whether a data source's connector is on the class path."""
    lookup = spark._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource
    try:
        lookup(name, spark._jsparkSession.sessionState().conf())
    except Exception:
        return False
    return True


def kafka_available(spark: SparkSession) -> bool:
    return has_source(spark, "kafka")


def event_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None,
    schema: T.StructType = EVENT_SCHEMA, **options: str,
) -> DataFrame:
    """An unbounded topic of JSON events. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return parse_messages(reader.load(), schema)


def event_file_stream(
    spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA,
    files_per_trigger: int = 1000,
) -> DataFrame:
    """New JSON-lines files under an object-store prefix, as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(path)
    )


def object_store(
    spark: SparkSession, path: str, schema: T.StructType, record_format: str = "json",
    streaming: bool = False, topics_dir: str | None = None, files_per_trigger: int = 1000,
    archive: str | None = None,
) -> DataFrame:
    """Bulk or continuous ingestion of object-store files under an optional prefix.

    A stream takes at most ``files_per_trigger`` files a batch and knows the names it has read: a file
    rewritten under its name does not come again. With ``archive``, a folder outside ``path``,
    files move there after their batch has been committed, so that the prefix does not grow.
    """
    if record_format not in ("json", "avro", "parquet"):
        raise ValueError(f"unsupported record format {record_format!r}")
    where = f"{path.rstrip('/')}/{topics_dir}" if topics_dir else path
    if streaming:
        reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
        if archive:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    else:
        reader = spark.read
    return (
        reader.schema(schema).format(record_format).option("recursiveFileLookup", "true").load(where)
    )


def compacted_latest(
    changes: DataFrame, key: str, ts: str, offset: str, tombstone: Column | None = None
) -> DataFrame:
    """The table a compacted topic stands for: the newest record per key."""
    return latest_per_key(changes, key, [ts, offset], tombstone)


def with_event_time(df: DataFrame, ts: str = "event_timestamp", delay: str = "5 seconds") -> DataFrame:
    """Event time as an instant plus a bounded-out-of-orderness watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
