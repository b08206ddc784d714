"""File readers with explicit schemas. Malformed records are kept, never dropped."""

from __future__ import annotations

from py4j.java_gateway import JavaClass
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.sources.events import (
    CORRUPT,
    USER_EVENT_SCHEMA,
    has_source,
    with_corrupt,
)

CSV_COLUMNS = ("user_id", "event_type", "timestamp", "properties", "session_id")

# Fixed value: the registered Avro record. ``logicalType`` beside the type has no effect, so
# the timestamp is a plain long.
AVRO_SCHEMA = """{"type": "record", "name": "UserEvent", "fields": [
 {"name": "user_id", "type": "string"},
 {"name": "event_type", "type": {"type": "enum", "name": "EventType",
  "symbols": ["LOGIN", "LOGOUT", "PURCHASE", "VIEW", "CLICK"]}},
 {"name": "timestamp", "type": "long"},
 {"name": "properties", "type": {"type": "map", "values": "string"}, "default": {}},
 {"name": "session_id", "type": ["null", "string"], "default": null},
 {"name": "user_agent", "type": ["null", "string"], "default": null}]}"""


_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType = USER_EVENT_SCHEMA
) -> DataFrame:
    """Newline JSON; the text of a line that does not parse is in ``_corrupt_record``.

    Lines are parsed under the whole schema, whatever columns are used later: the JSON source
    would skip the others, and not notice that one of them has the wrong type.
    """
    record = F.from_json("value", with_corrupt(schema), _PERMISSIVE).alias("_record")
    return read_lines(spark, path).where(F.trim("value") != "").select(record).select("_record.*")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines ``(value)``, for syntax checks."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...] = CSV_COLUMNS) -> DataFrame:
    """Header CSV, all columns text; quotes inside a quoted cell are escaped by a backslash."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.option("header", True).schema(schema).csv(path)


def _with_text_time(schema: T.StructType) -> T.StructType:
    fields = [
        T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
        for f in schema.fields
    ]
    return with_corrupt(T.StructType(fields))


def read_xml(
    spark: SparkSession, path: str, row_tag: str = "event",
    schema: T.StructType = USER_EVENT_SCHEMA,
) -> DataFrame:
    """``<events><event>...``; time stays text, so that a bad one is a rule's business.

    What follows markup that does not parse is lost to the file's reader: where records may be
    broken, use ``read_xml_records``.
    """
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .options(**_PERMISSIVE)
        .schema(_with_text_time(schema))
        .load(path)
    )


# What may stand between records: declarations, comments and the root element's tags.
_BETWEEN_RECORDS = r"(?s)<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>|</?{root}(\s[^>]*)?>"


def read_xml_records(
    spark: SparkSession, path: str, row_tag: str = "event", root_tag: str = "events",
    schema: T.StructType = USER_EVENT_SCHEMA, attributes: bool = False,
) -> DataFrame:
    """As ``read_xml``, but what is broken costs nothing beyond itself.

    The text source cuts files at the record's start tag, in parallel also within a file; each
    piece up to its end tag is one record and is parsed alone. A record without an end tag (also
    one cut off with its file), a record that does not parse, and text between records that
    is neither a comment nor the root's tags become rows with that text in ``_corrupt_record``.
    ``attributes`` says that records' start tags have attributes (``<event id=...>``). A start tag inside
    a comment or CDATA counts as one; records do not nest.
    """
    start, end = f"<{row_tag} " if attributes else f"<{row_tag}>", f"</{row_tag}>"
    pieces = spark.read.option("lineSep", start).text(path)
    closed = F.instr("value", end) > 0
    record = F.when(closed, F.concat(F.lit(start), F.substring_index("value", end, 1), F.lit(end)))
    after = F.when(closed, F.expr(f"substr(value, instr(value, '{end}') + {len(end)})")).otherwise(F.col("value"))
    rest = F.trim(F.regexp_replace(after, _BETWEEN_RECORDS.format(root=root_tag), ""), F.lit(" \t\r\n"))
    parts = F.array(
        F.struct(record.alias("value"), F.lit(None).cast("string").alias("stray")),
        F.struct(F.lit(None).cast("string").alias("value"), F.nullif(rest, F.lit("")).alias("stray")),
    )
    lines = pieces.select(F.inline(F.filter(parts, lambda p: p["value"].isNotNull() | p["stray"].isNotNull())))
    parsed = parse_xml(lines, "value", schema, keep=("stray",))
    return parsed.withColumn(CORRUPT, F.coalesce("stray", CORRUPT)).drop("stray")


def parse_xml(
    lines: DataFrame, column: str = "value", schema: T.StructType = USER_EVENT_SCHEMA,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One element per line; the text of one that does not parse is in ``_corrupt_record``.
    ``keep`` names further columns to carry through."""
    full = _with_text_time(schema)
    parsed = F.from_xml(F.col(column), full, _PERMISSIVE).alias("_record")
    # A broken element may still give its first fields; they count as absent.
    broken = F.col(f"_record.{CORRUPT}").isNotNull()
    fields = [F.when(~broken, F.col(f"_record.{f.name}")).alias(f.name) for f in schema.fields]
    corrupt = F.col(f"_record.{CORRUPT}").alias(CORRUPT)
    return lines.select(parsed, *keep).select(*fields, corrupt, *keep)


def avro_available(spark: SparkSession) -> bool:
    return has_source(spark, "avro")


def protobuf_available(spark: SparkSession) -> bool:
    return isinstance(spark._jvm.org.apache.spark.sql.protobuf.functions, JavaClass)


def _require(present: bool, package: str) -> None:
    if not present:
        raise RuntimeError(f"this needs the external {package} package on the class path")


def read_avro(spark: SparkSession, path: str, avro_schema: str = AVRO_SCHEMA) -> DataFrame:
    _require(avro_available(spark), "spark-avro")
    return spark.read.format("avro").option("avroSchema", avro_schema).load(path)


def decode_avro(df: DataFrame, column: str = "value", avro_schema: str = AVRO_SCHEMA) -> DataFrame:
    """Decoded record beside the raw bytes; NULL where the bytes do not decode."""
    from pyspark.sql.avro.functions import from_avro

    _require(avro_available(df.sparkSession), "spark-avro")
    return df.withColumn("record", from_avro(F.col(column), avro_schema, {"mode": "PERMISSIVE"}))


def decode_protobuf(
    df: DataFrame, descriptor_file: str, column: str = "value", message: str = "UserEvent"
) -> DataFrame:
    """``descriptor_file`` is the compiled descriptor set of the message."""
    from pyspark.sql.protobuf.functions import from_protobuf

    _require(protobuf_available(df.sparkSession), "spark-protobuf")
    return df.withColumn(
        "record",
        from_protobuf(F.col(column), message, descriptor_file, {"mode": "PERMISSIVE"}),
    )


def read_evolved(
    old: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None
) -> DataFrame:
    """Old data under a newer reader schema: new fields are NULL or their default, removed
    fields are dropped, kept fields are cast."""
    defaults = defaults or {}
    columns = []
    for field in schema.fields:
        if field.name in old.columns:
            column = F.col(field.name).cast(field.dataType)
        else:
            column = F.lit(defaults.get(field.name)).cast(field.dataType)
        columns.append(column.alias(field.name))
    return old.select(*columns)


def backward_compatible(
    old: T.StructType, new: T.StructType, defaults: dict[str, object] | None = None
) -> list[str]:
    """Why data written as ``old`` cannot be read as ``new``; empty when it can."""
    defaults = defaults or {}
    problems = []
    known = {f.name: f for f in old.fields}
    for field in new.fields:
        before = known.get(field.name)
        if before is None:
            if not field.nullable and field.name not in defaults:
                problems.append(f"{field.name}: new field without a default")
        elif before.dataType != field.dataType and not _widens(before.dataType, field.dataType):
            problems.append(
                f"{field.name}: {before.dataType.simpleString()} to {field.dataType.simpleString()}"
            )
    return problems


def _widens(old: T.DataType, new: T.DataType) -> bool:
    order = [T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]
    return old in order and new in order and order.index(old) < order.index(new)
