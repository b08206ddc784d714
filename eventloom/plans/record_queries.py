"""Queries: per-record transforms, validation, set comparison, and file and message sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions.exprs import payload_amount
from eventloom.operators import compare, flow, gates, transforms, validation
from eventloom.plans.catalog import Tables, query
from eventloom.sinks import tables as sinks
from eventloom.sources import events as event_sources
from eventloom.sources import files

RENAME = {"user_name": "full_name", "user_email": "email"}
CAST = {"user_id": "int32", "login_time": "int64", "active": "boolean", "score": "float64"}
CHAIN = """
transforms=renameField,convertType,addTimestamp
transforms.renameField.type=org.apache.kafka.connect.transforms.ReplaceField$Value
transforms.renameField.renames=user_name:full_name
transforms.convertType.type=org.apache.kafka.connect.transforms.Cast$Value
transforms.convertType.spec=user_id:int32,login_time:int64
transforms.addTimestamp.type=org.apache.kafka.connect.transforms.InsertField$Value
transforms.addTimestamp.timestamp.field=processed_at
"""
FIXED_MILLIS = 1692144000000

_CASTED = """record_id, TRY_CAST(user_id AS INTEGER) AS user_id, CAST(login_time AS BIGINT) AS login_time,
    active = 'true' AS active, round(CAST(score AS DOUBLE), 6) AS score"""


@query("smt_rename", """
    SELECT record_id, user_name AS full_name, user_email AS email, user_id FROM transform_rows""")
def _(t: Tables):
    rows = t.transform_rows.select("record_id", "user_name", "user_email", "user_id")
    return transforms.rename_fields(rows, {**RENAME, "absent": "ignored"})


@query("smt_cast", f"SELECT {_CASTED} FROM transform_rows")
def _(t: Tables):
    rows = t.transform_rows.select("record_id", "user_id", "login_time", "active", "score")
    return transforms.cast_fields(rows, CAST)


@query("smt_extract", "SELECT user_id FROM transform_rows")
def _(t: Tables):
    return transforms.extract_field(t.transform_rows.select("nested"), "nested.user_id")


@query("smt_extract_deep", "SELECT user_email AS email FROM transform_rows")
def _(t: Tables):
    return transforms.extract_field(t.transform_rows.select("nested"), "nested.details.email")


@query("smt_insert_ts", """
    SELECT event_id, epoch_us(processing_time) // 1000 AS processed_at FROM user_events""")
def _(t: Tables):
    rows = transforms.insert_timestamp(
        t.user_events.select("event_id", "processing_time"), "processed_at", F.col("processing_time")
    )
    return rows.drop("processing_time")


@query("smt_insert_static", """
    SELECT event_id, 'event-platform' AS source, epoch_us(processing_time) // 1000 AS log_timestamp
    FROM user_events""")
def _(t: Tables):
    properties = {
        "transforms": "addFields",
        "transforms.addFields.type": "InsertField$Value",
        "transforms.addFields.timestamp.field": "log_timestamp",
        "transforms.addFields.static.field": "source",
        "transforms.addFields.static.value": "event-platform",
    }
    rows = t.user_events.select("event_id", "processing_time")
    chained = transforms.apply_chain(rows, properties, F.col("processing_time"))
    return chained.drop("processing_time")


@query("smt_filter", "SELECT record_id, user_name FROM transform_rows WHERE active = 'true'")
def _(t: Tables):
    return transforms.filter_records(
        t.transform_rows.select("record_id", "user_name", "active"), "active = 'true'"
    ).drop("active")


@query("smt_chain", f"""
    SELECT record_id, user_name AS full_name, TRY_CAST(user_id AS INTEGER) AS user_id,
      CAST(login_time AS BIGINT) AS login_time, CAST({FIXED_MILLIS} AS BIGINT) AS processed_at
    FROM transform_rows""")
def _(t: Tables):
    rows = t.transform_rows.select("record_id", "user_name", "user_id", "login_time")
    return transforms.apply_chain(rows, CHAIN, FIXED_MILLIS)


@query("smt_compare", """
    SELECT user_id, record_id, CAST(1 AS BIGINT) AS left_count, CAST(0 AS BIGINT) AS right_count
    FROM transform_rows WHERE record_id % 101 = 0
    UNION ALL SELECT CAST(record_id AS VARCHAR), record_id, 0, 1 FROM transform_rows
    WHERE record_id % 101 = 0""")
def _(t: Tables):
    rows = t.transform_rows.select("record_id", "user_id")
    expected = rows.withColumn("user_id", F.col("record_id").cast("string"))
    return compare.record_set_diff(rows, expected)


@query("smt_invalid", """
    SELECT record_id, 'user_id is not int32' AS error_reason FROM transform_rows
    WHERE record_id % 101 = 0""")
def _(t: Tables):
    rows = t.transform_rows.select("record_id", "user_id", "login_time")
    split = transforms.split_rejects(rows, transforms.cast_errors(rows, CAST))
    return transforms.rejected_rows(split).select("record_id", "error_reason")


@query("record_set_diff", """
    WITH l AS (SELECT event_type, user_id, count(*) AS n FROM flow_source GROUP BY ALL),
      r AS (SELECT event_type, user_id, count(*) AS n FROM flow_sink GROUP BY ALL)
    SELECT event_type, user_id, coalesce(l.n, 0) AS left_count, coalesce(r.n, 0) AS right_count
    FROM l FULL JOIN r USING (event_type, user_id) WHERE l.n IS DISTINCT FROM r.n""")
def _(t: Tables):
    columns = ["event_type", "user_id"]
    return compare.record_set_diff(t.flow_source.select(columns), t.flow_sink.select(columns))


@query("split_dlq", """
    SELECT event_id, event_type, CASE WHEN event_type = 'error' AND event_id % 50 = 0
        THEN 'event_type; event_id' WHEN event_type = 'error' THEN 'event_type'
        WHEN event_id % 50 = 0 THEN 'event_id' END AS error_reason
    FROM user_events""")
def _(t: Tables):
    rows = t.user_events.select("event_id", "event_type")
    errors = transforms.broken_checks(
        [("event_type", F.col("event_type") != "error"), ("event_id", F.col("event_id") % 50 != 0)]
    )
    return transforms.split_rejects(rows, errors)


@query("sink_routed_by_date", """
    SELECT strftime(event_timestamp, '%Y-%m-%d') AS event_date, 'user-events-'
      || strftime(event_timestamp, '%Y-%m-%d') AS topic, count(*) AS records
    FROM user_events GROUP BY ALL""")
def _(t: Tables):
    routed = transforms.route_by_date(t.user_events, "user-events", F.col("event_timestamp"))
    path = t.scratch("routed")
    sinks.write_by_date(routed.select("event_id", "event_timestamp", "topic"), path, "event_timestamp")
    stored = t.spark.read.schema(
        "event_id bigint, event_timestamp timestamp_ntz, topic string, event_date string"
    ).parquet(path)
    return stored.groupBy("event_date", "topic").agg(F.count(F.lit(1)).alias("records"))


@query("retention_purge", """
    SELECT event_id, event_timestamp FROM user_events
    WHERE event_timestamp >= (SELECT max(event_timestamp) FROM user_events) - INTERVAL 7 DAY""")
def _(t: Tables):
    return flow.retain(t.user_events.select("event_id", "event_timestamp"), "event_timestamp", 7)


@query("sink_upsert", """
    SELECT user_id, ver, user_name, user_tier, CASE WHEN ver = 1 THEN country END AS country
    FROM users_latest""")
def _(t: Tables):
    """Two batches through the change folders: the second brings a new column and new versions."""
    path, users = t.scratch("upsert"), t.users
    write = sinks.append_changes(path)
    first = users.where("ver = 0").select("user_id", "ver", "user_name", "user_tier")
    write(first, 0)
    write(users.where("ver = 1").select("user_id", "ver", "user_name", "user_tier", "country"), 1)
    return sinks.current_rows(t.spark, path, ["user_id"], ["ver"])


@query("sink_table", """
    SELECT user_id, window_start, total_events, total_revenue FROM hourly""")
def _(t: Tables):
    path = t.scratch("table")
    sinks.write_table(t.hourly, path)
    return t.spark.read.schema(t.hourly.schema).parquet(path).select(
        "user_id", "window_start", "total_events", "total_revenue"
    )


@query("sink_kafka", """
    SELECT CAST(user_id AS VARCHAR) AS "key", event_id, event_type FROM user_events""")
def _(t: Tables):
    """Messages as a topic would hold them, decoded again."""
    sent = sinks.to_messages(t.user_events.select("user_id", "event_id", "event_type"))
    body = F.from_json("value", "event_id bigint, event_type string")
    return sent.select("key", body.alias("b")).select("key", "b.event_id", "b.event_type")


@query("sink_file", "SELECT event_id, event_type, payload FROM user_events")
def _(t: Tables):
    path = t.scratch("lines")
    sinks.write_lines(t.user_events.select("event_id", "event_type", "payload"), path)
    return t.spark.read.schema("event_id bigint, event_type string, payload string").json(path)


# --- sources -------------------------------------------------------------------------------

_STREAM_COLUMNS = ["event_id", "user_id", "event_type", "event_timestamp", "session_id", "payload"]
_STREAM_SQL = """SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
    event_timestamp, session_id, payload FROM user_events"""


def _messages(t: Tables):
    return sinks.to_messages(t.user_events)


@query("src_event_stream", _STREAM_SQL)
def _(t: Tables):
    return event_sources.parse_messages(_messages(t)).select(*_STREAM_COLUMNS)


@query("src_object_store_json", _STREAM_SQL)
def _(t: Tables):
    path = t.scratch("objects")
    sinks.write_lines(t.user_events, f"{path}/topics/user-events")
    loaded = event_sources.object_store(
        t.spark, path, event_sources.EVENT_SCHEMA, topics_dir="topics"
    )
    return loaded.select(*_STREAM_COLUMNS)


@query("src_json_lines", """
    WITH p AS (SELECT json_valid(value) AND CASE WHEN json_valid(value)
        THEN json_type(value, '$.timestamp') IN ('BIGINT', 'UBIGINT') END AS ok FROM json_lines)
    SELECT count(*) AS lines, count(*) FILTER (ok) AS parsed, count(*) FILTER (NOT ok) AS corrupt FROM p""")
def _(t: Tables):
    """Under the full schema: a line whose time is text is corrupt, like one cut off."""
    path = t.scratch("json")
    t.json_event_lines.select("value").write.text(path)
    rows = files.read_json_lines(t.spark, path)
    return rows.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col(files.CORRUPT).isNull() & F.col("user_id").isNotNull()).alias("parsed"),
        F.count(files.CORRUPT).alias("corrupt"),
    )


@query("src_csv", """
    SELECT event_id, 'user' || user_id AS user_id, upper(event_type) AS event_type, props AS properties
    FROM events""")
def _(t: Tables):
    path = t.scratch("csv")
    rows = t.raw_events.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_id"),
        F.upper("event_type").alias("event_type"),
        F.col("event_id").cast("string").alias("timestamp"),
        F.col("props").alias("properties"),
        F.lit("s1").alias("session_id"),
    )
    rows.write.option("header", True).csv(path)
    read = files.read_csv(t.spark, path)
    return read.select(
        F.col("timestamp").cast("bigint").alias("event_id"), "user_id", "event_type", "properties"
    )


def _user_event_rows(t: Tables):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.raw_events.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_type") == "signup", "LOGIN")
        .otherwise(F.upper("event_type")).alias("event_type"),
        millis.alias("timestamp"),
        F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("properties"),
        F.col("event_id").cast("string").alias("session_id"),
    )


_USER_EVENT_SQL = """SELECT CAST(event_id AS VARCHAR) AS session_id, 'user' || user_id AS user_id,
    CASE event_type WHEN 'signup' THEN 'LOGIN' ELSE upper(event_type) END AS event_type,
    epoch_us(ts) // 1000 AS "timestamp", json_extract_string(props, '$.k') AS k FROM events"""


@query("src_xml", _USER_EVENT_SQL)
def _(t: Tables):
    path = t.scratch("xml")
    rows = _user_event_rows(t).withColumn("properties", F.struct(F.col("properties")["k"].alias("k")))
    rows.write.format("xml").option("rootTag", "events").option("rowTag", "event").save(path)
    read = files.read_xml(t.spark, path)
    return read.select(
        "session_id", "user_id", "event_type", F.col("timestamp").cast("bigint").alias("timestamp"),
        F.col("properties")["k"].alias("k"),
    )


@query("src_xml_records", """
    WITH e AS (SELECT *, event_id % 50 IN (20, 30) AS broken FROM events)
    SELECT CASE WHEN NOT broken THEN CAST(event_id AS VARCHAR) END AS session_id,
      CASE WHEN NOT broken THEN 'user' || user_id END AS user_id,
      CASE WHEN NOT broken THEN CASE event_type WHEN 'signup' THEN 'LOGIN' ELSE upper(event_type) END END AS event_type,
      CASE WHEN NOT broken THEN json_extract_string(props, '$.k') END AS k,
      CASE WHEN broken THEN event_id END AS broken_event FROM e""")
def _(t: Tables):
    """Documents in whose middle some records have a wrong tag and others no end: all the others
    come, and the broken ones with their text."""
    path = t.scratch("xml-records")
    rows = _user_event_rows(t).withColumn("properties", F.struct(F.col("properties")["k"].alias("k")))
    at = F.col("session_id").cast("bigint")
    record = F.to_xml(F.struct("session_id", "user_id", "event_type", "timestamp", "properties"), {"rowTag": "event"})
    record = (
        F.when(at % 50 == 20, F.replace(record, F.lit("</user_id>"), F.lit("</user>")))
        .when(at % 50 == 30, F.replace(record, F.lit("</event>"), F.lit(""))).otherwise(record)
    )
    # Fifty records a document.
    documents = rows.groupBy(F.call_function("div", at, F.lit(50)).alias("d")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at.alias("at"), record.alias("r")))), lambda x: x["r"]), "\n").alias("r")
    )
    text = F.concat(F.lit('<?xml version="1.0"?>\n<!-- events -->\n<events>\n'), F.col("r"), F.lit("\n</events>"))
    documents.select(text.alias("value")).write.text(path)
    read = files.read_xml_records(t.spark, path)
    broken = F.regexp_extract(files.CORRUPT, "<session_id>([0-9]+)<", 1)
    return read.select(
        "session_id", "user_id", "event_type", F.col("properties")["k"].alias("k"),
        F.nullif(broken, F.lit("")).cast("bigint").alias("broken_event"),
    )


@query("format_roundtrip", """
    SELECT f AS "format", count(*) AS records, CAST(0 AS BIGINT) AS changed, 100.0::DOUBLE AS fidelity_pct
    FROM events, (VALUES ('json'), ('csv'), ('xml'), ('parquet')) AS v(f) GROUP BY f""")
def _(t: Tables):
    """Write, read back and compare per format."""
    path = t.scratch("roundtrip")
    rows = _user_event_rows(t).select(
        "user_id", "event_type", F.col("timestamp").cast("string").alias("timestamp"), "session_id"
    )
    out = None
    for name in ("json", "csv", "xml", "parquet"):
        target = f"{path}/{name}"
        options = {"rootTag": "events", "rowTag": "event"} if name == "xml" else {}
        rows.write.format(name).options(**options).save(target)
        read = t.spark.read.format(name).options(**options).schema(rows.schema).load(target)
        diff = compare.record_set_diff(rows, read).agg(
            F.coalesce(F.sum(F.abs(F.col("left_count") - F.col("right_count"))), F.lit(0))
            .cast("bigint").alias("changed")
        )
        total = rows.agg(F.count(F.lit(1))).scalar()
        row = diff.select(
            F.lit(name).alias("format"), total.alias("records"), "changed",
            ((total - F.col("changed")) / total * 100).alias("fidelity_pct"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("schema_evolution_read", """
    SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS user_agent, 'web' AS channel
    FROM user_events""")
def _(t: Tables):
    schema = files.T.StructType(
        [
            files.T.StructField("event_id", files.T.LongType()),
            files.T.StructField("user_id", files.T.LongType()),
            files.T.StructField("user_agent", files.T.StringType()),
            files.T.StructField("channel", files.T.StringType()),
        ]
    )
    return files.read_evolved(t.user_events, schema, {"channel": "web"})


# --- validation ----------------------------------------------------------------------------

_JSON_RULES = """
    WITH d AS (SELECT *, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value END AS j
               FROM json_lines),
      p AS (SELECT *, j->>'user_id' AS u, j->>'event_type' AS e, j->>'timestamp' AS s,
              json_type(j, '$.timestamp') AS st, json_type(j, '$.properties.k') AS kt,
              json_exists(j, '$.extra') AS more FROM d)"""


@query("validate_json_syntax", "SELECT event_id, json_valid(value) AS is_valid FROM json_lines")
def _(t: Tables):
    return validation.validate_json_syntax(t.json_event_lines).select("event_id", "is_valid")


@query("validate_json_schema", f"""
    {_JSON_RULES}
    SELECT event_id, coalesce(ok AND length(u) >= 1
      AND e IN ('LOGIN', 'LOGOUT', 'PURCHASE', 'VIEW', 'CLICK') AND st IN ('UBIGINT', 'BIGINT')
      AND TRY_CAST(s AS BIGINT) >= 0 AND kt = 'VARCHAR' AND NOT more, false) AS is_valid,
      CASE WHEN NOT ok THEN 'not_json' ELSE concat_ws(',',
        CASE WHEN length(u) < 1 THEN 'user_id' END,
        CASE WHEN e NOT IN ('LOGIN', 'LOGOUT', 'PURCHASE', 'VIEW', 'CLICK') THEN 'event_type' END,
        CASE WHEN st NOT IN ('UBIGINT', 'BIGINT') OR TRY_CAST(s AS BIGINT) < 0 THEN 'timestamp' END,
        CASE WHEN kt <> 'VARCHAR' THEN 'properties' END,
        CASE WHEN more THEN 'additional_properties' END) END AS errors
    FROM p""")
def _(t: Tables):
    checked = validation.validate_json_schema(t.json_event_lines)
    # A line that is no JSON breaks every rule; the first reason stands for all.
    errors = F.when(
        F.array_contains("errors", "not_json"), F.array(F.lit("not_json"))
    ).otherwise(F.col("errors"))
    return checked.select("event_id", "is_valid", errors.alias("errors"))


@query("validate_business_rules", f"""
    {_JSON_RULES}
    SELECT event_id, coalesce(ok AND TRY_CAST(s AS BIGINT) > 0 AND u IS NOT NULL, false) AS is_valid
    FROM p""")
def _(t: Tables):
    return validation.validate_business_rules(t.json_event_lines).select("event_id", "is_valid")


_CSV_VALID = """coalesce(length(user_id) > 0 AND length(event_type) > 0
    AND regexp_full_match("timestamp", '[0-9]+'), false)"""


@query("validate_csv", f"SELECT event_id, {_CSV_VALID} AS is_valid FROM csv_rows")
def _(t: Tables):
    return validation.validate_csv(t.csv_event_rows).select("event_id", "is_valid")


@query("validate_xml", """
    SELECT CASE WHEN event_id % 53 <> 0 THEN CAST(event_id AS VARCHAR) END AS session_id,
      concat_ws(',', CASE WHEN event_id % 53 = 0 THEN 'malformed' END,
        CASE WHEN event_id % 53 = 0 OR event_id % 41 = 0 THEN 'user_id' END,
        CASE WHEN event_id % 53 = 0 OR event_type = 'error' THEN 'event_type' END,
        CASE WHEN event_id % 53 = 0 OR event_id % 37 = 0 OR event_id % 43 = 0 THEN 'timestamp' END)
        AS errors,
      event_id % 53 <> 0 AND event_id % 41 <> 0 AND event_id % 37 <> 0 AND event_id % 43 <> 0
        AND event_type <> 'error' AS is_valid
    FROM events""")
def _(t: Tables):
    """Records that break a field rule, and records that do not parse: these keep only their text."""
    path = t.scratch("xmlcheck")
    t.xml_event_rows.select("value").write.text(path)
    read = files.parse_xml(files.read_lines(t.spark, path))
    return validation.validate_fields(read, files.CORRUPT).select("session_id", "errors", "is_valid")


@query("validation_rollup", f"""
    {_JSON_RULES}
    SELECT 'json' AS "format", count(*) AS total, count(*) FILTER (ok) AS valid,
      count(*) FILTER (NOT ok) AS invalid,
      round(count(*) FILTER (ok) / count(*) * 100, 6) AS valid_pct FROM d
    UNION ALL SELECT 'csv', count(*), count(*) FILTER ({_CSV_VALID}),
      count(*) FILTER (NOT {_CSV_VALID}), round(count(*) FILTER ({_CSV_VALID}) / count(*) * 100, 6)
    FROM csv_rows""")
def _(t: Tables):
    as_json = validation.rollup(validation.validate_json_syntax(t.json_event_lines), "json")
    as_csv = validation.rollup(validation.validate_csv(t.csv_event_rows), "csv")
    return as_json.unionByName(as_csv)


@query("dq_schema_compliance", f"""
    {_JSON_RULES}
    SELECT count(*) AS total, count(*) FILTER (v) AS valid,
      round(count(*) FILTER (v) / count(*) * 100, 6) AS compliance_pct,
      CASE WHEN bool_and(v) THEN 'PASS' ELSE 'FAIL' END AS "result"
    FROM (SELECT coalesce(ok AND length(u) >= 1
      AND e IN ('LOGIN', 'LOGOUT', 'PURCHASE', 'VIEW', 'CLICK') AND st IN ('UBIGINT', 'BIGINT')
      AND TRY_CAST(s AS BIGINT) >= 0 AND kt = 'VARCHAR' AND NOT more, false) AS v FROM p)""")
def _(t: Tables):
    return gates.compliance(validation.validate_json_schema(t.json_event_lines))


@query("payload_amounts_parsed", """
    SELECT count(*) AS events, CAST(sum(CAST(json_extract_string(payload, '$.amount')
      AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS amount FROM user_events""")
def _(t: Tables):
    return t.user_events.agg(
        F.count(F.lit(1)).alias("events"), F.sum(payload_amount()).alias("amount")
    )
