import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators import validation
from eventloom.sinks import tables as sinks
from eventloom.sources import events as event_sources
from eventloom.sources import files, generators, reports

# The test records, valid, invalid and edge cases.
VALID = [
    '{"user_id": "user123", "event_type": "LOGIN", "timestamp": 1692144000000, "properties": {"page": "home"}, "session_id": "sess123"}',
    '{"user_id": "user456", "event_type": "PURCHASE", "timestamp": 1692144060000, "properties": {"product": "laptop", "price": "999.99"}, "session_id": "sess456"}',
    '{"user_id": "user789", "event_type": "VIEW", "timestamp": 1692144120000, "properties": {"page": "product", "product_id": "prod123"}}',
]
INVALID = [
    '{"user_id": "user123", "event_type": "INVALID_TYPE", "timestamp": -1, "properties": {}}',
    '{"user_id": "", "event_type": "LOGIN", "timestamp": "invalid_timestamp"}',
    '{"user_id": "user789", "missing_required_field": "LOGIN"}',
]
EDGE = [
    '{"user_id": "user_with_very_long_id_that_exceeds_normal_length_limits", "event_type": "LOGIN", "timestamp": 0}',
    '{"user_id": "user123", "event_type": "LOGIN", "timestamp": 9223372036854775807, "properties": {}}',
    '{"user_id": "user123", "event_type": "LOGIN", "timestamp": 1692144000000, "properties": {"key": ""}, "session_id": null}',
]
CSV = '''user_id,event_type,timestamp,properties,session_id
user123,LOGIN,1692144000000,"{\\"page\\":\\"home\\"}",sess123
user456,PURCHASE,1692144060000,"{\\"product\\":\\"laptop\\",\\"price\\":\\"999.99\\"}",sess456
user789,VIEW,1692144120000,"{\\"page\\":\\"product\\",\\"product_id\\":\\"prod123\\"}",
'''
CSV_BAD = '''user_id,event_type,timestamp,properties,session_id
,LOGIN,1692144000000,"{\\"page\\":\\"home\\"}",sess123
user456,INVALID_TYPE,invalid_timestamp,"{\\"product\\":\\"laptop\\"}",sess456
user789,VIEW,-1,malformed_json,
'''
XML = """<?xml version="1.0" encoding="UTF-8"?>
<events>
  <event><user_id>user123</user_id><event_type>LOGIN</event_type><timestamp>1692144000000</timestamp>
    <properties><page>home</page></properties><session_id>sess123</session_id></event>
  <event><user_id>user456</user_id><event_type>PURCHASE</event_type><timestamp>1692144060000</timestamp>
    <properties><product>laptop</product><price>999.99</price></properties><session_id>sess456</session_id></event>
</events>"""
XML_BAD = """<events>
  <event><user_id></user_id><event_type>INVALID_TYPE</event_type><timestamp>-1</timestamp></event>
  <event><user_id>user456</user_id><!-- required fields are missing -->
    <properties><product>laptop</product></properties></event>
</events>"""


def lines(spark, data):
    return spark.createDataFrame([(v,) for v in data], "value string")


def verdicts(df):
    return [r.is_valid for r in df.collect()]


def test_json_schema(spark):
    check = validation.validate_json_schema
    assert verdicts(check(lines(spark, VALID))) == [True] * 3
    assert verdicts(check(lines(spark, EDGE))) == [True] * 3
    bad = check(lines(spark, INVALID)).collect()
    assert bad[0].errors == ["event_type", "timestamp"]
    assert bad[1].errors == ["user_id", "timestamp"]
    assert "missing_timestamp" in bad[2].errors and "additional_properties" in bad[2].errors


def test_json_schema_odd_values(spark):
    base = '{"user_id": "u", "event_type": "VIEW", "timestamp": %s, "properties": %s, "user_agent": %s}'
    cases = [
        (base % ("1.0", "{}", "null"), True),
        (base % ("1.5", "{}", "null"), False),
        (base % ("1", '{"odd key: x": "v"}', '"a"'), True),
        (base % ("1", '{"odd key: x": 5}', '"a"'), False),
        (base % ("1", '{"a": "b", "c": null}', '"a"'), False),
        (base % ("1", "[]", '"a"'), False),
        (base % ("1", "{}", "7"), False),
        (base % ("null", "{}", "null"), False),
        ("[1, 2]", False),
        ('"text"', False),
        ("", False),
        ("{broken", False),
    ]
    got = verdicts(validation.validate_json_schema(lines(spark, [c for c, _ in cases])))
    assert got == [ok for _, ok in cases]


def test_syntax_and_business_rules(spark):
    everything = lines(spark, [*VALID, *INVALID, *EDGE, "{broken"])
    assert verdicts(validation.validate_json_syntax(everything)) == [True] * 9 + [False]
    assert verdicts(validation.validate_business_rules(lines(spark, EDGE))) == [False, True, True]
    total = validation.rollup(validation.validate_json_syntax(everything), "json").first()
    assert (total.total, total.valid, total.invalid, total.valid_pct) == (10, 9, 1, 90.0)


def test_csv(spark, tmp_path):
    for name, text, expected in (("good", CSV, [True] * 3), ("bad", CSV_BAD, [False] * 3)):
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        table = files.read_csv(spark, str(path))
        assert verdicts(validation.validate_csv(table)) == expected
    first = files.read_csv(spark, str(tmp_path / "good.csv")).first()
    assert first.properties == '{"page":"home"}'


def test_xml(spark, tmp_path):
    for name, text, expected in (("good", XML, [True] * 2), ("bad", XML_BAD, [False] * 2)):
        path = tmp_path / f"{name}.xml"
        path.write_text(text)
        table = files.read_xml(spark, str(path))
        assert verdicts(validation.validate_fields(table, files.CORRUPT)) == expected
    good = files.read_xml(spark, str(tmp_path / "good.xml")).collect()
    assert good[1].properties == {"product": "laptop", "price": "999.99"}


def test_json_lines_keep_corrupt_text(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text("\n".join([VALID[0], "{broken", INVALID[1]]))
    table = files.read_json_lines(spark, str(path)).collect()
    assert [r[files.CORRUPT] is not None for r in table] == [False, True, True]
    assert table[1][files.CORRUPT] == "{broken"


def test_long_times_do_not_overflow(spark):
    table = event_sources.parse_messages(lines(spark, [EDGE[1], VALID[0]]), files.USER_EVENT_SCHEMA)
    out = event_sources.from_user_event(table).collect()
    assert out[0].event_timestamp is None and out[1].event_timestamp is not None
    assert out[1].event_type == "login"


def test_schema_evolution(spark):
    old = T.StructType.fromDDL("a int, gone string")
    new = T.StructType.fromDDL("a bigint, b string, c string")
    out = files.read_evolved(spark.createDataFrame([(1, "x")], old), new, {"c": "d"})
    assert rows(out) == [(1, None, "d")]
    assert files.backward_compatible(old, new) == []
    assert files.backward_compatible(old, T.StructType.fromDDL("a string")) == ["a: int to string"]
    strict = T.StructType([T.StructField("b", T.StringType(), False)])
    assert files.backward_compatible(old, strict) == ["b: new field without a default"]


def test_external_formats_are_gated(spark, tmp_path):
    if not files.avro_available(spark):
        with pytest.raises(RuntimeError, match="spark-avro"):
            files.read_avro(spark, str(tmp_path))
    if not files.protobuf_available(spark):
        with pytest.raises(RuntimeError, match="spark-protobuf"):
            files.decode_protobuf(lines(spark, ["x"]), "none.desc")


def test_avro_round_trip(spark, tmp_path):
    if not files.avro_available(spark):
        pytest.skip("spark-avro is not on the class path")
    table = event_sources.parse_messages(lines(spark, VALID), files.USER_EVENT_SCHEMA)
    table.drop(files.CORRUPT).write.format("avro").save(str(tmp_path / "avro"))
    assert files.read_avro(spark, str(tmp_path / "avro")).count() == 3


JUNIT = """<testsuites>
<testsuite name="s1" tests="4" failures="1" errors="1" skipped="1" time="2.5" timestamp="2024-01-02T03:04:05Z">
 <testcase name="a" classname="C" time="1.5"/>
 <testcase name="b" time="0.5"><failure message="m" type="T">boom</failure></testcase>
 <testcase name="c"><error message="bad"/></testcase>
 <testcase name="d"><skipped message="later"/></testcase>
</testsuite>
<testsuite tests="0"/>
</testsuites>"""


def test_junit(spark, tmp_path):
    path = tmp_path / "r.xml"
    path.write_text(JUNIT)
    cases = reports.read_junit_cases(spark, str(path), "dev")
    got = rows(cases.select("test_name", "status", "error_message", "error_type", "duration", "test_file"))
    assert got == [
        ("a", "PASSED", None, None, 1.5, "C"),
        ("b", "FAILED", "boom", "T", 0.5, "s1"),
        ("c", "FAILED", "bad", "Error", 0.0, "s1"),
        ("d", "SKIPPED", "later", "Skipped", 0.0, "s1"),
    ]
    suites = reports.read_junit_suites(spark, str(path))
    got = rows(suites.select("suite_name", "total_tests", "passed_tests", "failed_tests", "success_rate"))
    assert got == [("Unknown Suite", 0, 0, 0, 0.0), ("s1", 4, 1, 2, 25.0)]


def test_suite_json_defaults(spark, tmp_path):
    (tmp_path / "a-results.json").write_text('{"test_suite": "x", "status": "PASSED", "duration_seconds": 7}')
    (tmp_path / "b-results.json").write_text("{}")
    out = reports.read_suite_results(spark, str(tmp_path / "*-results.json"))
    assert rows(out) == [("unknown", "UNKNOWN", 0.0), ("x", "PASSED", 7.0)]


def test_generators_do_not_depend_on_partitioning(spark):
    a = generators.user_events(spark, users=10, events_per_user=100, partitions=1)
    b = generators.user_events(spark, users=10, events_per_user=100, partitions=7)
    assert a.exceptAll(b).count() == 0
    late = a.where("timestampdiff(SECOND, event_timestamp, processing_time) >= 60").count()
    broken = a.where("payload = '{broken'").count()
    assert 20 <= late <= 90 and 1 <= broken <= 30
    assert a.select("event_type").distinct().count() == 5
    assert generators.messages(spark, 50).where("value between 0 and 999").count() == 50
    valid = validation.validate_json_schema(generators.json_events(spark, 100))
    assert valid.where("is_valid").count() == 100
    with pytest.raises(ValueError):
        generators.transform_records(spark, "nope")
    assert generators.transform_records(spark, "data_type_conversion").count() == 1000
    assert generators.transform_records(spark, "field_renaming", 5).first().user_age == 21


def test_upsert_folders_repeat_safely(spark, tmp_path):
    path = str(tmp_path / "upsert")
    write = sinks.append_changes(path)
    first = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "id int, seq int, v string")
    second = spark.createDataFrame([(2, 1, "c", 5)], "id int, seq int, v string, extra int")
    write(first, 0)
    write(second, 1)
    write(second, 1)
    assert rows(sinks.current_rows(spark, path, ["id"], ["seq"])) == [(1, 1, "a", None), (2, 1, "c", 5)]


def test_purge_drops_old_day_folders(spark, tmp_path):
    path = str(tmp_path / "dated")
    table = spark.sql("select id, timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int)) as t from range(5)")
    sinks.write_by_date(table, path, "t")
    assert sinks.purge_dated(spark, path, "2024-01-03") == ["event_date=2024-01-01", "event_date=2024-01-02"]
    assert spark.read.parquet(path).count() == 3


def test_file_streams(spark, tmp_path):
    sent = generators.user_events(spark, users=4, events_per_user=5)
    sinks.write_lines(sent, str(tmp_path / "topics" / "events"))
    sources = [
        event_sources.event_file_stream(spark, str(tmp_path / "topics" / "events")),
        event_sources.object_store(
            spark, str(tmp_path), event_sources.EVENT_SCHEMA, streaming=True, topics_dir="topics"
        ),
    ]
    for i, stream in enumerate(sources):
        name = f"files_{i}"
        query = stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        query.awaitTermination()
        assert rows(spark.table(name)) == rows(sent.select(*stream.columns))
    with pytest.raises(ValueError):
        event_sources.object_store(spark, "x", event_sources.EVENT_SCHEMA, "orc")


def test_kafka_is_gated(spark):
    if not event_sources.kafka_available(spark):
        with pytest.raises(Exception, match="(?i)kafka"):
            event_sources.event_stream(spark, "localhost:9092", "t")


def test_compaction_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "changes")
    write = sinks.append_changes(path)
    for i, data in enumerate([[(1, "a"), (2, "a")], [(2, "b")], [(3, "c"), (1, "c")], [(1, "d")]]):
        write(spark.createDataFrame(data, "id int, v string").withColumn("at", F.lit(i)), i)
    expected = rows(sinks.current_rows(spark, path, ["id"], ["at"]))
    assert sinks.compact_changes(spark, path, ["id"], ["at"]) == 2
    assert sorted(p.name for p in tmp_path.joinpath("changes").iterdir()) == ["batch=2", "batch=3"]
    assert rows(sinks.current_rows(spark, path, ["id"], ["at"])) == expected
    assert sinks.compact_changes(spark, path, ["id"], ["at"]) is None
    write(spark.createDataFrame([(4, "e")], "id int, v string").withColumn("at", F.lit(4)), 4)
    assert sinks.compact_changes(spark, path, ["id"], ["at"]) == 3
    assert len(rows(sinks.current_rows(spark, path, ["id"], ["at"]))) == 4


def test_which_lines_are_corrupt_does_not_depend_on_the_columns_read(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines = ['{"user_id": "u", "timestamp": 1}', '{"user_id": "u", "timestamp": "late"}', '{"user_id": ']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    read = files.read_json_lines(spark, path)
    assert read.where(F.col(files.CORRUPT).isNotNull()).select("user_id").count() == 2
    assert read.agg(F.count(files.CORRUPT)).first()[0] == 2


# --- XML records that survive broken ones ---

XML = """<?xml version="1.0"?>
<!-- a comment -->
<events>
  <event><user_id>u1</user_id><event_type>LOGIN</event_type><timestamp>1</timestamp></event>
  <event><user_id>u2</user><event_type>VIEW</event_type></event>
  <event>
    <user_id>u3</user_id>
    <event_type>VIEW</event_type>
  </event>
  <event><user_id>u4</user_id><event_type>CLICK</event_type>
  <event><user_id>u5 &amp; co</user_id></event>
  <evnt><user_id>u6</user_id></event>
  <event><user_id>u7</user_id></event></events>
"""


@pytest.mark.parametrize("part_bytes", ["128m", "64"])
def test_xml_records_after_broken_ones_survive(spark, tmp_path, part_bytes):
    (tmp_path / "a.xml").write_text(XML)
    (tmp_path / "b.xml").write_text("<events><event><user_id>u8</user_id></event><event><user_id>u9</user_id>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", part_bytes)  # files are cut anywhere, also in a tag
    try:
        got = files.read_xml_records(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["user_id"] for r in got if r["user_id"]) == ["u1", "u3", "u5 & co", "u7", "u8"]
    broken = sorted(r[files.CORRUPT].split()[0] for r in got if r[files.CORRUPT])
    assert broken == ["<event><user_id>u2</user><event_type>VIEW</event_type></event>", "<evnt><user_id>u6</user_id></event>",
                      "<user_id>u4</user_id><event_type>CLICK</event_type>", "<user_id>u9</user_id>"]
    assert all((r["user_id"] is None) == (r[files.CORRUPT] is not None) for r in got)


def test_xml_records_with_attributes_and_empty_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<events n="2"><event id="1"><user_id>u1</user_id></event><event id="2">broken</events>')
    (tmp_path / "empty.xml").write_text("")
    (tmp_path / "none.xml").write_text("<events>\n</events>\n")
    got = files.read_xml_records(spark, str(tmp_path), attributes=True).collect()
    assert [r["user_id"] for r in got if r["user_id"]] == ["u1"]
    assert [r[files.CORRUPT] for r in got if r[files.CORRUPT]] == ['id="2">broken']
