import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from eventloom.operators import compare, transforms

# The golden records of the four scenarios.
RENAME_IN = [("john", "john@example.com", 30), ("jane", "jane@example.com", 25), ("bob", "bob@example.com", 35)]
CAST_IN = [("123", "1692144000", "true", "95.5"), ("456", "1692144060", "false", "87.2"), ("789", "1692144120", "true", "92.8")]
CHAIN_IN = [("john", "123", "1692144000"), ("jane", "456", "1692144060"), ("bob", "789", "1692144120")]
RENAME = {
    "transforms": "renameFields",
    "transforms.renameFields.type": "org.apache.kafka.connect.transforms.ReplaceField$Value",
    "transforms.renameFields.renames": "user_name:full_name,user_email:email",
}
CAST = """
# comment lines are skipped
transforms=convertTypes
transforms.convertTypes.type=org.apache.kafka.connect.transforms.Cast$Value
transforms.convertTypes.spec=user_id:int32,timestamp:int64,active:boolean,score:float64
"""
CHAIN = """
transforms=renameField,convertType,addTimestamp
transforms.renameField.type=org.apache.kafka.connect.transforms.ReplaceField$Value
transforms.renameField.renames=user_name:full_name
transforms.convertType.type=org.apache.kafka.connect.transforms.Cast$Value
transforms.convertType.spec=user_id:int32,login_time:int64
transforms.addTimestamp.type=org.apache.kafka.connect.transforms.InsertField$Value
transforms.addTimestamp.timestamp.field=processed_at
"""


def test_rename(spark):
    df = spark.createDataFrame(RENAME_IN, "user_name string, user_email string, user_age int")
    out = transforms.apply_chain(df, RENAME)
    assert out.columns == ["full_name", "email", "user_age"]
    assert rows(out) == sorted(RENAME_IN, key=repr)


def test_cast(spark):
    df = spark.createDataFrame(CAST_IN, "user_id string, timestamp string, active string, score string")
    out = transforms.apply_chain(df, CAST)
    assert [t for _, t in out.dtypes] == ["int", "bigint", "boolean", "double"]
    assert rows(out) == [
        (123, 1692144000, True, 95.5), (456, 1692144060, False, 87.2), (789, 1692144120, True, 92.8)
    ]


def test_extract(spark):
    df = spark.createDataFrame(
        [(("123", ("john", "john@example.com")),)],
        "nested struct<user_id: string, details: struct<name: string, email: string>>",
    )
    assert transforms.extract_field(df, "nested.user_id").collect()[0].asDict() == {"user_id": "123"}
    assert transforms.extract_field(df, "nested.details.email").first().email == "john@example.com"


def test_chain_order_and_single_projection(spark):
    df = spark.createDataFrame(CHAIN_IN, "user_name string, user_id string, login_time string")
    out = transforms.apply_chain(df, CHAIN, 1692144000000)
    got = sorted((json.loads(r) for r in out.toJSON().collect()), key=lambda r: r["user_id"])
    assert got[0] == {
        "full_name": "john", "user_id": 123, "login_time": 1692144000, "processed_at": 1692144000000
    }
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_unknown_type_fails_before_reading(spark):
    with pytest.raises(ValueError, match="unknown transform type"):
        transforms.apply_chain(spark.range(1), {"transforms": "x", "transforms.x.type": "a.b.Nope$Value"})
    with pytest.raises(ValueError, match="no type"):
        transforms.apply_chain(spark.range(1), {"transforms": "x"})
    with pytest.raises(ValueError, match="unknown cast type"):
        transforms.cast_fields(spark.range(1), {"id": "int7"})


def test_filter_and_router(spark):
    df = spark.createDataFrame([(1, "2024-02-03 04:05:06"), (2, "2024-02-04 00:00:00")], "n int, t string")
    out = transforms.apply_chain(
        df.withColumn("t", F.to_timestamp("t")),
        {
            "transforms": "keep,route",
            "transforms.keep.type": "Filter$Value",
            "transforms.keep.predicate": "n > 1",
            "transforms.route.type": "org.apache.kafka.connect.transforms.TimestampRouter",
            "transforms.route.timestamp.format": "yyyy-MM-dd",
        },
        arrival=F.col("t"),
        topic="logs",
    )
    assert [r.topic for r in out.collect()] == ["logs-2024-02-04"]


def test_rejects_keep_the_original(spark):
    df = spark.createDataFrame([("1", "x"), ("a", "2"), ("b", "c"), (None, "3")], "user_id string, n string")
    spec = {"user_id": "int32", "n": "int64"}
    split = transforms.split_rejects(df, transforms.cast_errors(df, spec))
    assert rows(transforms.good_rows(split)) == [(None, "3")]
    assert rows(transforms.rejected_rows(split)) == [
        ("1", "x", "n is not int64"),
        ("a", "2", "user_id is not int32"),
        ("b", "c", "user_id is not int32; n is not int64"),
    ]
    with pytest.raises(Exception, match="is not"):
        transforms.split_rejects(df, transforms.cast_errors(df, spec), stop_on_error=True).collect()


def test_set_diff_counts_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    right = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "a int, b string")
    assert rows(compare.record_set_diff(left, right)) == [(1, None, 2, 1), (3, "c", 0, 1)]
    assert compare.record_set_diff(left, left).count() == 0


def test_diff_join(spark):
    before = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", 3)], "k int, v string, n int")
    after = spark.createDataFrame([(1, "a", 9), (2, None, 2), (4, "d", 4)], "k int, v string, n int")
    assert rows(compare.diff_join(before, after, ["k"], ["v", "n"])) == [
        (1, "n", "1", "9"), (3, "<removed>", None, None), (4, "<added>", None, None)
    ]


def test_upsert(spark):
    target = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "id int, seq int, v string")
    changes = spark.createDataFrame(
        [(2, 1, "x", 5), (2, 2, "y", 6), (3, 1, "z", 7)], "id int, seq int, v string, extra int"
    )
    assert rows(compare.upsert(target, changes, ["id"], ["seq"])) == [
        (1, 0, "a", None), (2, 2, "y", 6), (3, 1, "z", 7)
    ]
