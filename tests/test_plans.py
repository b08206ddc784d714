"""What the physical plans may and may not contain."""

import re

import pytest

from eventloom.plans import all_queries
from eventloom.plans.catalog import Tables
from eventloom.plans.stream_queries import __name__ as STREAMS

SF = "/root/testdata/sf0.001"
# Queries that run jobs or write files while they are built.
EAGER = ("src_", "sink_", "validate_xml", "format_roundtrip", "union_checks")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def lazy_queries():
    from eventloom.plans import stream_queries  # noqa: F401

    source = open(__import__("sys").modules[STREAMS].__file__).read()
    streams = set(re.findall(r'@query\("(\w+)"', source))
    return {n: q for n, q in all_queries().items() if n not in streams and not n.startswith(EAGER)}


@pytest.mark.parametrize("name", sorted(lazy_queries()))
def test_no_python_no_cross_join_no_nested_loop(spark, name):
    text = plan(lazy_queries()[name](spark, SF))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                     "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def scans(df) -> int:
    return len(re.findall(r"FileScan parquet", plan(df)))


def test_as_of_join_and_trailing_counts_read_their_input_few_times(spark):
    """Twice per side: the rows, and the pruned columns that the carries are made of."""
    tables = Tables(spark, SF)
    sources = scans(tables.user_events) + scans(tables.users)
    assert scans(tables.enriched) <= 2 * sources
    # Distinct counts read their spans as well, for the rows and for the carries.
    assert scans(tables.anomalies) <= 4 * scans(tables.user_events_dense)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(all_queries()["alert_connector_failure"](spark, SF))
    assert "html" not in text and re.search(r"ReadSchema: struct<[^>]*>", text)
    known = plan(Tables(spark, SF).raw_events.where("event_type = 'click'").select("user_id"))
    assert "EqualTo(event_type,click)" in known
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in known


def test_sliding_windows_copy_panes_and_not_events(spark):
    """The copies that a hop makes come after the first aggregate."""
    text = plan(Tables(spark, SF).sliding)
    before_any_aggregate = text[text.rindex("HashAggregate"):]
    assert "Expand" in text and "Expand" not in before_any_aggregate


def test_a_bucket_table_is_read_without_a_merge(spark, tmp_path):
    from eventloom.sinks import buckets

    rows = spark.range(100).selectExpr("id", "1 AS ver")
    buckets.upsert_batch(rows, 0, str(tmp_path), ["id"], ["ver"], buckets=4)
    text = plan(buckets.read_buckets(spark, str(tmp_path)))
    assert "Aggregate" not in text and "Exchange" not in text and "Join" not in text
