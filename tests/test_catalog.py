"""Every registered query against its SQL oracle, on the smallest test tables."""

import decimal
import math
import os
import re

import duckdb
import pytest

from eventloom.plans import all_oracles, all_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES, ORACLES = all_queries(), all_oracles()
STREAM_FILE = os.path.join(os.path.dirname(__file__), "..", "eventloom", "plans", "stream_queries.py")
STREAMS = set(re.findall(r'@query\("(\w+)"', open(STREAM_FILE).read()))


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


def text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return "D" + format(value, "f")
    return str(value)


def check(spark, oracle, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    ours = sorted(tuple(map(text, r)) for r in frame.select(*[f"`{c}`" for c in columns]).collect())
    result = oracle.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert ours == sorted(tuple(text(r[i]) for i in order) for r in result.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_batch_query(spark, oracle, name):
    check(spark, oracle, name)


@pytest.mark.parametrize("name", sorted(STREAMS))
def test_stream_query(spark, oracle, name):
    check(spark, oracle, name)
