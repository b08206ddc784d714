"""Every training-data query that SQL can express against its SQL, on the smallest tables."""

import duckdb
import pytest

from eventloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_thirteen_queries():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    frame = QUERIES[name](spark, SF)
    if name not in ORACLES:
        assert frame.count() > 0
        return
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert sorted(map(tuple, frame.select(*columns).collect()), key=repr) == sorted(result.fetchall(), key=repr)
