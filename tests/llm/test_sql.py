"""Queries against their SQL over the smallest tables."""

import duckdb
import pytest

from glossmill.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    db.execute(ORACLES[name])
    columns = [c[0] for c in db.description]
    want = sorted(db.fetchall())
    got = sorted(tuple(r) for r in QUERIES[name](spark, SF).select(*columns).collect())
    assert got == want and want
