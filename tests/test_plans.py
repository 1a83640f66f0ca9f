"""What the plans must not contain, and the whole query list against SQL."""

import duckdb
import pytest

import __spark_entry__ as entry_file
import glossmill as g
from glossmill.plans import corpus
from glossmill.plans.oracles import ORACLES
from glossmill.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert entry_file.entry(spark).columns == ["gram", "freq"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries())
    assert set(ORACLES) <= set(entry_file.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations", "orders"):
        sql = f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'"
        db.execute(sql).fetchall()
    want = db.sql(ORACLES[name])
    columns = sorted(want.columns)
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = db.sql(f"SELECT {picked} FROM ({ORACLES[name]})").fetchall()
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(expected)
    assert expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "SinglePartition" not in text
    python = "ArrowEvalPython" in text
    assert python == ("stem" in name)
    assert "BatchEvalPython" not in text


def test_scan_reads_only_what_is_used(spark):
    text = plan(g.ngrams(corpus.documents(spark, SF)))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_tokens_are_evaluated_once(spark):
    for job in (g.ngrams, g.word_counts):
        assert plan(job(corpus.documents(spark, SF))).count("regexp_extract_all") == 1


def test_one_shuffle_per_count(spark):
    docs = corpus.documents(spark, SF)
    for df in (g.ngrams(docs), g.ngrams(docs, unit="document")):
        assert plan(df).count("ENSURE_REQUIREMENTS") == 1
