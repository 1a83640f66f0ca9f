"""The mix moves no document; what is taken of a queue is its beginning."""

from pyspark.sql import functions as F

from glossmill.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def test_documents_are_not_shuffled(spark):
    rows = [(i, f"s{i % 3}", "w " * (i % 7)) for i in range(200)] + [(None, None, "a b c")]
    out = mixing.mixed_documents(spark.createDataFrame(rows, SCHEMA))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_equal_and_unnamed_rows_are_taken_one_by_one(spark):
    rows = [(1, "a", "x y")] * 30 + [(None, "a", "z")] * 11 + [(2, "b", "p q r")] * 9 + [(3, None, "u " * 5)] * 7 + [(4, "b", None), (5, "c", "")]
    out = mixing.fair_mix(spark.createDataFrame(rows, SCHEMA), keep=["source"])
    assert out.count() == len(rows)
    assert out.filter("taken < 0 or taken > 2 * size or taken % greatest(size, 1) <> 0").count() == 0
    per = out.groupBy("source").agg(F.sum("taken"), F.max("target"), F.max("source_size"), F.max("size"))
    for source, taken, target, size, longest in per.collect():
        assert abs(taken - target) <= 2 * longest, (source, taken, target, size)
