"""Near dedup chooses rows, not keys."""

from glossmill.llm import neardup

SCHEMA = "doc_id long, text string, n int"


def text(seed):
    return " ".join(f"w{seed}x{i}" for i in range(30))


def distinct(spark, rows):
    out = neardup.distinct_documents(spark.createDataFrame(rows, SCHEMA))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_rows_that_share_a_key(spark):
    a, b = text("a"), text("b")
    assert distinct(spark, [(3, a, 0), (5, a, 1), (5, b, 2)]) == [(3, a, 0), (5, b, 2)]
    hot = [(7, text(i), i) for i in range(20)]
    assert distinct(spark, hot + hot) == sorted(hot, key=repr)


def test_rows_without_key(spark):
    a, b = text("a"), text("b")
    rows = [(None, a, 0), (None, a, 0), (None, b, 1), (4, b, 2), (None, a + " end", 3)]
    out = distinct(spark, rows)
    assert len(out) == 2 and (4, b, 2) in out and {r[0] for r in out} == {4, None}


def test_wordless_rows_all_stay(spark):
    rows = [(1, None, 0), (1, " ", 1), (None, "", 2), (None, "", 2)]
    assert distinct(spark, rows) == sorted(rows, key=repr)
