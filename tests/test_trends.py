import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.errors import PySparkException

import glossmill as g


def brute_force(data, span=10, history=4):
    terms = defaultdict(lambda: defaultdict(int))
    for year, term, freq in data:
        terms[term][year] += freq
    out = []
    for term, years in terms.items():
        last = max(years)
        for start in range(min(years), last - history + 1):
            end = min(start + span - 1, last)
            total = sum(f for y, f in years.items() if start <= y <= end)
            out.append((term, start, end, total))
    return sorted(out)


SCHEMA = "year int, term string, freq long"


def test_sample(spark):
    data = [(2000, "k", 5), (2003, "k", 7), (2012, "k", 1), (2001, "z", 9), (2003, "z", 1)]
    got = rows(g.rolling_term_sum(spark.createDataFrame(data, SCHEMA)))
    assert got == [
        ("k", 2000, 2009, 12), ("k", 2001, 2010, 7), ("k", 2002, 2011, 7),
        ("k", 2003, 2012, 8), ("k", 2004, 2012, 1), ("k", 2005, 2012, 1),
        ("k", 2006, 2012, 1), ("k", 2007, 2012, 1), ("k", 2008, 2012, 1),
    ]


def test_random_terms(spark):
    rng = random.Random(3)
    data = [
        (rng.choice([1950, 1990, 2000]) + rng.randint(0, 15), f"t{rng.randint(0, 40)}", 1 + i % 5)
        for i in range(400)
    ]
    got = rows(g.rolling_term_sum(spark.createDataFrame(data, SCHEMA)))
    assert got == brute_force(data)
    assert any(r[3] == 0 for r in got)  # start years far from any data


def test_gap_years_and_other_parameters(spark):
    data = [(1900, "g", 2), (1999, "g", 3)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(g.rolling_term_sum(df)) == brute_force(data)
    assert rows(g.rolling_term_sum(df, span=3, min_history=1)) == brute_force(data, 3, 1)


def test_any_whole_number_is_a_year(spark):
    data = [(900 + i, "a", 1) for i in range(8)] + [(-3, "b", 2), (12005, "c", 1), (12010, "c", 1)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(g.rolling_term_sum(df)) == brute_force(data)


def test_what_is_no_year_fails_or_goes(spark):
    df = spark.createDataFrame(
        [("2000", "a", 1), ("2004", "a", 1), ("abcd", "a", 5), (None, "a", 5)],
        "year string, term string, freq long",
    )
    with pytest.raises(PySparkException):
        g.rolling_term_sum(df).collect()
    counters = g.JobCounters()
    got = rows(g.rolling_term_sum(df, malformed="drop", counters=counters))
    assert got == [("a", 2000, 2004, 2)]
    assert (counters.emitted, counters.kept) == (2, 1)


def test_a_term_of_any_span(spark):
    data = [(-100_000, "w", 3), (-99_995, "w", 2), (0, "w", 1), (100_000, "w", 4), (2000, "n", 1), (2004, "n", 1)]
    got = g.rolling_term_sum(spark.createDataFrame(data, SCHEMA))
    assert got.count() == 200_001 - 4 + 1
    want = {r[1]: r for r in brute_force(data) if r[0] == "w" and r[3] > 0}
    assert {r.start_year: tuple(r) for r in got.filter("term = 'w' AND freq > 0").collect()} == want

def test_chain_thresholds_before_the_trend(spark):
    chunks = spark.createDataFrame(
        [("1", str(y), ["[NP MAP kinase ]"] * k) for y, k in ((2000, 6), (2002, 4), (2005, 5))],
        "doc_id string, year string, chunks array<string>",
    )
    got = g.rolling_term_sum(g.chunk_counts(chunks))
    assert rows(got) == [
        ("[NP MAP kinase ]", 2000, 2005, 11),
        ("[NP MAP kinase ]", 2001, 2005, 5),
    ]


@pytest.mark.parametrize("width", [1, 2])
def test_windows_keep_one_shuffle_by_term(spark, width):
    df = spark.createDataFrame([(2000, "a", 1)], SCHEMA)
    plan = g.rolling_term_sum(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(term") == 2
    assert "Join" not in plan
