import pytest
from conftest import rows
from pyspark.sql import functions as F

import glossmill as g


def test_sample_record_bigrams(records):
    body = (
        '<s n="1">Repair of the (CNS) pathway.</s>\n'
        '<s n="1">Cells +/- factor A-->B, "signal" loss?</s>\n'
        '<s n="2">Wow it works!</s>'
    )
    got = [r[0] for r in rows(g.ngrams(records(body), min_freq=1))]
    assert got == sorted(
        [
            "Repair of", "of the", "the (CNS)", "(CNS) pathway", "Cells +/-",
            "+/- factor", "factor A-->B", 'A-->B, "signal"', '"signal" loss',
            "Wow it", "it works!",
        ]
    )


def test_occurrence_and_document_counts(records):
    df = records("a b a b", "a b\na b", "b a")
    assert dict(rows(g.ngrams(df, min_freq=1)))["a b"] == 4
    assert dict(rows(g.ngrams(df, min_freq=1, unit="document")))["a b"] == 2
    assert rows(g.ngrams(df, min_freq=4)) == [("a b", 4)]


def test_headings_multiply_and_documents_dedupe(records):
    df = records(("a b", ["X", "X", "Y"]), ("a b", []), ("a b", ["Y"]))
    got = rows(g.ngrams(df, by_heading=True, min_freq=1))
    assert got == [("X", "a b", 2), ("Y", "a b", 2)]
    got = rows(g.ngrams(df, by_heading=True, min_freq=1, unit="document"))
    assert got == [("X", "a b", 1), ("Y", "a b", 2)]


def test_case_folding_precedes_patterns(records):
    df = records("Foo BAR baz")
    kept = g.ngrams(df, min_freq=1, skip_patterns=["BAR "])
    assert rows(kept) == [("Foo baz", 1)]
    folded = g.ngrams(df, min_freq=1, skip_patterns=["BAR "], case_sensitive=False)
    assert rows(folded) == [("bar baz", 1), ("foo bar", 1)]


def test_pattern_crosses_lines(records):
    got = g.ngrams(records("one two\nthree"), min_freq=1, skip_patterns=[r"two\n"])
    assert rows(got) == [("one three", 1)]


def test_sweep_equals_single_sizes(records):
    df = records("a b c, d (e f) g", "a b c d e f g h i j k", "a b c")
    swept = rows(g.ngram_sweep(df, 2, 10, min_freq=1))
    single = [
        (n, *r) for n in range(2, 11) for r in rows(g.ngrams(df, n, min_freq=1))
    ]
    assert swept == sorted(single)


@pytest.mark.parametrize("broadcast_bytes", [0, 10**6])
def test_pruned_sweep_equals_unpruned(records, broadcast_bytes, monkeypatch):
    from test_text import random_lines

    from glossmill.operators import lookup

    monkeypatch.setattr(lookup, "HOT_SHARE", 50)
    phrase = 'see "the (long) phrase" of 2 words, twice: here; there'
    bodies = [
        f"{line}\n{phrase[: 10 + seed]} {line}\n{phrase}"
        for seed, line in enumerate(random_lines(60, 5))
    ]
    df = records(*bodies, *[bodies[7]] * 30)
    want = rows(g.ngram_sweep(df, 2, 10, min_freq=3, prune=False))
    got = g.ngram_sweep(df, 2, 10, min_freq=3, broadcast_bytes=broadcast_bytes)
    assert rows(got) == want
    assert {r[0] for r in want} == set(range(2, 11))


def test_words_heading_token(records):
    df = records(("(foo) bar, .x", ["H"]))
    raw = rows(g.word_counts(df, by_heading=True, min_freq=1))
    assert raw == [("H", "(foo)", 1), ("H", "bar,", 1)]
    clean = rows(g.word_counts(df, by_heading=True, heading_token="clean", min_freq=1))
    assert clean == [("H", "bar", 1), ("H", "foo", 1)]


@pytest.mark.parametrize("unit", ["occurrence", "document"])
@pytest.mark.parametrize("by_heading", [False, True])
def test_stop_words_list_and_table_agree(spark, records, unit, by_heading):
    df = records(("the cat, the dog", ["H"]), ("(the) cat The", ["H", "G"]))
    table = spark.createDataFrame([("the",), ("dog",)], "word string")
    options = dict(unit=unit, by_heading=by_heading, min_freq=1)
    got = rows(g.word_counts(df, table, **options))
    assert got == rows(g.word_counts(df, ["the", "dog"], **options))
    assert {r[-2].strip("(),") for r in got} == {"cat", "The"}


def test_counters(records):
    seen = g.JobCounters()
    df = g.ngrams(records("a b a b", "c d"), min_freq=2, counters=seen)
    assert rows(df) == [("a b", 2)]
    assert (seen.emitted, seen.kept) == (4, 1)
    seen = g.JobCounters()
    df = g.word_counts(records("aa bb aa", "cc"), ["cc"], min_freq=2, counters=seen)
    assert rows(df) == [("aa", 2)]
    assert (seen.emitted, seen.kept) == (3, 1)


def test_result_is_independent_of_partitions(records):
    df = records(*[f"a b c{i % 3} d, e" for i in range(50)])
    for job in (g.ngrams, g.word_counts, g.cooccurrence):
        results = [rows(job(df.repartition(k), min_freq=3)) for k in (1, 3, 16)]
        assert results[0] == results[1] == results[2]


def test_more_frequency_only_removes_rows(records):
    df = records(*[f"a b c{i % 7} d, e" for i in range(50)])
    low, high = (set(rows(g.ngrams(df, min_freq=k))) for k in (2, 20))
    assert high == {r for r in low if r[-1] >= 20}


def test_bad_arguments(records):
    df = records("a b")
    with pytest.raises(ValueError):
        g.ngrams(df, unit="page")
    with pytest.raises(ValueError):
        g.ngrams(df, 0)
    with pytest.raises(ValueError):
        g.word_counts(df, heading_token="other")
    with pytest.raises(ValueError):
        g.cooccurrence(df, strategy="other")


def test_long_sums_do_not_wrap(spark):
    yearly = spark.range(5).select(
        (F.col("id") + 2000).cast("int").alias("year"),
        F.lit("t").alias("term"),
        F.lit(2**31).alias("freq"),
    )
    assert rows(g.rolling_term_sum(yearly)) == [("t", 2000, 2004, 5 * 2**31)]


def test_hot_keys_are_salted_in_one_join(spark, tmp_path):
    from glossmill.operators import lookup

    rows = spark.createDataFrame([("a" if i % 3 else f"w{i % 40}", i) for i in range(3000)], "word string, n int")
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    listed = rows.groupBy("word").agg(F.count(F.lit(1)).alias("units")).withColumn("id", F.xxhash64("word"))
    got = lookup.join_listed(rows, listed, "word", "units", small=False)
    want = rows.join(listed.drop("units"), "word")
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count(path.rstrip("/").split("/")[-1]) >= 1
    assert plan.count("Union") == 0


def test_sweep_shuffles_no_positions(records):
    df = records(*["a1 b1 c1 d1 e1 f1"] * 3, "a1 b1 zz d1 e1")
    got = g.ngram_sweep(df, 2, 10, min_freq=3)
    assert "line_id" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(g.ngram_sweep(df, 2, 10, min_freq=3, prune=False))


def test_marks_may_collide(records, monkeypatch):
    from glossmill.operators import grams

    # 64 marks in all: many rare bigrams share the mark of a frequent one.
    monkeypatch.setattr(grams, "_mark", lambda b, bits: F.pmod(F.xxhash64(b), F.lit(64)).cast("int"))
    bodies = [" ".join(f"w{(i * 7 + k * (1 + i % 3)) % 31}" for k in range(20)) for i in range(40)]
    df = records(*bodies, "", "solo", None)
    want = rows(g.ngram_sweep(df, 2, 6, min_freq=4, prune=False))
    assert want and rows(g.ngram_sweep(df, 2, 6, min_freq=4)) == want


def test_tasks_grow_with_the_text(spark, tmp_path, monkeypatch):
    from glossmill.plans import corpus

    docs = [(None if i % 7 == 0 else i, f"text of {i} " * 20, "s", "en") for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    frame.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(corpus, "TASK_BYTES", 2000, raising=False)
    got = corpus.text_table(spark, str(tmp_path), "documents", "doc_id", "text")
    size = sum(len(d[1]) for d in docs)
    assert got.rdd.getNumPartitions() >= size / 2000
    assert rows(got, "text") == sorted((d[1],) for d in docs)


def test_sweep_reads_the_text_once(records):
    df = records(*["aa bb cc dd\naa bb\nee\n\naa  bb cc dd"] * 3, "aa bb cc (dd)")
    got = g.ngram_sweep(df, 2, 5, min_freq=4)
    assert "regexp_extract_all" not in got._jdf.queryExecution().executedPlan().toString()
    want = rows(g.ngram_sweep(df, 2, 5, min_freq=4, prune=False))
    assert want and rows(got) == want


def test_bigrams_of_one_hash_are_told_apart(records, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.length(c[0]).cast("long"))
    df = records(*["aa bb cc\ndd ee"] * 4, "ff gg\nhh ii jj")
    for limit in (0, 1 << 25):
        got = rows(g.ngram_sweep(df, 2, 3, min_freq=4, broadcast_bytes=limit))
        assert got == [(2, "aa bb", 4), (2, "bb cc", 4), (2, "dd ee", 4), (3, "aa bb cc", 4)]


def test_stored_tables_leave_no_shuffle_files(spark):
    import time

    from glossmill.functions.durable import stored

    def files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        names = manager.getAllFiles().mkString(" ").split()
        return {n for n in names if n.endswith(".data") and "shuffle_" in n}

    before = files()
    kept = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    for _ in range(50):
        if not (files() - before):
            break
        time.sleep(0.2)
    assert not (files() - before)
    assert kept.agg(F.sum("count")).first()[0] == 1000
