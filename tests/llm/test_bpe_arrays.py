"""Byte pairs over arrays: words cut as by the pattern, ids of rows with words of their own."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import functions as F

from glossmill.llm import arrays, bpe

PATTERN = public_tokenizers.PATTERN
MARKS = list(" \t\n\r\x0b\x1c\x85\xa0    　    ab,.é日Âßâ€​'1")


def odd_texts(n, longest=9):
    draw = random.Random(7)
    return ["".join(draw.choices(MARKS, k=draw.randint(0, longest))) for _ in range(n)]


def test_words_are_those_of_the_pattern():
    texts = odd_texts(20_000)
    find = regex.compile(PATTERN).findall
    parted = bpe._Parted(pa.array(texts, pa.large_string()), bpe._splitter(PATTERN))
    places, ends = arrays.gather(parted.parts, parted.first, parted.count, parted.units)
    ends = np.append(0, ends)[np.append(0, parted.unit_ends)]
    words = np.array(parted.words.to_pylist(), object)[places]
    assert [list(words[a:b]) for a, b in zip(ends, ends[1:])] == [find(t) for t in texts]
    found = parted.word_counts()
    assert found.sum() == len(words) and found.min() >= 1


def test_any_head_gives_the_library_s_ids(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(i % 50, t) for i, t in enumerate(odd_texts(300, 40))]
    rows += [(None, None), (1, ""), (2, "word " * 2000), (3, "z" * 400 + " again again " + "z" * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("copy", F.col("text"))
    for head in (0, 10, 1000):
        coded = bpe.encode(docs, ranks, PATTERN, head=head)
        out = bpe.decode(coded, ranks).collect()
        assert len(out) == len(rows)
        for row in out:
            assert row["ids"] == known.encode_ordinary(row["copy"] or "")
            assert bytes(row["decoded"]) == (row["copy"] or "").encode()


def test_tasks_hold_the_frequent_words_as_arrays(spark, monkeypatch):
    """No object per word in a worker, no expression per id or word in the plan (F1, F2)."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = spark.createDataFrame([(1, "one two two three three"), (2, None)], "doc_id long, text string")
    given = []
    real = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda c, x: given.append(x) or real(c, x))
    coded = bpe.encode(docs, ranks, PATTERN)
    words, codes, ends = given[0]
    assert sorted(words.to_pylist()) == [" three", " two"] and len(ends) == 3 and codes.dtype == np.int32
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("MapInArrow") == 1


def test_words_folded_together_are_those_merged_alone():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    draw = random.Random(5)
    words = [bytes(draw.choices(b"abcdeth \xc3\xa9in", k=draw.randint(1, 128))) for _ in range(500)]
    ids, first, count = bpe.fold_words(words, bpe.pair_table(ranks))
    got = [ids[a : a + n].tolist() for a, n in zip(first, count)]
    assert got == [bpe.heap_merge(w, ranks) for w in words]
    ids, _, count = bpe.fold_words([b"qx", b"z"], bpe.pair_table(ranks))
    assert count.sum() == len(ids) and ids[-1] == ranks[b"z"]
    assert [len(x) for x in bpe.fold_words([], bpe.pair_table(ranks))] == [0, 0, 0]
