import random
from collections import Counter

import model
import pytest
from conftest import rows
from pyspark.sql import functions as F

import glossmill as g
from glossmill.functions import text as T

ALPHABET = "aab1()\"'.,;:*+-/> é_"


def random_lines(count, seed, longest=40):
    rng = random.Random(seed)
    return [
        "".join(rng.choices(ALPHABET, k=rng.randint(0, longest))) for _ in range(count)
    ]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(x,) for x in random_lines(4000, 1)], "line string")


def test_tokens_match_model(lines):
    got = lines.select("line", T.tokens(F.col("line"))).collect()
    assert [(x, t) for x, t in got if t != model.tokens(x)] == []


@pytest.mark.parametrize(
    ("clean", "expected"),
    [
        (T.clean_gram, model.gram),
        (T.clean_word, model.word),
        (lambda c: T.clean_word(c, "pair"), lambda s: model.word(s, True)),
    ],
)
def test_clean_matches_model(lines, clean, expected):
    # A lone quote next to its like is the one input without a defined result.
    got = lines.select("line", clean(F.col("line"))).collect()
    bad = [(x, y, expected(x)) for x, y in got if y != expected(x) and len(x) > 2]
    assert bad == []


def test_gram_validity_needs_no_clean_up(lines):
    got = lines.select("line", T.valid_raw_gram(F.col("line"))).collect()
    got = [(x, v) for x, v in got if x and not x.startswith(" ")]
    assert [x for x, v in got if v != model.valid_gram(model.gram(x))] == []


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_ngrams_match_model(records, n):
    bodies = ["\n".join(random_lines(20, seed)) for seed in range(30)]
    want = Counter(x for b in bodies for s in b.split("\n") for x in model.grams(s, n))
    got = g.ngrams(records(*bodies), n, min_freq=1)
    assert dict(rows(got)) == want
    docs = Counter(
        x for b in bodies for x in {x for s in b.split("\n") for x in model.grams(s, n)}
    )
    got = g.ngrams(records(*bodies), n, min_freq=1, unit="document")
    assert dict(rows(got)) == docs


def test_words_match_model(records):
    bodies = ["\n".join(random_lines(20, seed)) for seed in range(30)]
    want = Counter(x for b in bodies for x in model.words(b))
    assert dict(rows(g.word_counts(records(*bodies), min_freq=1))) == want
    docs = Counter(x for b in bodies for x in set(model.words(b)))
    got = g.word_counts(records(*bodies), min_freq=1, unit="document")
    assert dict(rows(got)) == docs


def test_very_long_tokens_and_dash_runs(records):
    body = "x" * 200_000 + "(+" * 50_000 + " " + "-" * 200_000 + " tail " + "-" * 9 + ">"
    got = g.ngrams(records(body), 1, min_freq=1).filter(F.length("gram") < 20)
    assert rows(got) == [("tail", 1)]


@pytest.mark.parametrize(
    ("header", "headings"),
    [
        ("1:2021 Jun 11:Anatomy|Cell Biology", ["Anatomy", "Cell Biology"]),
        ("1:2021", ["No_Headings"]),
        ("1:2021:", ["No_Headings"]),
        ("1:2021::", ["No_Headings"]),
        ("1:2021:A:B", ["No_Headings"]),
        ("1:2021:A|", ["A"]),
        ("1:2021:|A", ["", "A"]),
        ("1:2021:|", []),
        ("1:2021:A|A", ["A", "A"]),
    ],
)
def test_headings(spark, header, headings):
    df = spark.createDataFrame([(header,)], "h string")
    assert df.select(T.headings(F.col("h"))).first()[0] == headings


def test_trim_strips_controls(spark):
    df = spark.createDataFrame([("\x00\t a b\x1f\r\n",)], "c string")
    assert df.select(T.java_trim(F.col("c"))).first()[0] == "a b"
