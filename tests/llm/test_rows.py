"""Every operator: NULLs, empty texts and tables, ties, repeated rows, clashing names."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from glossmill.llm import bpe, lines, mixing, neardup, quality, surrogates, tokens, toxicity, warc
from glossmill.llm.common import scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"
LONG = " ".join(f"word{i % 700} more." for i in range(6000))
PROSE = "The quick brown fox jumps over the lazy dog near a quiet river bank today."


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, PROSE, "en", "a", 1, "x"),
        (2, PROSE, "en", "b", 1, None),
        (2, PROSE, "en", "b", 1, None),
        (3, None, None, None, None, None),
        (4, "", "en", None, 0, "x"),
        (5, LONG, "en", "a", 9, "x"),
        (6, LONG + " end", "en", "c", 9, "x"),
        (None, "A line of five words.\n \nwrite to jo@mail.example.com", None, "a", 1, "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_lines_by_hand(spark):
    shared = "one two three four five"
    rows = [(i, f"own {i}\n{shared}\nx", f"s{i % 4}") for i in range(6)]
    rows += [(9, "only here one two three", None), (10, None, "s1"), (11, "", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in lines.without_boilerplate(docs, min_sites=4).collect()}
    assert out[0]["text"] == f"own 0\n{shared}\nx"
    assert all(out[i]["text"] == f"own {i}\nx" and out[i]["n_removed"] == 1 for i in range(1, 6))
    assert (out[10]["text"], out[10]["n_lines"]) == (None, 0)
    assert (out[11]["text"], out[11]["n_lines"]) == ("", 1)
    assert out[9]["n_removed"] == 0
    same = lines.without_boilerplate(docs, min_sites=5).collect()
    assert all(r["n_removed"] == 0 for r in same)


def test_near_threshold_sites_are_counted_exactly(spark):
    rows = [(i, "a line with five words", f"s{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = lines.without_boilerplate(docs, min_sites=300)
    assert kept.filter("n_removed = 1").count() == 299
    assert lines.without_boilerplate(docs, min_sites=301).filter("n_removed > 0").count() == 0


def test_lines_rows(docs):
    out = lines.cleaned_documents(docs)
    assert out.columns == docs.columns and got(out, *docs.columns) == got(docs, *docs.columns)


def brute_repeats(words):
    where = {}
    for i in range(len(words) - 4):
        where.setdefault(tuple(words[i : i + 5]), []).append(i)
    return len({i + k for at in where.values() if len(at) > 1 for i in at for k in range(5)})


def test_quality_counts(spark, docs):
    out = quality.judged(docs.select("doc_id", "text"), keep=["doc_id"])
    by_id = {r["doc_id"]: r for r in out.collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        words, row = (text or "").split(), by_id[doc_id]
        assert row["n_words"] == len(words) and row["word_chars"] == sum(map(len, words))
        assert row["n_repeat_words"] == brute_repeats(words)
        failed = len(words) < 10 or 100 * row["n_repeat_words"] > 20 * len(words)
        assert row["base_failed"] == failed and not (failed and row["kept"])
    assert quality.good_documents(docs).columns == docs.columns
    assert quality.judged(docs.limit(0)).count() == 0


def test_quality_estimate_finds_the_faulty():
    # Nine in ten patterns are good on both rules; a one-sided rule still counts.
    counts = {int("222", 3): 900, int("011", 3): 60, int("000", 3): 40}
    prior, weights = quality.estimate(counts, 3)
    odds = {c: prior + sum(w[int(d)] for w, d in zip(weights, c)) for c in ("222", "011", "000")}
    assert odds["222"] > 0 > odds["000"] and odds["011"] < 0


def test_targets():
    assert mixing.targets([100, 100, 100], [3, 1, 2], 1.5, 2) == [200.0, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert mixing.targets([], [], 1.5, 2) == []
    assert mixing.targets([0, 10], [1, 1], 1.5, 2) == [0.0, 15.0]


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 23), "hot" if i % 3 else f"s{i % 5}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first, again = (got(mixing.fair_mix(docs), "doc_id", "size", "target", "taken") for _ in "ab")
    assert first == again
    by_target = {}
    for _, size, target, taken in first:
        assert taken in (0, size, 2 * size)
        by_target[target] = by_target.get(target, 0) + taken
    assert all(abs(taken - target) <= 46 for target, taken in by_target.items())


def test_mix_rows(docs):
    out = mixing.fair_mix(docs)
    assert out.count() == docs.count() and out.filter("size = 0 AND taken > 0").count() == 0
    assert mixing.fair_mix(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_bpe_equals_the_library(spark, docs, ranks):
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    odd = ["don't  stop\n\n x", "\x1c a\x85b  c", "日本語 ñandú 123½", "a" * 5000, "<|endoftext|>", " ", "  "]
    rows = [(i, t) for i, t in enumerate(odd)]
    some = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    coded = bpe.encode(some.withColumn("copy", F.col("text")), ranks, public_tokenizers.PATTERN)
    for row in bpe.decode(coded, ranks).collect():
        text = row["copy"] or ""
        assert row["ids"] == known.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
    assert bpe.encode(some.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return neardup.shingle_set(words, size)


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_by_brute_force(spark, size):
    base = [f"w{i}" for i in range(60)]
    rows = [(0, None), (1, ""), (2, "Solo"), (3, "solo")]
    for i in range(40):
        words = list(base)
        for k in range(i % 6):
            words[(i * 13 + k * 17) % 60] = f"x{i}{k}"
        rows.append((100 - i, " ".join(words)))
    rows.append((100, rows[4][1].upper()))  # repeats a key
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    want = sorted(
        (d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows)
    )
    found = neardup.near_duplicates(docs, size=size)
    assert got(found, "doc_id", "n_shingles", "component_id", "kept") == sorted(want, key=repr)


def test_near_duplicate_rows(docs):
    out = neardup.distinct_documents(docs)
    assert out.columns == docs.columns
    assert sorted(r[0] or -1 for r in out.select("doc_id").collect()) == [-1, 1, 3, 4, 5]
    assert neardup.distinct_documents(docs.limit(0)).count() == 0


def test_surrogates(spark, docs):
    text = "Mr. John Smith, Mrs SMITH: jo.s@mail.example.com, +1 (411) 555-1507; 169.122.221.182"
    rows = [(1, text), (2, text), (3, None), (4, "Version 2.0. CC BY 4.0, in 1999."), (5, "")]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in surrogates.replaced(some, b"k").collect()}
    new = out[1]["text"]
    assert new == out[2]["text"] and out[1]["n_replaced"] == 6
    assert not any(x in new for x in ("John", "Smith", "jo.s@", "555-1507", "169.122"))
    first, second = new.split(",")[0].split()[2], new.split(",")[1].split(":")[0].split()[1]
    assert first.upper() == second  # one family name, in each mention's capitals
    assert [out[i]["text"] for i in (3, 4, 5)] == [rows[i][1] for i in (2, 3, 4)]
    other = surrogates.replaced(some, b"l").filter("doc_id = 1").first()["text"]
    assert other != new
    mails = [(i, f"{a}{b}@x.com") for i, (a, b) in enumerate((a, b) for a in "abcdefgh" for b in "ijklmnop")]
    many = surrogates.replaced(spark.createDataFrame(mails, "doc_id long, text string"), b"k")
    texts = [r["text"] for r in many.collect()]
    assert len(set(texts)) == len(texts) and not set(texts) & {m for _, m in mails}
    clash = surrogates.replaced(docs, b"k")
    assert clash.columns == [*docs.columns, "n_replaced"] and clash.count() == docs.count()


def test_toxicity_learns_and_holds_out(spark):
    words = "ba ce di fo gu ha je ki lo mu".split()
    text = lambda i, bad: " ".join([words[(i * k) % 10] for k in range(1, 30)] + ["you", "vilest"] * (2 * bad))
    rows = [(i, text(i, i % 4 == 0)) for i in range(800)] + [(None, "x"), (900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)], "doc_id long, toxic int")
    out = toxicity.score(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    held = [r for r in out if r["held_out"]]
    assert held and all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held if r["doc_id"] != 900)
    none = toxicity.score(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}


def test_token_files(spark, docs):
    folder = scratch(spark, "tokens")
    path = public_tokenizers.path("word_bpe_49k.json")
    tokens.write_tokens(docs, folder, path, end_id=2)
    out = tokens.read_tokens(spark, folder, with_ids=True).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == [None, 1, 2, 2, 3, 4, 5, 6]
    at = 0
    for row in out:
        assert row["start"] == at and row["ids"][-1] == 2 and len(row["ids"]) == row["n_tokens"]
        at += row["n_tokens"]
    assert out[4]["ids"] == out[5]["ids"] == [2]
    empty = scratch(spark, "tokens")
    assert tokens.write_tokens(docs.limit(0), empty, path, end_id=2) == []
    assert tokens.read_tokens(spark, empty).count() == 0


def test_warc_round_trip(spark):
    rows = [(3, "u", "x"), (1, "v", "x"), (2, None, None), (5, "u", ""), (None, "n", "x"), (7, "é\n", "ü" * 70000), (3, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch(spark, "warc")
    files = warc.write_warc(pages, folder, file_bytes=1)
    assert len(files) == len(rows)
    out = warc.read_warc(spark, folder, with_payload=True)
    want = [
        (None, 1, "revisit", 1), (1, 1, "response", None), (2, 0, "response", None),
        (3, 1, "revisit", 1), (3, 1, "revisit", 1), (5, 0, "revisit", 2), (7, 140000, "response", None),
    ]
    assert got(out, "page_id", "payload_bytes", "record_type", "refers_to") == sorted(want, key=repr)
    small = scratch(spark, "warc")
    warc.write_warc(pages, small, revisit_bytes=2)
    assert warc.read_warc(spark, small).filter("record_type = 'revisit'").count() == 0
    again = scratch(spark, "warc")
    assert [f["sha1"] for f in warc.write_warc(pages, again, file_bytes=1)] == [f["sha1"] for f in files]
    none = scratch(spark, "warc")
    assert warc.write_warc(pages.limit(0), none) == [] and warc.read_warc(spark, none).count() == 0


def test_pipeline_stages_keep_columns(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns


def test_digests_of_the_last_stage(spark, docs):
    out = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    row = out.filter("doc_id = 4").first()
    empty = hashlib.sha256(b"").hexdigest()
    assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (0, empty, empty)
