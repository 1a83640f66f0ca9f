"""Importance resampling against a plain Python version of its contract."""

import hashlib
import math
import re
import zlib

from glossmill.llm import queries, resample

SEP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, bench, n_min=1, n_max=1, percent=10, min_words=20):
    def feats(text, n_min=n_min, n_max=n_max):
        if text is None:
            return []
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = [w for w in SEP.split(low) if w]
        return [" ".join(words[i : i + n]) for n in range(n_min, n_max + 1) for i in range(len(words) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode("utf-8")) % 10000

    s, t = [0] * 10000, [0] * 10000
    for _, text in docs:
        for f in feats(text):
            s[bucket(f)] += 1
    for text in bench:
        for f in feats(text):
            t[bucket(f)] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for doc_id, text in docs:
        fs = feats(text)
        weight = math.floor(sum(gain[bucket(f)] for f in fs) / len(fs)) if fs else 0
        h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        n_words = len(feats(text, 1, 1))
        out.append([doc_id, len(fs), weight, float(score), n_words])
    eligible = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0]))
    draw = percent * len(eligible) // 100
    ranks = {}
    for i, r in enumerate(eligible[:draw]):
        ranks[r[0]] = i + 1
    return sorted((r[0], r[1], r[2], r[3], ranks.get(r[0])) for r in out)


def test_against_brute_force(spark):
    words = ["Alpha", "beta", "GAMMA", "delta", "épsilon", "zeta", "x9", "Ω"]
    docs = []
    for i in range(60):
        n = (i * 7) % 45
        docs.append((i, " ".join(words[(i * j + j // 3) % len(words)] for j in range(n)) + f" tail{i % 5}"))
    docs += [(60, None), (61, ""), (62, "....!!!"), (63, "ABC_def-ghi" * 10)]
    bench = ["alpha beta gamma", "Gamma gamma delta x9", None, "zeta"]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tgt = spark.createDataFrame([(b,) for b in bench], "text string")
    got = resample.resampled(df, tgt).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(tuple(r) for r in got) == brute(docs, bench)


def test_bigrams_and_head_of_one(spark):
    docs = [(i, " ".join(f"w{(i + j) % 4}" for j in range(25))) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tgt = spark.createDataFrame([("w1 w2 w3",)], "text string")
    got = resample.resampled(df, tgt, n_max=2, head_size=1).select("doc_id", "n_features", "weight", "rank").collect()
    want = brute(docs, ["w1 w2 w3"], n_max=2)
    assert sorted(tuple(r) for r in got) == [(a, b, c, e) for a, b, c, d, e in want]


def test_odd_rows(spark):
    rows = [(1, "a " * 30, "x"), (1, "a " * 30, "x"), (None, "b " * 30, "y"), (2, None, None), (3, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rank string")
    tgt = spark.createDataFrame([(None,)], "text string")
    got = resample.resampled(df, tgt).collect()
    assert len(got) == 5
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == []  # floor(10 * 3 / 100) = 0
    empty = resample.resampled(df.limit(0), tgt)
    assert empty.count() == 0


def test_many_drawn_with_ties(spark):
    rows = [(i % 7, "same words here " * 8) for i in range(70)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    tgt = spark.createDataFrame([("same",)], "text string")
    got = resample.resampled(df, tgt).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, 8))


def test_query_columns(spark):
    df = queries.op11_resample(spark, "/root/testdata/sf0.001")
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
