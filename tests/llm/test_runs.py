"""Periodic runs against a quadratic search, and the query against its contract in Python."""

import hashlib
import random
import re
import zlib

import numpy as np

from glossmill.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    n, best = len(w), {}
    for q in range(1, n):
        i = 0
        while i < n - q:
            if w[i] == w[i + q]:
                j = i
                while j < n - q and w[j] == w[j + q]:
                    j += 1
                if j + q - i >= max(6, 4 * q):
                    key = (i, j + q - i)
                    best[key] = min(best.get(key, q), q)
                i = j
            else:
                i += 1
    return sorted((s, length, q) for (s, length), q in best.items())


def contract(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(w)
    gone = set()
    for s, length, q in found:
        gone.update(range(s + q, s + length))
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    s, length, q = best or (None, None, None)
    milli = None if best is None else 1000 * length // q
    return (doc_id, len(found), s, length, q, milli, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def test_random_sequences_against_quadratic_search():
    rnd = random.Random(3)
    for _ in range(1500):
        a = rnd.randint(1, 4)
        if rnd.random() < 0.5:
            base = [rnd.randint(0, a) for _ in range(rnd.randint(1, 6))]
            w = [rnd.randint(0, a) for _ in range(rnd.randint(0, 9))] + base * rnd.randint(1, 12)
            w += [rnd.randint(0, a) for _ in range(rnd.randint(0, 9))]
        else:
            w = [rnd.randint(0, a) for _ in range(rnd.randint(0, 70))]
        assert runs.find_runs(np.array(w, dtype=np.int64)) == brute_runs(w)


def test_long_sequences():
    w = list(np.tile(np.arange(5), 4000)) + [9] + [1] * 50
    assert runs.find_runs(np.array(w)) == [(0, 20000, 5), (20001, 50, 1)]
    assert runs.find_runs(np.random.default_rng(1).integers(0, 10**6, 100_000)) == []


def test_query_against_contract(spark, tmp_path):
    rnd = random.Random(5)
    rows = []
    for d in range(400):
        n = rnd.randint(0, 60)
        vocab = ["a", "b", "c", "dé", "e"][: rnd.randint(1, 5)]
        rows.append((d, "\t".join(rnd.choice(vocab) for _ in range(n)) if n else rnd.choice([None, "", "  "])))
    rows += [(1000, "x y " * 40), (1000, "x y " * 40), (None, "q q q q q q q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sf = tmp_path / "sf"
    sf.mkdir()
    df.write.parquet(str(sf / "documents.parquet"))
    got = queries.op13_runs(spark, str(sf)).collect()
    want = sorted(contract(d, t) for d, t in rows if d is not None)
    mine = sorted(tuple(r) for r in got if r["doc_id"] is not None)
    assert mine == want
    null_row = [r for r in got if r["doc_id"] is None][0]
    assert null_row["n_runs"] == 1 and null_row["period"] == 1


def test_operator_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "w " * 10, None), (3, "w " * 10, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, collapsed string")
    got = sorted(runs.periodic_runs(df).select("doc_id", "n_runs", "collapsed").collect())
    assert [tuple(r) for r in got] == [(1, 0, ""), (2, 0, ""), (3, 1, "w"), (3, 1, "w")]
    assert runs.periodic_runs(df.limit(0)).count() == 0
