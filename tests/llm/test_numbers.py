"""Packing, bit slices and sketches against plain computations."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glossmill.llm import bitslice, neardup, packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 70000) | st.just(0), max_size=3000))
def test_packing_round_trip(values):
    array = np.array(values, np.uint64)
    words, offsets = packing.pack(array)
    assert (packing.unpack(words, len(array)) == array).all() and offsets[-1] == len(words)


def test_any_document_of_a_file():
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, 49408, n).astype(np.uint64) for n in (0, 1, 5000, 3, 1024)]
    file = packing.TokenFile.parse(packing.build([None, 4, 5, 6, 7], ids))
    assert [d for d, _, _ in file.documents()] == [None, 4, 5, 6, 7]
    for i, want in enumerate(ids):
        assert (file.ids(int(file.first[i]), int(file.first[i + 1])) == want).all()
    data = packing.build([1], ids[:1])
    with pytest.raises(ValueError):
        packing.TokenFile.parse(data[:-1])


def brute(rows, k, every):
    out = set()
    for q, v in rows:
        if q % every == 0:
            best = sorted((-int(np.dot(v, w)), i) for i, w in rows if i != q)[:k]
            out |= {(q, at + 1, i, -s) for at, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("n, dims, spread", [(3, 4, 1.0), (700, 8, 1.0), (400, 5, 0.01), (90, 3, 50.0)])
def test_top_k(spark, n, dims, spread):
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(0, spread, dims)]) for i in range(n)]
    rows += [(n + 50, rows[0][1]), (n + 51, rows[0][1])]
    bad = [(n + 60, None), (n + 61, [None] * dims), (n + 62, [float("nan")] * dims), (None, rows[0][1])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows]
    found = {tuple(r) for r in bitslice.top_k(table, every=10).collect()}
    assert found == brute(whole, 5, 10)
    assert bitslice.top_k(table.limit(0)).count() == 0


def test_top_k_of_many_blocks_and_batches(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", 20)
    monkeypatch.setattr(bitslice, "BATCH_QUERIES", 5)
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows]
    for held in (1, 64_000_000):
        monkeypatch.setattr(bitslice, "HELD_BYTES", held, raising=False)
        found = bitslice.top_k(table, every=10)
        plan = found._jdf.queryExecution().executedPlan().toString()
        # Queries times blocks are neither joined nor sent through the driver.
        assert "Join" not in plan and "Broadcast" not in plan
        assert {tuple(r) for r in found.collect()} == brute(whole, 5, 10)


def test_sketch_agreement_is_near_the_similarity():
    rng = np.random.default_rng(0)
    for n in (1, 3, 40, 5000):
        for _ in range(5):
            a = rng.integers(0, 2**63, n, dtype=np.uint64)
            b = a.copy()
            b[: n // 5] = rng.integers(0, 2**63, n // 5, dtype=np.uint64)
            one, two = neardup.sketches([np.unique(a), np.unique(b)])
            real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            assert (one != np.iinfo(np.uint64).max).all()
            assert abs((one == two).mean() - real) < 0.16
