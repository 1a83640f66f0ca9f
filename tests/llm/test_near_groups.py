"""Large groups of near copies: no link is lost, and their pairs are not written out."""

import random

import pytest

from glossmill.llm import neardup


def variants(n, least, most, seed, cut=0):
    """A text of 120 words and `n` variants, each with words replaced and an end cut off."""
    draw = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(120)]
    out = [list(base)]
    for k in range(n):
        words = list(base)
        for at in draw.sample(range(120), draw.randint(least, most)):
            words[at] = f"own{seed}x{k}x{at}"
        out.append(words[: 120 - draw.randint(0, cut)])
    return [" ".join(words) for words in out]


def run(spark, texts, monkeypatch, size=1):
    """Component of each document, and the number of pairs that were verified."""
    verified, pairs_of = [], neardup._verified

    def counted(pairs, *rest):
        verified.append(pairs.count())
        return pairs_of(pairs, *rest)

    monkeypatch.setattr(neardup, "_verified", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = neardup.near_duplicates(docs, size=size).collect()
    return {r["doc_id"]: r["component_id"] for r in rows}, sum(verified)


def by_brute_force(texts, size=1):
    sets = [neardup.shingle_set(t.encode().lower().split(), size) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if root[i] != root[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                keep, gone = sorted((root[i], root[j]))
                root = [keep if r == gone else r for r in root]
    return dict(enumerate(root))


def test_pairs_of_unlinked_variants_are_not_formed(spark, monkeypatch):
    texts = variants(150, 14, 22, 1)  # all share bands, none is similar enough to any other
    found, verified = run(spark, texts, monkeypatch)
    assert found == by_brute_force(texts) and len(set(found.values())) == len(texts)
    assert verified < 6 * len(texts)


@pytest.mark.parametrize("stars", [0, neardup.STARS])
def test_no_link_is_lost_in_groups(spark, monkeypatch, stars):
    texts = variants(60, 0, 16, 2, cut=20) + variants(40, 8, 14, 3, cut=40) + variants(30, 0, 3, 4)
    texts += [" ".join(t.split()[:60]) for t in texts[:20]] + ["a", "a b", "a b c", "a b c d"]
    texts += [f"{a} {b}" for a, b in zip(texts[:15], texts[61:76], strict=True)]
    monkeypatch.setattr(neardup, "STARS", stars)
    found, _ = run(spark, texts, monkeypatch)
    assert found == by_brute_force(texts)
