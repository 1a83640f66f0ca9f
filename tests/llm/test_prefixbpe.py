"""Byte-level BPE by prefixes against the tokenizers library, pair by pair and text by text."""

import hashlib
import random
import struct

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from glossmill.llm import prefixbpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a <|endoftext|> b",
    "<|endoftext|><|endoftext|>x<|endoftext",
    "   　 tabs\t\t\nnew\r\n\r\n  ",
    "emoji \U0001f600\U0001f44d\U0001f3fd ok",
    "",
    "x" * 5000,
    "ünïcödé Ελληνικά 中文 123456789",
    "'s 're 'll don't I'M",
    "\x00\x01 control \x7f",
]


@pytest.fixture(scope="module")
def both():
    return prefixbpe.model(PATH, public_tokenizers.PATTERN), Tokenizer.from_file(PATH)


def test_texts_equal_library(both):
    mine, lib = both
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist() if t]
    rnd = random.Random(2)
    alphabet = "ab cé'\n\t 1中!\U0001f600<|>endoftext"
    texts += ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert mine.encode(t) == ids, t[:80]
        assert mine.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_pairs_equal_plain_merges(both):
    mine, _ = both
    rnd = random.Random(4)
    tokens = [i for i in mine.token_bytes if i not in mine.added.values()]
    for _ in range(20000):
        u, t = rnd.choice(tokens), rnd.choice(tokens)
        plain = mine.merged(mine.token_bytes[u] + mine.token_bytes[t])[0] == [u, t]
        assert mine.compatible(u, t) == (plain and mine.starts_piece(u) and mine.starts_piece(t))


def test_query_against_library(spark, tmp_path, both):
    _, lib = both
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (101, "same"), (101, "same")]
    sf = tmp_path / "sf"
    sf.mkdir()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(sf / "documents.parquet"))
    got = sorted(tuple(r) for r in queries.op12_prefix_bpe(spark, str(sf)).collect())
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)


def test_operator_keeps_columns(spark):
    df = spark.createDataFrame([(1, "hi there", "x")], "doc_id long, text string, ids string")
    out = prefixbpe.decode(prefixbpe.encode(df, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    assert out.first()["decoded"] == "hi there"
    assert prefixbpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
