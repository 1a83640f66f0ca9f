"""One query per operator over the whole of its table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from glossmill.llm import bitslice, bpe, lines, mixing, neardup, prefixbpe, quality, resample, runs, surrogates, tokens, toxicity, warc
from glossmill.llm.common import scratch, table, words


def op1_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.without_boilerplate(docs).select("doc_id", "text", "n_lines", "n_removed")


def op2_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replaced(docs, key=b"a key of this query's own")


def op3_warc(spark, sf_dir):
    folder = scratch(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return warc.read_warc(spark, folder)


def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs, keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("p_good", 6).alias("p_good"),
    )


def op5_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.fair_mix(docs)


def encoded_digests(docs):
    """Digests of the ids of each text and of the bytes they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    both = bpe.decode(coded, ranks)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_bpe(spark, sf_dir):
    return encoded_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_minhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, size=2)


def op8_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = scratch(spark, "tokens")
    tokens.write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokens.read_tokens(spark, folder)


def op9_top_k(spark, sf_dir):
    return bitslice.top_k(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.score(docs, labels)


def op11_resample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = table(spark, sf_dir, "benchmark").select("text")
    return resample.resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_prefix_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    d = prefixbpe.digests(docs, path, public_tokenizers.PATTERN)
    return docs.select("doc_id", d.alias("d")).select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


def planted(doc_id, w):
    """Words `w` (an array column), in one document of ten (by crc32 of the id)
    repeated from a point on. `w` should be a column, not an expression: the lambda
    reads it for every word."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size(w)
    a = F.pmod(g, F.greatest(n, F.lit(1)))
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    copied = F.transform(w, lambda x, i: F.when(i >= a, F.element_at(w, (a + F.pmod(i - a, p) + 1).cast("int"))).otherwise(x))
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), copied).otherwise(w)


def op13_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", words(F.col("text")).alias("words"))
    found = runs.periodic_runs(docs, planted(F.col("doc_id"), F.col("words")))

    def better(acc, r):
        return F.when(r["length"] * acc["period"] > acc["length"] * r["period"], r).otherwise(acc)

    best = F.aggregate(F.slice("runs", 2, 1 << 30), F.get(F.col("runs"), 0), better)
    listed = F.array_join(
        F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n"
    )
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id",
        "n_runs",
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_pii": op2_pii,
    "op3_warc": op3_warc,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_bpe": op6_bpe,
    "op7_minhash": op7_minhash,
    "op8_token_files": op8_token_files,
    "op9_top_k": op9_top_k,
    "op10_toxicity": op10_toxicity,
    "op11_resample": op11_resample,
    "op12_prefix_bpe": op12_prefix_bpe,
    "op13_runs": op13_runs,
}

ORACLES: dict[str, str] = {
    "op9_top_k": """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM scaled q, scaled c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op1_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, coalesce(source, chr(0)) AS site, i AS pos, string_split(text, chr(10))[i] AS line
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)
), long_lines AS (
  SELECT * FROM lines
  WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 5
), shared AS (
  SELECT line, min((doc_id, pos)) AS place FROM long_lines
  GROUP BY line HAVING count(DISTINCT site) >= 10
), kept AS (
  SELECT l.doc_id, l.pos, l.line, s.line IS NOT NULL AND (l.doc_id, l.pos) <> s.place AS gone
  FROM lines l LEFT JOIN shared s USING (line)
)
SELECT doc_id,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
       count(*) AS n_lines,
       count(*) FILTER (gone) AS n_removed
FROM kept GROUP BY doc_id
""",
}
