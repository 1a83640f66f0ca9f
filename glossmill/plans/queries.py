"""Queries over the driver tables, one per operator and option."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import glossmill as g
from glossmill.functions import text as T
from glossmill.functions.rows import explode, posexplode
from glossmill.operators import chunks as C
from glossmill.plans import corpus
from glossmill.sinks.tsv import to_lines

Query = Callable[[SparkSession, str], DataFrame]


def _on(view, job, **options) -> Query:
    return lambda spark, sf_dir: job(view(spark, sf_dir), **options)


def _with_stop_table(job, **options) -> Query:
    """`job` over the documents with the stop words given as a table, not a list."""

    def run(spark, sf_dir):
        stops = spark.createDataFrame([(w,) for w in corpus.STOP_WORDS], "word string")
        return job(corpus.documents(spark, sf_dir), stop_words=stops, **options)

    return run


def tokens(spark, sf_dir):
    docs = corpus.documents(spark, sf_dir)
    return posexplode(docs, ["doc_id"], T.tokens(F.col("body")), "at", "token")


def headings(spark, sf_dir):
    docs = corpus.headers(spark, sf_dir)
    return posexplode(docs, ["doc_id"], T.headings(F.col("header")), "at", "heading")


def parse_marked_records(spark, sf_dir):
    records = g.parse_marked(corpus.marked_text(spark, sf_dir))
    return records.select(
        "doc_id",
        "pub_date",
        "year",
        F.array_join("headings", "|").alias("headings"),
        T.strip_patterns(F.col("body")).alias("body"),
    )


def parse_chunk_records(spark, sf_dir):
    records = g.parse_chunked(corpus.chunked_text(spark, sf_dir))
    return records.select(
        "doc_id", "year", F.array_join("chunks", "\t").alias("chunks")
    )


def parse_tagged(spark, sf_dir):
    parsed = g.parse_tagged(corpus.tagged_text(spark, sf_dir))
    return parsed.select(
        F.array_join("tokens", " ").alias("tokens"), F.array_join("pos", " ").alias("pos")
    )


def parse_marked_malformed(spark, sf_dir):
    """Marked records with faults, kept with their reason ("ok": none); for faults the
    length of their raw text and no fields ("", 0)."""
    records = g.parse_marked(corpus.faulty_marked_text(spark, sf_dir), malformed="keep")
    faulty = F.col("reason").isNotNull()
    return records.select(
        F.coalesce("doc_id", F.lit("")).alias("doc_id"),
        F.coalesce("year", F.lit(0)).alias("year"),
        F.coalesce("reason", F.lit("ok")).alias("reason"),
        F.when(faulty, F.length("raw")).otherwise(0).cast("long").alias("raw_chars"),
    )


def parse_tagged_malformed(spark, sf_dir):
    """Tagged sentences with faults, kept with their reason (as above)."""
    parsed = g.parse_tagged(corpus.faulty_tagged_text(spark, sf_dir), malformed="keep")
    faulty = F.col("reason").isNotNull()
    return parsed.select(
        F.coalesce(F.array_join("tokens", " "), F.lit("")).alias("tokens"),
        F.coalesce(F.array_join("pos", " "), F.lit("")).alias("pos"),
        F.coalesce("reason", F.lit("ok")).alias("reason"),
        F.when(faulty, F.length("raw")).otherwise(0).cast("long").alias("raw_chars"),
    )


def yearly_from_lines(spark, sf_dir):
    return g.parse_yearly(corpus.count_lines(spark, sf_dir))


def _chunks(spark, sf_dir):
    return g.parse_chunked(corpus.chunked_text(spark, sf_dir))


def chunk_filter(spark, sf_dir):
    records = g.parse_chunked(
        corpus.chunked_text(spark, sf_dir), stop_words=corpus.STOP_WORDS
    )
    kept = explode(records, ["doc_id"], "chunks", "chunk")
    return kept.select("doc_id", C.normalise_chunk(F.col("chunk")).alias("term"))


def _yearly_words(spark, sf_dir, min_freq=1):
    docs = corpus.documents(spark, sf_dir)
    words = g.word_counts(
        docs.withColumn("headings", F.array(F.col("year").cast("string"))),
        by_heading=True,
        heading_token="clean",
        min_freq=min_freq,
    )
    return words.select(
        F.col("heading").cast("int").alias("year"), F.col("word").alias("term"), "freq"
    )


def bwi(spark, sf_dir):
    return g.rolling_term_sum(_yearly_words(spark, sf_dir))


def bwi_short(spark, sf_dir):
    return g.rolling_term_sum(corpus.short_yearly(spark, sf_dir))


def bwi_from_chunks(spark, sf_dir):
    yearly = g.chunk_counts(_chunks(spark, sf_dir), min_freq=2)
    return g.rolling_term_sum(yearly)


def bwi_lines(spark, sf_dir):
    trend = g.rolling_term_sum(corpus.short_yearly(spark, sf_dir))
    return to_lines(trend, g.trend_key()).select("line")


QUERIES: dict[str, Query] = {
    # tokens, headings and scans
    "tokens": tokens,
    "headings": headings,
    "parse_marked_records": parse_marked_records,
    "parse_chunk_records": parse_chunk_records,
    "parse_tagged": parse_tagged,
    "parse_marked_malformed": parse_marked_malformed,
    "parse_tagged_malformed": parse_tagged_malformed,
    "yearly_from_lines": yearly_from_lines,
    # n-grams
    "ngram1": _on(corpus.documents, g.ngrams, n=1),
    "ngram2": _on(corpus.documents, g.ngrams, n=2),
    "ngram3": _on(corpus.documents, g.ngrams, n=3),
    "ngram2_lower": _on(corpus.documents, g.ngrams, case_sensitive=False),
    "skip_patterns": _on(
        corpus.documents, g.ngrams, skip_patterns=[r"\d+", r",?\n[A-E]"]
    ),
    "ngram2_docfreq": _on(corpus.documents, g.ngrams, unit="document"),
    "ngram_by_heading": _on(corpus.documents, g.ngrams, by_heading=True),
    "ngram_by_heading_docfreq": _on(
        corpus.documents, g.ngrams, by_heading=True, unit="document", min_freq=5
    ),
    "ngram_sweep": _on(corpus.documents, g.ngram_sweep),
    "ngram2_markup": _on(corpus.pages, g.ngrams, min_freq=2),
    "ngram1_markup": _on(corpus.pages, g.ngrams, n=1, min_freq=2),
    "ngram3_chat": _on(
        corpus.conversations, g.ngrams, n=3, by_heading=True, min_freq=2
    ),
    # words
    "wordcount": _on(corpus.documents, g.word_counts),
    "wordcount_stop": _on(
        corpus.documents, g.word_counts, stop_words=corpus.STOP_WORDS
    ),
    "wordcount_stop_table": _with_stop_table(g.word_counts),
    "wordcount_lower": _on(corpus.documents, g.word_counts, case_sensitive=False),
    "wordcount_docfreq": _on(corpus.documents, g.word_counts, unit="document"),
    "wordcount_by_heading": _on(corpus.documents, g.word_counts, by_heading=True),
    "wordcount_by_heading_clean": _on(
        corpus.documents, g.word_counts, by_heading=True, heading_token="clean"
    ),
    "wordcount_by_heading_docfreq": _on(
        corpus.documents, g.word_counts, by_heading=True, unit="document"
    ),
    "wordcount_markup": _on(corpus.pages, g.word_counts, min_freq=2),
    # pairs
    "cooccur_sentence": _on(corpus.documents, g.cooccurrence),
    "cooccur_sentence_stop": _on(
        corpus.documents, g.cooccurrence, stop_words=corpus.STOP_WORDS
    ),
    "cooccur_sentence_stop_table": _with_stop_table(g.cooccurrence),
    "cooccur_document": _on(corpus.documents, g.cooccurrence, unit="document"),
    "cooccur_document_blocks": _on(
        corpus.documents, g.cooccurrence, unit="document", strategy="blocks"
    ),
    "cooccur_sentence_grid": _on(corpus.documents, g.cooccurrence, strategy="grid"),
    "cooccur_markup": _on(corpus.pages, g.cooccurrence),
    # chunks and trends
    "chunk_filter": chunk_filter,
    "chunk_by_year": _on(_chunks, g.chunk_counts),
    "chunk_by_year_lower": _on(_chunks, g.chunk_counts, case_sensitive=False),
    "chunk_by_doc": _on(_chunks, g.chunk_counts, by="doc_id", min_freq=2),
    "bwi": bwi,
    "bwi_short": bwi_short,
    "bwi_from_chunks": bwi_from_chunks,
    "bwi_lines": bwi_lines,
    "bwi_any_year": lambda spark, sf_dir: g.rolling_term_sum(corpus.wide_yearly(spark, sf_dir)),
    # tagged n-grams
    "tagged_ngram1": _on(corpus.tagged, g.tagged_ngrams, n=1),
    "tagged_ngram2": _on(corpus.tagged, g.tagged_ngrams, n=2),
    "tagged_ngram3": _on(corpus.tagged, g.tagged_ngrams, n=3),
    "tagged_ngram2_lower": _on(corpus.tagged, g.tagged_ngrams, case_sensitive=False),
    "tagged_ngram_legacy": _on(corpus.tagged, g.tagged_ngrams, layout="whole"),
    # stemming
    "stem_vocab": _on(corpus.documents, g.stem_vocabulary),
    "ngram2_stemmed": _on(corpus.documents, g.ngrams, stem=True),
    "ngram2_stemmed_docfreq": _on(
        corpus.documents, g.ngrams, stem=True, unit="document"
    ),
    "wordcount_stemmed": _on(corpus.documents, g.word_counts, stem=True),
}
