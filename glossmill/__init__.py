"""Corpus n-gram, word, co-occurrence and term-trend counting on Spark."""

from glossmill.operators.chunks import chunk_counts
from glossmill.operators.counting import JobCounters
from glossmill.operators.grams import ngram_sweep, ngrams
from glossmill.operators.pairs import cooccurrence
from glossmill.operators.tagged import tagged_ngrams
from glossmill.operators.trends import rolling_term_sum
from glossmill.operators.words import stem_vocabulary, word_counts
from glossmill.sinks.tsv import trend_key, write_tsv, yearly_key
from glossmill.sources.records import (
    parse_chunked,
    parse_marked,
    parse_tagged,
    parse_yearly,
    read_chunked,
    read_marked,
    read_tagged,
    read_yearly,
)
from glossmill.sources.wordlists import (
    read_skip_patterns,
    read_stop_words,
    read_word_table,
)

__all__ = [
    "JobCounters",
    "chunk_counts",
    "cooccurrence",
    "ngram_sweep",
    "ngrams",
    "parse_chunked",
    "parse_marked",
    "parse_tagged",
    "parse_yearly",
    "read_chunked",
    "read_marked",
    "read_skip_patterns",
    "read_stop_words",
    "read_tagged",
    "read_word_table",
    "read_yearly",
    "rolling_term_sum",
    "stem_vocabulary",
    "tagged_ngrams",
    "trend_key",
    "word_counts",
    "write_tsv",
    "yearly_key",
]
