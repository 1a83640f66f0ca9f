"""Cleaned word frequencies and the stemmed vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import text as T
from glossmill.functions.rows import explode
from glossmill.functions.stemming import stem as stem_column
from glossmill.functions.stemming import stem_all
from glossmill.operators.counting import JobCounters, check_unit, count_terms


def body_tokens(
    case_sensitive: bool, skip_patterns: Sequence[str], stem: bool = False
) -> Column:
    """All tokens of `body`; a line end separates tokens like any blank."""
    body = T.prepare_body(F.col("body"), case_sensitive, skip_patterns)
    return T.word_runs(body) if stem else T.tokens(body)


def is_stop_list(stop_words) -> bool:
    return stop_words is not None and not isinstance(stop_words, DataFrame)


def without_stop_words(df: DataFrame, word: Column, stop_words) -> DataFrame:
    """Drop rows whose word is listed (exact match).

    A Python list becomes an IN set. A DataFrame is anti-joined without a hint:
    Spark broadcasts it only where its size is known to be under the threshold.
    """
    if stop_words is None:
        return df
    if is_stop_list(stop_words):
        listed = list(stop_words)
        return df.filter(~word.isin(listed)) if listed else df
    stops = stop_words.select(F.col(stop_words.columns[0]).alias("_stop")).distinct()
    return df.join(stops, word == F.col("_stop"), "left_anti")


def word_counts(
    records: DataFrame,
    stop_words=None,
    *,
    heading_token: str = "raw",
    case_sensitive: bool = True,
    skip_patterns: Sequence[str] = (),
    stem: bool = False,
    by_heading: bool = False,
    unit: str = "occurrence",
    min_freq: int = 10,
    counters: JobCounters | None = None,
) -> DataFrame:
    """Frequency of every cleaned word of `body`: `[heading,] word, freq`.

    With `by_heading`, `heading_token` chooses the token as found ("raw") or
    cleaned ("clean"); validity and stop words always look at the cleaned form.
    `stop_words` is a list or a one-column DataFrame.
    """
    check_unit(unit)
    if heading_token not in ("raw", "clean"):
        raise ValueError("heading_token must be 'raw' or 'clean'")
    keep = ["headings"] if by_heading else []
    raw_output = by_heading and heading_token == "raw"
    toks = body_tokens(case_sensitive, skip_patterns, stem)
    if unit == "document":
        df = records.select(*keep, (stem_all(toks) if stem else toks).alias("toks"))
        toks = F.array_distinct("toks")
        if not raw_output:
            toks = F.array_distinct(
                F.transform(F.filter(toks, T.has_letter), lambda t: T.clean_word(t))
            )
        words = explode(df, keep, toks, "raw")
        weight = None
    else:
        # Clean, stem and test each distinct token once, not each occurrence.
        words = explode(records, keep, toks, "raw")
        if by_heading:
            # Few headings and words recur, lists of headings seldom do.
            words = explode(words, ["raw"], "headings", "heading")
            keep = ["heading"]
        words = words.groupBy(*keep, "raw").agg(F.count(F.lit(1)).alias("_w"))
        weight = F.col("_w")
        if stem:
            words = words.withColumn("raw", stem_column("raw"))
    words = words.filter(T.has_letter(F.col("raw")))
    # In document mode the array step above has cleaned already.
    ready = unit == "document" and not raw_output
    cleaned = F.col("raw") if ready else T.clean_word(F.col("raw"))
    words = words.filter(T.valid_word(cleaned))
    # Where a row is one word of one record, the shorter list after the count is
    # the place for a stop table; emitted keys are counted without stop words.
    late = ready and isinstance(stop_words, DataFrame) and counters is None
    if not late:
        words = without_stop_words(words, cleaned, stop_words)
    carried = [] if weight is None else ["_w"]
    word = (F.col("raw") if raw_output else cleaned).alias("word")
    words = words.select(*keep, word, *carried)
    keys = ["word"]
    if by_heading:
        if unit == "document":
            headings = F.array_distinct("headings")
            words = explode(words, ["word", *carried], headings, "heading")
        keys = ["heading", "word"]
    counts = count_terms(words, keys, min_freq, counters, weight)
    if late:
        counts = without_stop_words(counts, F.col("word"), stop_words)
    return counts


def stem_vocabulary(
    records: DataFrame,
    *,
    case_sensitive: bool = True,
    skip_patterns: Sequence[str] = (),
) -> DataFrame:
    """Each distinct token with its stem and frequency: `token, stem, freq`."""
    toks = body_tokens(case_sensitive, skip_patterns, stem=True)
    vocabulary = count_terms(explode(records, [], toks, "token"), ["token"], 1)
    return vocabulary.select("token", stem_column("token").alias("stem"), "freq")
