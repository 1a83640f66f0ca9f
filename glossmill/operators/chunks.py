"""Phrase-chunk frequencies per year or per document."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import text as T
from glossmill.functions.rows import explode, posexplode
from glossmill.operators.counting import JobCounters, count_terms
from glossmill.operators.words import without_stop_words

# --- Fixed values: the shape of a chunk, and which chunks count. ---
TAGGED = r"\A\[[A-Z]+ "
FRAME_OPEN = "[NP "
FRAME_CLOSE = " ]"
END_PUNCTUATION = r"(?:(?<! ) ++|(?<![ ;:,.]))[;:,.]++ ]\z"
MIN_LENGTH = 8
BAD_START = r"\A\[\w+ [)>,.]"
TAG_AND_SYMBOLS = r"\A\[[A-Z]+ \W*"
BAD_TEXT = r"(?s)\A(?:.?|\s*|[\W\d]*|[Pp]\s?[=<](?:[\d\s.]+)?|[Ii]+)\z"
ARTICLE = r"\A\[NP (?:[Aa]n?|[Tt]he) "
LONE_CLOSER_IN_CHUNK = (
    r"\A(\[(?:[^()]*[^()\x00-\x20]|[\x00-\x20]))[\x00-\x20]*+\) \]\z"
)
# --- End of fixed values. ---


def frame_chunk(line: Column) -> Column:
    """`[TAG words ]` form of one line, end punctuation removed."""
    framed = F.when(line.rlike(TAGGED), line).otherwise(
        F.concat(F.lit(FRAME_OPEN), line, F.lit(FRAME_CLOSE))
    )
    closed = F.when(framed.endswith(FRAME_CLOSE), framed).otherwise(
        F.concat(framed, F.lit(FRAME_CLOSE))
    )
    return F.regexp_replace(closed, F.lit(END_PUNCTUATION), F.lit(FRAME_CLOSE))


def chunk_text(framed: Column) -> Column:
    """Text of a framed chunk without tag, leading symbols and closing bracket."""
    inner = T.java_trim(F.substring(framed, F.lit(1), F.length(framed) - 2))
    return F.regexp_replace(inner, F.lit(TAG_AND_SYMBOLS), F.lit(""))


def valid_chunk(framed: Column) -> Column:
    return (
        (F.length(framed) >= MIN_LENGTH)
        & ~framed.rlike(BAD_START)
        & ~chunk_text(framed).rlike(BAD_TEXT)
    )


def normalise_chunk(chunk: Column) -> Column:
    """Article after an opening `[NP ` and a closing parenthesis with no partner go."""
    bare = F.regexp_replace(chunk, F.lit(ARTICLE), F.lit(FRAME_OPEN))
    return F.regexp_replace(bare, F.lit(LONE_CLOSER_IN_CHUNK), F.lit("$1 ]"))


def chunk_counts(
    chunks: DataFrame,
    by: str = "year",
    *,
    stop_words=None,
    case_sensitive: bool = True,
    skip_patterns: Sequence[str] = (),
    min_freq: int = 5,
    counters: JobCounters | None = None,
) -> DataFrame:
    """Frequency of each chunk per `year` or `doc_id`: `<by>, term, freq`.

    `stop_words` (list or one-column DataFrame) drops chunks whose text is
    listed, as the chunk scan does with a list.
    """
    if by not in ("year", "doc_id"):
        raise ValueError("by must be 'year' or 'doc_id'")
    if skip_patterns:
        # A pattern sees the whole record, tabs between its chunks.
        records = chunks
        if isinstance(stop_words, DataFrame):
            records = _without_listed(chunks, by, stop_words)
        joined = F.array_join(F.filter("chunks", _not_listed(stop_words)), "\t")
        joined = joined if case_sensitive else F.lower(joined)
        joined = reduce(
            lambda c, p: F.regexp_replace(c, F.lit(p), F.lit("")), skip_patterns, joined
        )
        rows = explode(records, [by], F.split(joined, "\t"), "chunk")
    else:
        rows = explode(chunks, [by], "chunks", "chunk")
        if stop_words is not None:
            rows = without_stop_words(rows, chunk_text(F.col("chunk")), stop_words)
        # A tab inside a chunk ends it.
        rows = explode(rows, [by], F.split("chunk", "\t"), "chunk")
        if not case_sensitive:
            rows = rows.select(by, F.lower("chunk").alias("chunk"))
    rows = rows.filter(F.col("chunk") != "")
    terms = rows.select(by, normalise_chunk(F.col("chunk")).alias("term"))
    return count_terms(terms, [by, "term"], min_freq, counters)


def _without_listed(chunks: DataFrame, by: str, stop_words: DataFrame) -> DataFrame:
    """`by, chunks` of each record without its listed chunks, in their order.

    Chunks leave their record for the anti-join and are put together again by the
    digest of the record, with the number of records that are equal.
    """
    whole = chunks.select(by, "chunks").groupBy(by, "chunks").agg(F.count("*").alias("_n"))
    digest = F.sha2(F.to_json(F.struct(by, "chunks")), 256).alias("_record")
    each = posexplode(whole.select(by, "_n", "chunks", digest), [by, "_n", "_record"], "chunks", "_at", "chunk")
    left = without_stop_words(each, chunk_text(F.col("chunk")), stop_words)
    again = left.groupBy("_record", by, "_n").agg(
        F.sort_array(F.collect_list(F.struct("_at", "chunk"))).alias("_chunks")
    )
    return again.select(
        by,
        F.transform("_chunks", lambda c: c["chunk"]).alias("chunks"),
        F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))),
    ).drop("col")


def _not_listed(stop_words):
    def test(chunk):
        if not stop_words or isinstance(stop_words, DataFrame):
            return F.lit(True)
        return ~chunk_text(chunk).isin(list(stop_words))

    return test
