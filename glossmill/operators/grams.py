"""Word n-gram frequencies."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import text as T
from glossmill.functions.durable import durable, stored
from glossmill.functions.rows import explode
from glossmill.functions.stemming import stem_all
from glossmill.operators.counting import JobCounters, check_unit, count_terms
from glossmill.operators.lookup import BROADCAST_BYTES, fits, join_listed

# Every character the gram clean-up can remove.
_CUT = "()\"';:,"
# Bits of the table that marks frequent bigrams: at most so many, some per bigram.
MARK_BITS = 1 << 28
BITS_PER_MARK = 32
# Bits of the piece of that table that one group makes.
PIECE_BITS = 1 << 16


def token_lines(
    records: DataFrame,
    keep: Sequence[str] = (),
    *,
    case_sensitive: bool = True,
    skip_patterns: Sequence[str] = (),
    stem: bool = False,
    per_record: bool = False,
) -> DataFrame:
    """Token arrays of each line of `body`, next to the columns in `keep`.

    One row per line in `tokens`; with `per_record`, one row per record and an
    array of such arrays in `lines`.
    """
    body = T.prepare_body(F.col("body"), case_sensitive, skip_patterns)
    split_line = T.word_runs if stem else T.tokens
    if per_record and not stem:
        lines = F.transform(T.sentences(body), split_line)
        return records.select(*keep, lines.alias("lines"))
    lines = explode(records, keep, T.sentences(body), "line")
    toks = split_line(F.col("line"))
    return lines.select(*keep, (stem_all(toks) if stem else toks).alias("tokens"))


def _explode_grams(df: DataFrame, keep: Sequence[str], grams: Column) -> DataFrame:
    """One row per valid, cleaned gram."""
    raw = explode(df, keep, grams, "raw")
    valid = raw.filter(T.valid_raw_gram(F.col("raw")))
    return valid.select(*keep, T.clean_gram(F.col("raw")).alias("gram"))


def ngrams(
    records: DataFrame,
    n: int = 2,
    *,
    case_sensitive: bool = True,
    skip_patterns: Sequence[str] = (),
    stem: bool = False,
    by_heading: bool = False,
    unit: str = "occurrence",
    min_freq: int = 10,
    counters: JobCounters | None = None,
) -> DataFrame:
    """Frequency of every n-gram of `body`: `[heading,] gram, freq`.

    A gram never crosses a line. `unit="document"` counts a gram once per record
    (row), with `by_heading` once per record and heading.
    """
    check_unit(unit)
    keep = ["headings"] if by_heading else []
    text = dict(case_sensitive=case_sensitive, skip_patterns=skip_patterns)
    if unit == "occurrence":
        lines = token_lines(records, keep, stem=stem, **text)
        grams = _explode_grams(lines, keep, T.gram_windows(F.col("tokens"), n))
    else:
        if stem:
            records = stem_bodies(records, keep, **text)
            text = {}
        lines = token_lines(records, keep, per_record=True, **text)
        raw = F.array_distinct(
            F.flatten(F.transform("lines", lambda t: T.gram_windows(t, n)))
        )
        cleaned = F.array_distinct(
            F.transform(F.filter(raw, T.valid_raw_gram), T.clean_gram)
        )
        grams = explode(lines, keep, cleaned, "gram")
    if by_heading:
        headings = F.col("headings")
        if unit == "document":
            headings = F.array_distinct(headings)
        grams = explode(grams, ["gram"], headings, "heading")
        return count_terms(grams, ["heading", "gram"], min_freq, counters)
    return count_terms(grams, ["gram"], min_freq, counters)


def stem_bodies(
    records: DataFrame,
    keep: Sequence[str] = (),
    *,
    case_sensitive: bool = True,
    skip_patterns: Sequence[str] = (),
) -> DataFrame:
    """`body` with every token stemmed: lines of stems joined by blanks.

    Line ends travel through the stemmer as tokens of their own, so a record
    stays one row and is not regrouped.
    """
    body = T.prepare_body(F.col("body"), case_sensitive, skip_patterns)
    runs = F.regexp_extract_all(body, F.lit(r"\w+|\n"), F.lit(0))
    marked = records.select(*keep, stem_all(runs).alias("stems"))
    return marked.select(*keep, F.array_join("stems", " ").alias("body"))


def _mark(bigram: Column, bits: int) -> Column:
    """The place of a bigram, given by its hash, in the table of marks."""
    return F.pmod(bigram, F.lit(bits)).cast("int")


def _piece(rows: pa.Table) -> pa.Table:
    """One piece of the table of marks, as bytes."""
    marks = np.zeros(PIECE_BITS, np.uint8)
    marks[rows.column("bit").to_numpy()] = 1
    piece = rows.column("piece")[0].as_py()
    return pa.table(
        {"piece": pa.array([piece], pa.int32()), "marks": pa.array([np.packbits(marks).tobytes()], pa.binary())}
    )


def _mark_task(marks):
    """The row's marks looked up: which of its bigrams may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = marks.value
        for batch in batches:
            lists = batch.column("marks")
            at = lists.flatten().to_numpy(zero_copy_only=False)
            found = (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            offsets = lists.offsets.to_numpy()
            found = pa.ListArray.from_arrays(
                pa.array(offsets - offsets[0], pa.int32()), pa.array(found.astype(bool))
            )
            yield pa.record_batch(
                {"tokens": batch.column("tokens"), "copies": batch.column("copies"), "found": found}
            )

    return run


def _marked_runs(lines: DataFrame, often: DataFrame, bits: int) -> DataFrame:
    """`at, copies` as `_promising_runs`, without a shuffle of positions.

    Frequent bigrams are marked by hash in a table of bounded size that every task
    gets. A rare bigram with the mark of a frequent one costs grams, which the final
    threshold drops; no frequent one is missed.
    """
    mark = _mark(F.col("bigram"), bits)
    places = often.select(
        F.floor(mark / PIECE_BITS).cast("int").alias("piece"), (mark % PIECE_BITS).alias("bit")
    ).distinct()
    pieces = places.groupBy("piece").applyInArrow(_piece, "piece int, marks binary").toArrow()
    table = np.zeros(bits // 8, np.uint8)
    for piece, marks in zip(pieces.column("piece").to_pylist(), pieces.column("marks").to_pylist()):
        start = piece * (PIECE_BITS // 8)
        table[start : start + PIECE_BITS // 8] = np.frombuffer(marks, np.uint8)
    shared = lines.sparkSession.sparkContext.broadcast(table)
    # The last position has no bigram.
    whole = F.filter("bigrams", lambda b: b.isNotNull())
    marked = lines.select("tokens", "copies", F.transform(whole, lambda b: _mark(b, bits)).alias("marks"))
    found = marked.mapInArrow(
        _mark_task(shared), "tokens array<string>, copies bigint, found array<boolean>"
    )
    spots = F.transform(
        "tokens",
        lambda t, i: F.struct(i.alias("i"), t.alias("token"), F.get("tokens", i + 1).alias("next")),
    )
    at = F.filter(spots, lambda _, i: F.coalesce(F.get("found", i), F.lit(False)))
    return found.select("copies", at.alias("at")).filter(F.size("at") > 0)


def _promising_runs(
    lines: DataFrame, min_freq: int, broadcast_bytes: int
) -> DataFrame:
    """Distinct token lines reduced to the positions whose bigram is frequent:
    `at: array<struct<i, token, next>>, copies`.

    Clean-up only removes the characters of `_CUT`, so a gram is at most as
    frequent as each bigram inside it once these are ignored. Positions of rarer
    bigrams are in no gram of the result. Bigrams are counted by hash: a rare one that
    shares the hash of others may stay, and the final threshold drops its grams.
    """
    # Copies of a line become one row. A token has no blank, so a line is moved and kept
    # as one string; a line of one token has no gram of two.
    whole = lines.filter(F.size("tokens") > 1).select(F.array_join("tokens", " ").alias("line"))
    lines = stored(whole.groupBy("line").agg(F.count(F.lit(1)).alias("copies")), "lines")
    lines = lines.select(F.split("line", " ").alias("tokens"), "copies")
    bare = F.transform("tokens", lambda t: F.translate(t, _CUT, ""))
    lines = lines.select("tokens", "copies", bare.alias("bare"))
    hashed = F.transform(T.gram_windows(F.col("bare"), 2), lambda b: F.when(b.isNotNull(), F.xxhash64(b)))
    lines = lines.select("tokens", "copies", hashed.alias("bigrams"))
    bigrams = explode(lines, ["copies"], "bigrams", "bigram")
    often = count_terms(bigrams, ["bigram"], min_freq, weight=F.col("copies"))
    often = stored(often, "bigrams")
    bits = PIECE_BITS
    while bits < min(often.count() * BITS_PER_MARK, MARK_BITS):
        bits *= 2
    if bits // 8 <= broadcast_bytes:
        return _marked_runs(lines, often, bits)
    small = fits(often, "bigram", broadcast_bytes)
    line_id = F.unhex(F.sha2(F.array_join("tokens", " "), 256)).alias("line_id")
    spots = F.transform(
        "bigrams",
        lambda b, i: F.struct(
            b.alias("bigram"),
            i.alias("i"),
            F.get("tokens", i).alias("token"),
            F.get("tokens", i + 1).alias("next"),
        ),
    )
    lines = lines.select(line_id, "copies", spots.alias("spots"))
    rows = lines.select("line_id", "copies", F.inline_outer("spots"))
    rows = join_listed(
        rows.filter(F.col("bigram").isNotNull()), often, "bigram", "freq", small
    )
    spot = F.struct("i", "token", "next")
    return rows.groupBy("line_id", "copies").agg(
        F.sort_array(F.collect_list(spot)).alias("at")
    )


def _run_windows(lo: int, hi: int) -> Column:
    """Windows (n, gram) over positions that follow each other without a gap."""

    def windows(x: Column, k: Column) -> Column:
        found = []
        gram = x["token"]
        last = x
        for n in range(2, hi + 1):
            if n > 2:
                last = F.get("at", k + (n - 2))
                gram = F.concat(gram, F.lit(" "), last["token"])
            whole = F.concat(gram, F.lit(" "), last["next"])
            if n >= lo:
                unbroken = last["i"] == x["i"] + (n - 2)
                found.append(
                    F.struct(
                        F.lit(n).alias("n"), F.when(unbroken, whole).alias("gram")
                    )
                )
        return F.array(*found)

    return F.flatten(F.transform("at", windows))


def ngram_sweep(
    records: DataFrame,
    lo: int = 2,
    hi: int = 10,
    *,
    case_sensitive: bool = True,
    skip_patterns: Sequence[str] = (),
    min_freq: int = 10,
    prune: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    counters: JobCounters | None = None,
) -> DataFrame:
    """Occurrence counts of all n-grams, lo <= n <= hi: `n, gram, freq`.

    `prune` counts bigrams first (one job, its result checkpointed) and forms
    longer grams only where every bigram reaches `min_freq`: instead of some
    hi*hi/2 times the text, about the text and the frequent grams are shuffled.
    The result is the same. Counters see the keys that are formed.
    """
    lines = token_lines(
        records, case_sensitive=case_sensitive, skip_patterns=skip_patterns
    )
    if prune and min_freq > 1 and lo >= 2:
        runs = _promising_runs(lines, min_freq, broadcast_bytes)
        raw = runs.select("copies", F.inline_outer(_run_windows(lo, hi)))
        weight = F.col("copies")
        keep = ["copies"]
    else:
        windows = T.gram_windows_between(F.col("tokens"), lo, hi)
        raw = lines.select(F.inline_outer(windows))
        weight, keep = None, []
    valid = raw.filter(T.valid_raw_gram(F.col("gram")))
    grams = valid.select("n", *keep, T.clean_gram(F.col("gram")).alias("gram"))
    return count_terms(grams, ["n", "gram"], min_freq, counters, weight)
