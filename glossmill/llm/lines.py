"""Removal of lines that many sites share.

A line is boilerplate if it stands on at least `min_sites` distinct sites. Per
line hash a HyperLogLog sketch of its sites is built on the map side and merged
by aggregation, so a line found everywhere costs one sketch per task. Only where
a sketch's estimate is too near the threshold to decide are sites counted
exactly. The first document with a boilerplate line keeps it, so no text is lost
altogether; all others lose it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.functions.rows import posexplode
from glossmill.llm.common import digest_key, let

MIN_SITES = 10
MIN_WORDS = 5
SKETCH_BITS = 12
#: Relative distance from the threshold within which an estimate does not decide:
#: five standard errors of a sketch of this size.
BAND = 5 * 1.04 / (2 ** (SKETCH_BITS / 2))


def _numbered_lines(docs, text, site, key, min_words):
    """Row key, site, order of the row, and position and hashes of its lines."""
    named = docs.select(
        *[c.alias(f"__r{i}") for i, c in enumerate(digest_key(*map(F.col, (key, site, text))))],
        F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key")).alias("__order"),
        F.when(F.col(site).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(site).cast("string"))).alias("__site"),
        F.split(F.col(text), "\n").alias("__lines"),
    )
    rows = posexplode(named, ["__r0", "__r1", "__order", "__site"], "__lines", "__at", "__line")
    long_enough = F.col("__line").rlike(
        r"\A[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){%d}" % min_words
    )
    return rows.filter(long_enough).select(
        "__r0", "__r1", "__order", "__site", "__at",
        F.xxhash64("__line").alias("__h0"),
        F.xxhash64(F.lit(1), "__line").alias("__h1"),
    )


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """`__h0, __h1, __first`: hashes of lines on at least `min_sites` sites.

    `__first` is the first place of the line: order of the row, position, key.
    """
    line = ["__h0", "__h1"]
    place = F.struct("__order", "__r0", "__r1", "__at")
    spread = lines.groupBy(*line).agg(
        F.hll_sketch_agg("__site", F.lit(SKETCH_BITS)).alias("__sketch"),
        F.min(place).alias("__first"),
    )
    guess = F.hll_sketch_estimate("__sketch")
    spread = spread.select(*line, "__first", guess.alias("__guess")).filter(
        F.col("__guess") >= min_sites * (1 - BAND)
    )
    near = F.col("__guess") <= min_sites * (1 + BAND)
    exact = (
        lines.select(*line, "__site")
        .join(spread.filter(near).select(*line), line, "left_semi")
        .distinct()
        .groupBy(*line)
        .agg(F.count("*").alias("__sites"))
    )
    decided = spread.join(exact, line, "left")
    enough = F.coalesce(F.col("__sites"), F.col("__guess")) >= min_sites
    return decided.filter(enough).select(*line, "__first")


def without_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    text: str = "text",
    site: str = "source",
    key: str = "doc_id",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """`docs` with the text cleaned, and `n_lines, n_removed` (long).

    Lines are what `\n` separates; those of under `min_words` words are left
    alone; with 1 the number of sites alone decides on every line that has a word. A
    NULL text stays NULL with 0 lines, an empty one has one line. A NULL site is
    a site of its own. Of several documents with a line the one with the smallest
    key keeps its first occurrence (NULL keys come last). Rows equal in key, site
    and text are one document in two copies and are treated alike. An empty table
    stays empty.
    """
    columns = docs.columns
    lines = _numbered_lines(docs, text, site, key, min_words)
    found = lines.join(boilerplate(lines, min_sites), ["__h0", "__h1"])
    here = F.struct("__order", "__r0", "__r1", "__at")
    drops = (
        found.filter(here != F.col("__first"))
        .groupBy("__r0", "__r1")
        .agg(F.collect_set("__at").alias("__drops"))
    )
    keys = [
        c.alias(f"__r{i}")
        for i, c in enumerate(digest_key(*map(F.col, (key, site, text))))
    ]
    marked = docs.select("*", *keys).join(drops, ["__r0", "__r1"], "left")
    parts = F.split(F.col(text), "\n")
    kept = let(
        parts,
        lambda p: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(p) - 1), F.col("__drops")),
                lambda at: F.get(p, at),
            ),
            "\n",
        ),
    )
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long")
    removed = F.coalesce(F.size("__drops"), F.lit(0)).cast("long")
    cleaned = F.when(F.col("__drops").isNull(), F.col(text)).otherwise(kept)
    return marked.select(
        *[cleaned.alias(c) if c == text else F.col(c) for c in columns],
        n_lines.alias("n_lines"),
        F.when(F.col("__drops").isNull(), 0).otherwise(removed).cast("long").alias("n_removed"),
    )


def cleaned_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents with cleaned texts, same columns; those left without a word go.

    Only documents that lost a line can go: all their words stand in documents
    that keep them.
    """
    text = options.get("text", "text")
    columns = docs.columns
    inner = docs.select(
        *[F.col(options.get(k, d)) for k, d in (("key", "doc_id"), ("site", "source"))],
        F.col(text),
        F.struct(*[F.col(c) for c in columns if c != text]).alias("__rest"),
    )
    out = without_boilerplate(inner, **options)
    emptied = (F.col("n_removed") > 0) & ~F.col(text).rlike(r"[^\x20\x09-\x0D]")
    return out.filter(~emptied).select(
        *[F.col(text) if c == text else F.col("__rest")[c].alias(c) for c in columns]
    )
