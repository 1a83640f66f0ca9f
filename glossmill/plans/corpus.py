"""Views of the driver tables in the shapes the operators read."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import text as T
from glossmill.functions.rows import explode

# Text that one task reads, about: what it counts before the shuffle stays in memory.
TASK_BYTES = 8_000_000
STOP_WORDS = ["the", "of", "and", "to", "in", "de", "la", "le", "der", "die"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str, key: str, *columns):
    """Key and columns of a text table, in tasks of about TASK_BYTES of text.

    The number of tasks grows with the text: each sums its terms in memory, which
    slows down and spills where a task reads more (one row group of text is minutes
    of work). A table of too few splits is spread by key and text; one with enough
    of them is read as it lies.
    """
    df = table(spark, sf_dir, name).select(key, *columns)
    body = "html" if "html" in columns else "text"
    size = table(spark, sf_dir, name).agg(F.sum(F.octet_length(body))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, key, body)


def pseudo_year() -> Column:
    return (F.lit(1990) + F.col("doc_id") % 25).cast("int")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`doc_id, year, headings, body`; one final [.?] of each line removed."""
    docs = text_table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return docs.select(
        "doc_id",
        pseudo_year().alias("year"),
        F.array("source", "lang").alias("headings"),
        F.regexp_replace("text", r"[.?](?=\n|\z)", "").alias("body"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`doc_id, body`: raw markup, rich in quotes, brackets and arrows."""
    return text_table(spark, sf_dir, "pages", "page_id", "html").select(
        F.col("page_id").alias("doc_id"), F.col("html").alias("body")
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`doc_id, headings, body`: one record per turn, its role as heading."""
    turns = text_table(spark, sf_dir, "conversations", "conv_id", "role", "text")
    return turns.select(
        F.col("conv_id").alias("doc_id"),
        F.array("role").alias("headings"),
        F.col("text").alias("body"),
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`doc_id, header` in the shapes of the header grammar, by doc_id."""
    start = F.concat(F.col("doc_id"), F.lit(":"), pseudo_year())
    shapes = [
        ("", False), (":", False), (":%s|%s", True), (":%s:%s", True),
        (":%s|", True), (":|%s", True), (":|", False), (":%s|%s|%s", True),
    ]
    header = F.lit(None).cast("string")
    for i, (shape, filled) in enumerate(shapes):
        args = [F.col("source"), F.col("lang"), F.col("source")]
        tail = (
            F.format_string(shape, *args[: shape.count("%s")])
            if filled
            else F.lit(shape)
        )
        header = F.when(
            F.col("doc_id") % len(shapes) == i, F.concat(start, tail)
        ).otherwise(header)
    return table(spark, sf_dir, "documents").select("doc_id", header.alias("header"))


def marked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`value`: each document as a marked record."""
    wrapped = F.regexp_replace("text", r"(?m)^(.*)$", '<s n="1">$1</s>')
    docs = text_table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return docs.select(
        F.concat(
            F.lit("_pubmed_id="), F.col("doc_id"), F.lit(":"), pseudo_year(),
            F.lit(" Jun 11:"), F.col("source"), F.lit("|"), F.col("lang"),
            F.lit("\n_ArticleTitle_\n_AbstractText_\n"), wrapped,
            F.lit("\n_pubmed_id_end_\n"),
        ).alias("value")
    )


def chunked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`value`: each document as a chunked record, one comma piece per line."""
    pieces = F.regexp_replace(
        F.regexp_replace("text", "\n", "\n[EOS]\n"), ", ?", "\n,\n"
    )
    docs = text_table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return docs.select(
        F.concat(
            F.lit("_pubmed_id="), F.col("doc_id"), F.lit(":"), pseudo_year(),
            F.lit("\n_ArticleTitle_\n_AbstractText_\n"), pieces,
            F.lit("\n[EOS]\n_pubmed_id_end_\n"),
        ).alias("value")
    )


def _tags(toks: Column) -> Column:
    return F.transform(
        toks,
        lambda t: F.when(t.rlike(r"\A[A-Z]"), F.lit("NNP"))
        .when(t.rlike(r"[0-9]"), F.lit("CD"))
        .otherwise(F.lit("NN")),
    )


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`tokens, pos` of each line that has a token."""
    docs = documents(spark, sf_dir)
    lines = explode(docs, [], T.sentences(F.col("body")), "line")
    lines = lines.filter(F.col("line").rlike(T.TOKEN))
    toks = lines.select(T.tokens(F.col("line")).alias("tokens"))
    return toks.select("tokens", _tags(F.col("tokens")).alias("pos"))


def tagged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`value`: each tagged line as a block of four lines."""

    def line(mark, column):
        return F.concat(F.lit(mark + "\t"), F.array_join(column, "\t"), F.lit("\n"))

    return tagged(spark, sf_dir).select(
        F.concat(
            line("TOK:", "tokens"), line("POS:", "pos"),
            line("LEM:", F.transform("tokens", F.lower)), line("CNK:", "pos"),
        ).alias("value")
    )


def count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`value`: orders per year and priority as yearly count lines."""
    return short_yearly(spark, sf_dir).select(
        F.concat(
            F.col("year"), F.lit("_"), F.col("term"), F.lit("\t"), F.col("freq")
        ).alias("value")
    )


def short_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`year, term, freq`: orders per year and priority."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("term")
        )
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def wide_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`year, term, freq`: orders per priority and a year spread over 20,011 years,
    negative ones included (o_orderkey % 20011 - 10000)."""
    year = (F.col("o_orderkey") % 20011 - 10000).cast("int")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(year.alias("year"), F.col("o_orderpriority").alias("term"))
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def faulty_marked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`value`: each document as a marked record, some with faults set by its id.

    Id % 3 == 0: the id is written in brackets, a header that looks like a body
    line; id % 5 == 1: stray text before the marker; id % 7 == 3: no closing marker.
    """
    docs = text_table(spark, sf_dir, "documents", "doc_id", "text")
    i = F.col("doc_id")
    name = F.when(i % 3 == 0, F.concat(F.lit("["), i, F.lit("]"))).otherwise(i.cast("string"))
    stray = F.when(i % 5 == 1, F.concat(F.lit("stray "), i, F.lit("\n"))).otherwise(F.lit(""))
    end = F.when(i % 7 == 3, F.lit("")).otherwise(F.lit("\n_pubmed_id_end_\n"))
    return docs.select(
        F.concat(
            stray, F.lit("_pubmed_id="), name, F.lit(":"), pseudo_year(),
            F.lit("\n_ArticleTitle_\n_AbstractText_\n"), F.coalesce("text", F.lit("")), end,
        ).alias("value")
    )


def faulty_tagged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`value`: each tagged line as a block, some with faults set by its length n.

    n % 3 == 0: junk before the token line; n % 4 == 1: no tag line; n % 5 == 2: no
    closing line.
    """

    def line(mark, column):
        return F.concat(F.lit(mark + "\t"), F.array_join(column, "\t"), F.lit("\n"))

    n = F.size("tokens")
    none = F.lit("")
    return tagged(spark, sf_dir).select(
        F.concat(
            F.when(n % 3 == 0, F.lit("junk\n")).otherwise(none),
            line("TOK:", "tokens"),
            F.when(n % 4 == 1, none).otherwise(line("POS:", "pos")),
            F.when(n % 5 == 2, none).otherwise(line("CNK:", "pos")),
        ).alias("value")
    )
