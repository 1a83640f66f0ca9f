"""Sliding multi-year sums of yearly term frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossmill.operators.counting import JobCounters


_MODES = ("fail", "drop")


def rolling_term_sum(
    yearly: DataFrame,
    span: int = 10,
    min_history: int = 4,
    malformed: str = "fail",
    counters: JobCounters | None = None,
) -> DataFrame:
    """Sum of each term's frequency over `span` years from every start year:
    `term, start_year, end_year, freq`.

    Start years run from the first year of a term, also through years without
    data, as long as at least `min_history` years are left until its last one;
    a window is cut at the last year. A year is any whole number; one that is none
    fails the job or, with malformed="drop", loses its row. Windows and sums run
    over the rows of data and the points where a sum changes, never over the empty
    years between them; start years are spelled out only in the last step, by a
    generator after the last shuffle, so a term of any span takes no more memory.
    """
    if malformed not in _MODES:
        raise ValueError(f"malformed must be one of {_MODES}")
    year = F.col("year").cast("string").try_cast("int")
    rows = yearly.select("term", year.alias("year"), "freq", F.col("year").alias("_raw"))
    if malformed == "drop":
        rows = rows.filter(F.col("year").isNotNull())
    else:
        message = F.concat(F.lit("bad year: "), F.coalesce(F.col("_raw").cast("string"), F.lit("NULL")))
        rows = rows.withColumn("year", F.coalesce("year", F.raise_error(message).cast("int")))
    if counters is not None:
        rows = counters.on_emitted(rows, F.count(F.lit(1)))
    totals = rows.groupBy("term", "year").agg(F.sum("freq").cast("bigint").alias("freq"))
    of_term = Window.partitionBy("term")
    in_order = of_term.orderBy("year")
    placed = totals.select(
        "term",
        "year",
        "freq",
        F.lead("year").over(in_order).alias("next_year"),
        F.max("year").over(of_term).alias("last"),
        F.min("year").over(of_term).alias("first"),
    ).filter(F.col("last").cast("long") - F.col("first") >= min_history)
    # The sum from a start year changes only where a year enters (start = year -
    # span + 1) or leaves (start = year + 1) its window: sums are taken at these
    # points, over the rows of data only, and each holds until the next point.
    final = F.col("last") - min_history
    year = F.col("year").cast("long")
    nothing = F.lit(None).cast("bigint")

    def point(x):
        return F.struct(x.alias("x"), nothing.alias("_freq"), F.lit(True).alias("_point"))

    rows_and_points = F.array(
        F.struct(year.alias("x"), F.col("freq").cast("bigint").alias("_freq"), F.lit(False).alias("_point")),
        point(F.when(year == F.col("first"), year)),
        point(year + 1),
        point(year - (span - 1)),
    )
    both = placed.select("term", "first", "last", F.explode(rows_and_points).alias("e")).select(
        "term", "first", "last", "e.*"
    )
    both = both.filter(
        ~F.col("_point") | (F.col("x").isNotNull() & (F.col("x") >= F.col("first")) & (F.col("x") <= final))
    )
    ahead = of_term.orderBy("x").rangeBetween(0, span - 1)
    summed = both.withColumn("freq", F.coalesce(F.sum("_freq").over(ahead), F.lit(0)).cast("bigint"))
    at_points = summed.filter("_point")
    following = of_term.orderBy("x")
    pieces = at_points.select(
        "term",
        "last",
        "x",
        "freq",
        F.coalesce(F.lead("x").over(following) - 1, final.cast("long")).alias("_until"),
    )
    # a point met twice holds until itself minus one: no years
    sums = pieces.filter(F.col("_until") >= F.col("x")).select(
        "term",
        "last",
        "freq",
        F.explode(F.sequence("x", "_until")).alias("start_year"),
    ).select(
        "term",
        F.col("start_year").cast("int").alias("start_year"),
        F.least(F.col("start_year") + (span - 1), F.col("last")).cast("int").alias("end_year"),
        "freq",
    )
    return sums if counters is None else counters.on_kept(sums)
