"""Word lists and pattern lists, one entry per line."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession



def _lines(spark: SparkSession, path) -> DataFrame | None:
    """Lines of a file, or None with a warning where it cannot be read."""
    try:
        return spark.read.text(path)
    except AnalysisException as error:
        warnings.warn(f"no entries read from {path}: {error}", stacklevel=3)
        return None


def read_word_table(spark: SparkSession, path) -> DataFrame:
    """`word` table of a list of any length, for the operators' `stop_words`.

    A missing list means no words, with a warning.
    """
    lines = _lines(spark, path)
    if lines is None:
        return spark.createDataFrame([], "word string")
    return lines.toDF("word")


def read_stop_words(spark: SparkSession, path) -> list[str]:
    """Words of a list that is to travel inside query plans; see `read_word_table`.

    A missing list means no stop words, with a warning.
    """
    lines = _lines(spark, path)
    return [] if lines is None else [row[0] for row in lines.collect()]


def read_skip_patterns(spark: SparkSession, *paths: str) -> list[str]:
    """Regular expressions of one or more files, files and lines in order."""
    patterns: list[str] = []
    for path in paths:
        patterns += [row[0] for row in spark.read.text(path).coalesce(1).collect()]
    return [p for p in patterns if p]
