"""Arrays to rows, without evaluating the array twice.

An inner generator makes the optimizer add a filter on the size of its input and
push it towards the scan, where it computes the whole tokenising chain again.
The outer form adds none; the row it yields for an empty array is dropped here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode(
    df: DataFrame, keep: Sequence[str | Column], array: Column | str, name: str
) -> DataFrame:
    """Columns `keep` and one row per element of `array` as `name`; NULLs go."""
    rows = df.select(*keep, F.explode_outer(array).alias(name))
    return rows.filter(F.col(name).isNotNull())


def posexplode(
    df: DataFrame,
    keep: Sequence[str | Column],
    array: Column | str,
    at: str,
    name: str,
) -> DataFrame:
    """As `explode`, with the position of the element as `at`."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(at, name))
    return rows.filter(F.col(name).isNotNull())
