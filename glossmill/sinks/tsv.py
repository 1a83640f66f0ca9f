"""Key/value text output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def yearly_key(by: str = "year") -> Column:
    """`year_term` (or `doc_id_term`)."""
    return F.concat_ws("_", F.col(by).cast("string"), F.col("term"))


def trend_key() -> Column:
    """`term_start-end`."""
    return F.concat(
        F.col("term"), F.lit("_"), F.col("start_year"), F.lit("-"), F.col("end_year")
    )


def to_lines(df: DataFrame, key: Column | Sequence[str], value: str = "freq"):
    """`key, line`: line is `key<TAB>value`; several key columns are tab-joined."""
    if not isinstance(key, Column):
        key = F.concat_ws("\t", *key)
    return df.select(
        key.alias("key"),
        F.concat_ws("\t", key, F.col(value).cast("string")).alias("line"),
    )


def write_tsv(
    df: DataFrame,
    path: str,
    key: Column | Sequence[str],
    value: str = "freq",
    parts: int = 40,
    compression: str | None = None,
) -> None:
    """One file per part, rows hashed to parts and sorted by key inside each.

    Fails if the target exists.
    """
    lines = to_lines(df, key, value)
    writer = (
        lines.repartition(parts, "key")
        .sortWithinPartitions("key")
        .select("line")
        .write.mode("errorifexists")
    )
    if compression is not None:
        writer = writer.option("compression", compression)
    writer.text(path)
