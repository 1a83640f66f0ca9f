"""Counting terms by key, with a threshold after the final sum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

UNITS = ("occurrence", "document")


class JobCounters:
    """Row counts of one job: keys emitted, keys kept after the threshold.

    Pass a fresh instance to a job; read it after an action on the result.
    """

    def __init__(self) -> None:
        self._emitted = Observation("emitted")
        self._kept = Observation("kept")

    def on_emitted(self, df: DataFrame, total: Column) -> DataFrame:
        return df.observe(self._emitted, F.coalesce(total, F.lit(0)).alias("n"))

    def on_kept(self, df: DataFrame) -> DataFrame:
        return df.observe(self._kept, F.count(F.lit(1)).alias("n"))

    @property
    def emitted(self) -> int:
        return self._emitted.get["n"]

    @property
    def kept(self) -> int:
        return self._kept.get["n"]


def check_unit(unit: str, allowed=UNITS) -> None:
    if unit not in allowed:
        raise ValueError(f"unit must be one of {allowed}, not {unit!r}")


def count_terms(
    emitted: DataFrame,
    keys: list[str],
    min_freq: int,
    counters: JobCounters | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Sum per key (partial on the map side, then final), keep freq >= min_freq.

    `weight` is the number of rows one row stands for; one where it is absent.
    """
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    if counters is not None:
        emitted = counters.on_emitted(emitted, total)
    kept = (
        emitted.groupBy(*keys)
        .agg(total.cast("bigint").alias("freq"))
        .filter(F.col("freq") >= min_freq)
    )
    return kept if counters is None else counters.on_kept(kept)
