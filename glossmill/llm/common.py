"""What the operators of this subpackage share."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than ASCII white space.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="glossmill-scratch-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that the session names.

    spark.checkpoint.dir is the one setting for it; a local session without it
    (tests) gets a temporary folder, a cluster job must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again.

    Cuts the lineage: nothing above is computed twice, and what comes after a
    lost executor reads the same rows.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, also where lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words of a text in order; none for NULL."""
    split = F.filter(F.split(text, SPACES), lambda w: w != "")
    return F.coalesce(split, F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest_key(*columns: Column) -> list[Column]:
    """Two 64-bit hashes that name a row by its content.

    NULL and empty differ; rows with equal columns get equal keys.
    """
    flags = [c.isNull() for c in columns]
    return [
        F.xxhash64(F.lit(1), *columns, *flags),
        F.xxhash64(F.lit(2), *flags, *reversed(columns)),
    ]
