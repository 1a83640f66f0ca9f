"""n-grams of part-of-speech tagged sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.functions import text as T
from glossmill.operators.counting import JobCounters, count_terms

# --- Fixed values: tokens that may not open / close a tagged gram. ---
BAD_FIRST = r"\A[\s!#$%&*+).\d-]*\z"
BAD_LAST = r"\A[\s!#$%&*+(.\d-]*\z"
EMPTY_QUOTES = "''"
# --- End of fixed values. ---

LAYOUTS = {
    "split": ["first", "middle", "last", "pos_first", "pos_last"],
    "whole": ["gram", "pos_first", "last"],
}


def tagged_ngrams(
    tagged: DataFrame,
    n: int = 2,
    *,
    case_sensitive: bool = True,
    min_freq: int = 10,
    layout: str = "split",
    counters: JobCounters | None = None,
) -> DataFrame:
    """Frequency of n-grams of `tokens` with the tags (`pos`) of both ends.

    layout "split": `first, middle, last, pos_first, pos_last, freq`;
    layout "whole": `gram, pos_first, last, freq`, the tag empty for n = 1.
    A gram the clean-up would change is dropped, not repaired. So is one whose
    end has no tag.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {tuple(LAYOUTS)}")
    toks = F.col("tokens")
    if not case_sensitive:
        toks = F.transform(toks, F.lower)
    lines = tagged.select(toks.alias("tokens"), "pos")

    def window(x, i):
        return F.struct(
            F.slice("tokens", i + 1, n).alias("toks"),
            F.get("pos", i).alias("pos_first"),
            F.get("pos", i + (n - 1)).alias("pos_last"),
        )

    rows = lines.select(F.inline_outer(F.transform("tokens", window)))
    rows = rows.filter(F.size("toks") == n)
    first, last = F.get("toks", F.lit(0)), F.get("toks", F.lit(n - 1))
    rows = rows.select(
        first.alias("first"),
        T.java_trim(F.array_join(F.slice("toks", 2, max(n - 2, 0)), " ")).alias(
            "middle"
        ),
        last.alias("last"),
        "pos_first",
        "pos_last",
        T.java_trim(F.array_join("toks", " ")).alias("gram"),
    )
    keep = (
        F.col("pos_first").isNotNull()
        & F.col("pos_last").isNotNull()
        & T.has_letter(F.col("gram"))
        & ~F.col("first").rlike(BAD_FIRST)
        & ~F.col("last").rlike(BAD_LAST)
        & (F.col("first") != EMPTY_QUOTES)
        & (F.col("last") != EMPTY_QUOTES)
        & T.gram_is_stable(F.col("gram"))
    )
    rows = rows.filter(keep)
    if layout == "whole" and n == 1:
        rows = rows.withColumn("pos_first", F.lit(""))
    return count_terms(rows, LAYOUTS[layout], min_freq, counters)
