"""Quality of documents by weak supervision.

Rules vote good, vote bad or abstain on each document. Expectation-maximisation
over the vote patterns estimates how often each rule is right on good and on bad
documents without any label; the posterior probability of "good" given all votes
then decides, so one rule alone cannot reject a document.

Only column expressions touch the documents. What the estimation reads is the
number of documents of each vote pattern: at most 3 to the number of rules
(19683 here), whatever the size of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import let, stored, words

WINDOW = 5  # words of a repeated window
ROUNDS = 50  # of expectation-maximisation
BELIEF = 0.02  # weight of what follows, as a share of the documents
#: How often a rule is taken to vote bad, abstain, vote good before any is seen.
ON_GOOD, ON_BAD = (0.02, 0.49, 0.49), (0.4, 0.4, 0.2)
PRIOR = 0.8  # share of good documents, likewise
GOOD = 0.5  # posterior from which a document is kept

#: The base rules: (feature, condition) under which a document fails at once.
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"

#: rule -> (condition for good, condition for bad); neither: it abstains.
RULES: Mapping[str, tuple[str, str]] = {
    "symbols": ("false", "10 * n_symbols > n_words"),
    "letters": ("100 * n_alnum >= 90 * word_chars", "100 * n_alnum < 80 * word_chars"),
    "case": ("false", "2 * n_upper > n_alnum AND n_alnum > 20"),
    "exclamation": ("false", "10 * n_exclaim > n_words"),
    "repetition": ("false", "10 * n_repeat_words > n_words"),
    "stutter": ("false", "5 * n_stutter > n_words"),
    "lines": ("false", "10 * n_dup_lines > 3 * n_lines"),
    "sentences": ("2 * n_ends >= n_lines", "5 * n_ends < n_lines"),
    "word length": ("word_chars BETWEEN 3 * n_words AND 10 * n_words",
                    "word_chars > 20 * n_words OR word_chars < 2 * n_words"),
}


def repeated_words(ws: Column, size: int = WINDOW) -> Column:
    """Number of words that lie in a window of `size` words found at least twice.

    Windows are compared by 64-bit hash. Sorted hashes show whether any is
    repeated; only such a text pays for sorting positions along.
    """

    def windows(hashes):
        starts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (size - 1), F.lit(0)))
        return F.transform(
            starts,
            lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, size)]),
        )

    def covered(grams):
        pairs = F.array_sort(
            F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        )
        twice = let(
            pairs,
            lambda p: F.filter(
                p,
                lambda x, i: (x["g"] == F.get(p, i + 1)["g"])
                | ((i > 0) & (x["g"] == F.get(p, F.greatest(i - 1, F.lit(0)))["g"])),
            ),
        )
        at = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return let(
            at,
            lambda a: F.aggregate(
                F.transform(
                    a,
                    lambda x, i: F.least(
                        F.lit(size), F.coalesce(F.get(a, i + 1) - x, F.lit(size))
                    ),
                ),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )

    def count(grams):
        ordered = F.sort_array(grams)
        any_twice = let(
            ordered,
            lambda s: F.size(F.array_distinct(s)) < F.size(s),
        )
        return F.when(any_twice, covered(grams)).otherwise(F.lit(0))

    hashes = F.transform(ws, lambda w: F.xxhash64(w))
    return let(let(hashes, windows), count).cast("long")


def features(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with one count per column, NULL texts as empty.

    A column of `docs` that has a feature's name must not be kept.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(
        F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    )

    def count(pattern):
        return F.regexp_count(body, F.lit(pattern)).cast("long")

    kept = docs.columns if keep is None else keep
    parts = docs.select(*kept, body.alias("__body"), words(body).alias("__words"), lines.alias("__lines"))
    body = F.col("__body")
    return parts.select(
        *kept,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines")))
        .cast("long")
        .alias("n_dup_lines"),
        repeated_words(F.col("__words")).alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        count(r"[\p{L}\p{N}]").alias("n_alnum"),
        count(r"\p{Lu}").alias("n_upper"),
        count(r"[!¡]").alias("n_exclaim"),
        F.size(
            F.filter("__words", lambda w, i: w == F.get(F.col("__words"), i + 1))
        ).cast("long").alias("n_stutter"),
        F.size(F.filter("__lines", lambda x: x.rlike(r"[.?!:;。…][\x22')\]”»]*[\x20\x09-\x0D]*\z")))
        .cast("long")
        .alias("n_ends"),
    )


FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_alnum", "n_upper", "n_exclaim", "n_stutter", "n_ends",
)


def votes(rules: Mapping[str, tuple[str, str]] = RULES) -> Column:
    """One digit per rule: 2 good, 0 bad, 1 abstains; in one number."""
    total = F.lit(0)
    for good, bad in rules.values():
        digit = F.when(F.expr(bad), 0).when(F.expr(good), 2).otherwise(1)
        total = total * 3 + digit
    return total


def estimate(counts: Mapping[int, int], n_rules: int, rounds: int = ROUNDS):
    """(log prior odds, [log odds if a rule votes bad, abstains, votes good]).

    Expectation-maximisation over three outcomes per rule and class. Abstaining is
    an outcome, so a rule that can only vote bad is known by how seldom it does on
    good documents. A weak prior names the classes.
    """
    patterns = []
    for code, n in sorted(counts.items()):
        digits = []
        for _ in range(n_rules):
            code, digit = divmod(code, 3)
            digits.append(digit)
        patterns.append((digits[::-1], n))
    n_all = sum(counts.values())
    known = BELIEF * n_all + 1
    prior = math.log(PRIOR / (1 - PRIOR))
    start = tuple(math.log(g / b) for g, b in zip(ON_GOOD, ON_BAD, strict=True))
    weights = [start] * n_rules
    for _ in range(rounds):
        good_total = known * PRIOR
        tally = [
            ([known * p for p in ON_GOOD], [known * p for p in ON_BAD])
            for _ in range(n_rules)
        ]
        for digits, n in patterns:
            odds = prior + sum(w[d] for w, d in zip(weights, digits, strict=True))
            good = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            good_total += n * good
            for (on_good, on_bad), digit in zip(tally, digits, strict=True):
                on_good[digit] += n * good
                on_bad[digit] += n * (1 - good)
        prior = math.log(good_total / (n_all + known - good_total))
        weights = [
            tuple(
                math.log(g / sum(on_good)) - math.log(b / sum(on_bad))
                for g, b in zip(on_good, on_bad, strict=True)
            )
            for on_good, on_bad in tally
        ]
    return prior, weights


def posterior(code: Column, prior: float, weights) -> Column:
    """Probability of "good" of a vote pattern."""
    odds = F.lit(prior)
    for at, (bad, none, good) in enumerate(reversed(weights)):
        digit = F.floor(code / 3**at).cast("int") % 3
        odds = odds + F.when(digit == 0, bad).when(digit == 2, good).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def judged(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep`, the features, `base_failed`, `p_good` and `kept`.

    A NULL text counts as empty and fails the base rules, so does every text of
    under ten words. Equal rows get equal verdicts; an empty table stays empty.
    The estimation reads every document that passes the base rules.
    """
    counted = features(docs, text, keep).withColumn("base_failed", F.expr(BASE_FAILED))
    counted = stored(counted.withColumn("__votes", votes()), "quality")
    seen = counted.filter(~F.col("base_failed")).groupBy("__votes").count().collect()
    prior, weights = estimate(dict(map(tuple, seen)), len(RULES))
    p_good = posterior(F.col("__votes"), prior, weights)
    return (
        counted.withColumn("p_good", F.when(~F.col("base_failed"), p_good).otherwise(0.0))
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= GOOD))
        .drop("__votes")
    )


def good_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents kept, same columns."""
    columns = docs.columns
    whole = docs.select(
        F.col(text).alias("__text"), F.struct(*[F.col(c) for c in columns]).alias("__doc")
    )
    return judged(whole, "__text", ["__doc"]).filter("kept").select("__doc.*")
