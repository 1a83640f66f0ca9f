"""Toxicity of documents: boosted trees over dense features, calibrated.

A lexicon of words and word beginnings is learnt from labelled documents; each
document then becomes a dozen densities: lexicon hits, hits near a second person,
capitals, punctuation, obfuscated spellings. Gradient-boosted trees fit them, and
isotonic regression turns their margin into a probability. Lexicon, trees and
calibration learn from different labelled documents, so none sees its own fit.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import stored

TRAIN_ROWS = 40_000  # labelled documents that are learnt from, about; the bound
FOLDS = 5
HELD_OUT, LEXICON_FOLDS, TREE_FOLDS, SCALE_FOLDS = 0, (1, 2), (3,), (4,)
LEXICON = 1000  # words and beginnings of the lexicon, at most
LEAST_DOCS = 3  # toxic documents that must hold one
LEAST_ODDS = 2.0  # and the log odds it must have
BEGINNINGS = range(4, 9)  # letters of a beginning
NEAR = 4  # words between a hit and a second person
CACHE = 200_000

# Pronouns of the second person in the corpus's languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta "
    "tes vous votre vos tú ti tuyo tuya usted ustedes vosotros".split()
)
#: Signs that stand for letters inside a word.
LEET = str.maketrans("013457@$!|+", "oieastasiit")

FEATURES = (
    "hits", "hit_weight", "hit_count", "hit_kinds", "heaviest", "near_you", "you",
    "capitals", "shouted", "exclaim", "question", "marks", "obfuscated", "hidden_hits",
    "stretched", "n_words",
)
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_STRETCHED = re.compile(r"([^\W\d])\1\1")


def fold_of(key: str) -> str:
    return f"cast(crc32(cast(cast({key} as string) as binary)) % {FOLDS} as int)"


def _plain(token: str) -> str:
    return _EDGES.sub("", token).lower()


def _pieces(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) >= n)]


def _lexicon_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word or beginning the toxic and all documents of a part that hold it."""
    toxic: Counter = Counter()
    every: Counter = Counter()

    def handed():
        out = pa.record_batch(
            {
                "piece": pa.array(list(every), pa.string()),
                "toxic": pa.array([toxic[p] for p in every], pa.int64()),
                "docs": pa.array(list(every.values()), pa.int64()),
            }
        )
        toxic.clear()
        every.clear()
        return out

    for batch in batches:
        for text, label in zip(batch.column("__text"), batch.column("__label"), strict=True):
            words = {_plain(w) for w in (text.as_py() or "").split()}
            found = {p for w in words if len(w) > 1 for p in _pieces(w)}
            every.update(found)
            if label.as_py():
                toxic.update(found)
            if len(every) > 500_000:
                yield handed()
    yield handed()


def learn_lexicon(train: DataFrame) -> dict[str, float]:
    """Piece -> log odds: at most LEXICON, those that tell most apart."""
    counts = train.groupBy("__label").count().collect()
    totals = {int(r[0]): r[1] for r in counts}
    if len(totals) < 2:
        return {}
    found = train.mapInArrow(_lexicon_task, "piece string, toxic long, docs long")
    summed = found.groupBy("piece").agg(F.sum("toxic").alias("t"), F.sum("docs").alias("n"))
    on_toxic = (F.col("t") + 0.5) / (totals[1] + 1)
    on_clean = (F.col("n") - F.col("t") + 0.5) / (totals[0] + 1)
    odds = F.log(on_toxic / on_clean)
    best = (
        summed.filter(F.col("t") >= LEAST_DOCS)
        .withColumn("odds", odds)
        .filter(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc(F.col("odds") * F.col("t")), "piece")
        .limit(LEXICON)
    )
    return {r["piece"]: r["odds"] for r in best.collect()}


class _Tokens(dict):
    """Token -> place of its row in the table of token properties."""

    def __init__(self, lexicon):
        self.lexicon, self.rows = lexicon, []

    def __missing__(self, token):
        plain = _plain(token)
        weight, kind = self._weight(plain)
        hidden = 0.0
        core = _EDGES.sub("", token) or token
        mixed = any(c.isalpha() for c in core) and not core.isalpha() and "'" not in core
        if not weight and (mixed or _STRETCHED.search(core)):
            clear = _STRETCHED.sub(r"\1", re.sub(r"[\W_]", "", core.lower().translate(LEET)))
            hidden = self._weight(clear)[0]
        letters = sum(c.isalpha() for c in token)
        upper = sum(c.isupper() for c in token)
        row = (
            weight, float(kind), float(plain in SECOND_PERSON), letters, upper,
            float(letters > 2 and letters == upper), float(mixed), hidden,
            float(bool(_STRETCHED.search(core))),
        )
        self.rows.append(row)
        self[token] = at = len(self.rows) - 1
        return at

    def _weight(self, word):
        best, kind = 0.0, -1
        for piece in _pieces(word):
            weight = self.lexicon.get(piece)
            if weight and weight > best:
                best, kind = weight, hash(piece) % 1024
        return best, kind


def _features(text: str, tokens: _Tokens) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    at = np.fromiter(map(tokens.__getitem__, words), np.int64, n)
    # Kinds of tokens of this text and how often each is found.
    kinds, counts = np.unique(at, return_counts=True)
    rows = np.array([tokens.rows[i] for i in kinds])
    weight, kind, second, letters, upper, shouted, mixed, hidden, stretched = rows.T
    hit = weight > 0
    hits = float(counts[hit].sum())
    near = 0.0
    if hit.any() and second.any():
        hit_at = np.flatnonzero(np.isin(at, kinds[hit]))
        you_at = np.flatnonzero(np.isin(at, kinds[second > 0]))
        next_you = np.searchsorted(you_at, hit_at)
        after = you_at[np.minimum(next_you, len(you_at) - 1)] - hit_at
        before = hit_at - you_at[np.maximum(next_you - 1, 0)]
        near = float(((np.abs(after) <= NEAR) | (np.abs(before) <= NEAR)).sum())
    n_letters = max(1.0, float((letters * counts).sum()))
    size = max(1, len(text))
    return [
        hits / n,
        float((weight * counts).sum()) / n,
        math.log1p(hits),
        float(len(np.unique(kind[hit]))),
        float(weight.max()),
        near / n,
        float((second * counts).sum()) / n,
        float((upper * counts).sum()) / n_letters,
        float((shouted * counts).sum()) / n,
        text.count("!") / size,
        text.count("?") / size,
        sum(text.count(c) for c in "*#$%&@") / size,
        float((mixed * counts).sum()) / n,
        float(((hidden > 0) * counts).sum()) / n,
        float((stretched * counts).sum()) / n,
        math.log1p(n),
    ]


def _feature_task(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens(lexicon)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = []
                for text in part.column("__text"):
                    rows.append(_features(text.as_py() or "", tokens))
                    if len(tokens) > CACHE:
                        tokens = _Tokens(lexicon)
                columns = {c: part.column(c) for c in part.schema.names if c != "__text"}
                values = np.array(rows).T
                yield pa.record_batch(
                    columns | {f"__{f}": pa.array(v) for f, v in zip(FEATURES, values, strict=True)}
                )

    return run


def features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """`docs` with one double per feature in place of `__text`."""
    kept = ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "__text")
    values = ", ".join(f"__{f} double" for f in FEATURES)
    return docs.mapInArrow(_feature_task(lexicon), f"{kept}, {values}")


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """`__key, __text, __label, __fold` of labelled documents outside the held-out fold.

    Where there are more than `rows`, a hash of the key draws about as many. NULL
    labels are left out; of several labels of a document the largest counts.
    """
    known = (
        labels.select(F.col("doc_id").alias("__key"), F.col("toxic").alias("__label"))
        .filter(F.col("__label").isNotNull() & F.col("__key").isNotNull())
        .groupBy("__key")
        .agg(F.max("__label").alias("__label"))
        .withColumn("__fold", F.expr(fold_of("__key")))
        .filter(F.col("__fold") != HELD_OUT)
    )
    share = min(1.0, rows / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("__key"), F.lit(1_000_000)) < int(share * 1_000_000))
    # At most about `rows` rows of a few numbers.
    return docs.join(F.broadcast(drawn), "__key")


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, held_out, score, predicted`, a row per row of `docs`.

    Only labels of documents outside fold 0 of crc32(key) are read, at most about
    TRAIN_ROWS of them. NULL and empty texts are scored like any text, with all
    features 0. A NULL key is never held out and never learnt from. Where the
    labels show one class only, or none, every score is the smoothed share of
    toxic labels. Rows may repeat; an empty table gives an empty one.
    """
    slim = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    train = stored(training_rows(slim, labels), "labelled")
    folds = {
        name: train.filter(F.col("__fold").isin(*which))
        for name, which in (("lexicon", LEXICON_FOLDS), ("trees", TREE_FOLDS), ("scale", SCALE_FOLDS))
    }
    lexicon = learn_lexicon(folds["lexicon"].select("__text", "__label"))
    assemble = VectorAssembler(inputCols=[f"__{f}" for f in FEATURES], outputCol="__features")

    def vectors(df):
        return assemble.transform(features(df, lexicon))

    def classes(df):
        return {int(r[0]) for r in df.select("__label").distinct().collect()}

    held_out = F.coalesce(F.expr(fold_of("__key")) == HELD_OUT, F.lit(False))
    if classes(folds["trees"]) < {0, 1} or not classes(folds["scale"]):
        n, toxic = train.agg(F.count("*"), F.coalesce(F.sum("__label"), F.lit(0))).first()
        scored = slim.withColumn("__score", F.lit((toxic + 0.5) / (n + 1)))
    else:
        fit = stored(
            features(folds["trees"].select("__text", F.col("__label").cast("double")), lexicon),
            "fit",
        )
        trees = GBTClassifier(
            featuresCol="__features", labelCol="__label", maxIter=20, maxDepth=3,
            stepSize=0.2, minInstancesPerNode=5, seed=7,
        ).fit(assemble.transform(fit))
        margin = vector_to_array("rawPrediction")[1].alias("__margin")

        def margins(df, *keep):
            return trees.transform(vectors(df)).select(*keep, margin)

        scale_rows = margins(
            folds["scale"].select("__text", F.col("__label").cast("double")), "__label"
        )
        scale = IsotonicRegression(
            featuresCol="__margin", labelCol="__label", predictionCol="__score"
        ).fit(stored(scale_rows, "margins"))
        scored = scale.transform(margins(slim, "__key"))
    value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__score")))
    return scored.select(
        F.col("__key").alias(key),
        held_out.alias("held_out"),
        value.alias("score"),
        (value >= 0.5).cast("int").alias("predicted"),
    )
