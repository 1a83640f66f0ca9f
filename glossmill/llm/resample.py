"""Importance resampling towards a target distribution of hashed n-gram features.

Each document's features (runs of `n_min` to `n_max` words) fall into `BUCKETS`
buckets by the unsigned CRC-32 of their UTF-8 bytes. Bucket totals over the raw
corpus and over the target texts give each bucket a log-ratio gain; a document's
weight is the floored mean gain of its features, and documents are drawn without
replacement by the Gumbel-top-k trick with a keyed hash in place of a random number.

Head-tail vocabulary: the most frequent features of the corpus (at most
`head_size` of them, each of at most `HEAD_BYTES` bytes, so the broadcast has a
proven size bound) are counted exactly once and their buckets computed once per
distinct feature; they reach every task as a broadcast table. All other features,
the tail, take the CRC directly in the JVM. Both feed the same exact bucket totals.

Defined cases: a NULL or empty text has no features (weight 0); a NULL doc_id gets
a NULL score and is drawn after every document with a score; repeated rows are
separate documents; extra input columns but the text are carried through (the text
is not moved through the sort) unless their names clash with an output column, in
which case the output column replaces them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import stored

# Fixed values of the contract.
BUCKETS = 10_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SEED_TEXT = "2024:"

HEAD_BYTES = 64
OUTPUT = ["n_features", "weight", "score", "rank"]


def features(text: Column, n_min: int = 1, n_max: int = 1) -> Column:
    """All runs of n_min..n_max consecutive words joined by one space, repeats kept."""
    lowered = F.translate(text, UPPER, LOWER)
    words = F.coalesce(F.filter(F.split(lowered, SEPARATORS), lambda w: w != ""), F.array().cast("array<string>"))
    grams = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            grams.append(words)
            continue
        runs = F.transform(
            F.sequence(F.lit(0), F.size(words) - n),
            lambda i: F.array_join(F.slice(words, i + 1, n), " "),
        )
        grams.append(F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<string>")))
    return grams[0] if len(grams) == 1 else F.concat(*grams)


def bucket(feature: Column) -> Column:
    return F.pmod(F.crc32(feature.cast("binary")), F.lit(BUCKETS))


def _head(corpus_features: DataFrame, head_size: int) -> DataFrame:
    """The `head_size` most frequent short features with their buckets (ties: smaller feature)."""
    counted = (
        corpus_features.where(F.octet_length("feature") <= HEAD_BYTES)
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    top = counted.orderBy(F.desc("n"), "feature").limit(head_size)
    return top.select("feature", bucket(F.col("feature")).alias("head_bucket"))


def bucket_totals(feats: DataFrame, head: DataFrame, name: str) -> DataFrame:
    """Per bucket, the number of features of `feats` (column `feature`) that fall in it."""
    joined = feats.join(F.broadcast(head), "feature", "left")
    b = F.coalesce(F.col("head_bucket"), bucket(F.col("feature")))
    return joined.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias(name))


def gains(docs: DataFrame, target: DataFrame, n_min=1, n_max=1, head_size=50_000) -> list[int]:
    """Gain of every bucket, floor(1000 ln((t+1)(S+B)/((s+1)(T+B)))); BUCKETS numbers."""
    doc_feats = docs.select(F.explode(features(F.col("text"), n_min, n_max)).alias("feature"))
    tgt_feats = target.select(F.explode(features(F.col("text"), n_min, n_max)).alias("feature"))
    head = stored(_head(doc_feats, head_size), "resample-head")
    s = bucket_totals(doc_feats, head, "s")
    t = bucket_totals(tgt_feats, head, "t")
    spark = docs.sparkSession
    table = (
        spark.range(BUCKETS).withColumnRenamed("id", "bucket")
        .join(F.broadcast(s), "bucket", "left").join(F.broadcast(t), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    )
    rows = {r.bucket: (r.s, r.t) for r in table.collect()}  # BUCKETS rows: a proven bound
    S = sum(v[0] for v in rows.values())
    T = sum(v[1] for v in rows.values())
    out = []
    for b in range(BUCKETS):
        sb, tb = rows.get(b, (0, 0))
        ratio = (float(tb) + 1.0) * (float(S) + BUCKETS) / ((float(sb) + 1.0) * (float(T) + BUCKETS))
        out.append(int(math.floor(1000.0 * math.log(ratio))))
    return out


def gumbel_key(doc_id: Column) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))), h the first 32 bits of sha256('2024:<id>')."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(SEED_TEXT), doc_id.cast("string")), 256), 1, 8), 16, 10)
    u = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("double")


def weighted(docs: DataFrame, gain: list[int], n_min=1, n_max=1) -> DataFrame:
    """docs with n_features and weight (floored mean gain; none: 0), all in the row."""
    table = F.array(*[F.lit(g) for g in gain])
    feats = features(F.col("text"), n_min, n_max)
    total = F.aggregate(
        F.transform(feats, lambda f: F.element_at(table, (bucket(f) + 1).cast("int")).cast("long")),
        F.lit(0).cast("long"),
        lambda acc, g: acc + g,
    )
    n = F.size(feats).cast("long")
    weight = F.when(n == 0, F.lit(0)).otherwise(F.floor(total.cast("double") / n.cast("double"))).cast("long")
    extra = [c for c in docs.columns if c not in OUTPUT and c not in ("_words", "text")]
    words = F.size(F.filter(F.split(F.translate(F.col("text"), UPPER, LOWER), SEPARATORS), lambda w: w != ""))
    return docs.select(*extra, n.alias("n_features"), weight.alias("weight"), F.coalesce(words, F.lit(0)).alias("_words"))


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with `name` = 1, 2, 3 ... in `order`, without moving all rows to one task.

    Rows are range-partitioned and sorted; each partition's size, one row per
    partition, gives its offset. A random last key spreads rows whose order keys
    are all equal over several partitions.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.rand(7)]
    numbered = (
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    numbered = stored(numbered, "ranked")
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = {r._part: r for r in sizes.collect()}  # one row per partition
    running, starts = 0, []
    for part in sorted(offsets):
        starts.append((part, running, offsets[part]._first))
        running += offsets[part]._n
    start_df = spark.createDataFrame(starts or [(0, 0, 0)], "_part int, _off long, _first long")
    return (
        numbered.join(F.broadcast(start_df), "_part")
        .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first") + 1)
        .drop("_part", "_mid", "_off", "_first")
    )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    fraction_percent: int = 10,
    min_words: int = 20,
    n_min: int = 1,
    n_max: int = 1,
    head_size: int = 50_000,
) -> DataFrame:
    """Every document with n_features, weight, score and rank (drawn: 1, 2, ...; else NULL).

    Of the N documents of at least `min_words` words, floor(fraction_percent * N / 100)
    with the highest score are drawn, ties to the smaller doc_id.
    """
    gain = gains(docs, target, n_min, n_max, head_size)
    w = weighted(docs, gain, n_min, n_max)
    w = w.withColumn("score", F.col("weight").cast("double") + gumbel_key(F.col("doc_id")))
    eligible = F.col("_words") >= min_words
    w = stored(w, "resample-weights")
    n_eligible = w.where(eligible).count()
    draw = fraction_percent * n_eligible // 100
    ranked = global_rank(
        w.withColumn("_elig", eligible),
        [F.col("_elig").desc(), F.col("score").desc_nulls_last(), F.col("doc_id").asc_nulls_last()],
        "_pos",
    )
    rank = F.when(F.col("_elig") & (F.col("_pos") <= draw), F.col("_pos")).cast("long")
    return ranked.withColumn("rank", rank).drop("_pos", "_elig", "_words")
