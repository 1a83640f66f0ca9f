"""Near-duplicates by fast similarity sketching, banding and exact verification.

A sketch has t coordinates. In rounds, every element of a set is hashed to a
coordinate and a value; a coordinate keeps the least value of the first round that
reaches it. t more rounds each fill one coordinate from all elements, so every
coordinate is filled, and agreement between two sketches is as concentrated around
the similarity as if elements were sampled without replacement.

Documents with equal sets form a class, compared once. Classes that agree in a
whole band share a bucket. In a round, every member of a bucket that spans several
components is verified against one member, the most central one outside the
bucket's largest component, which then leaves the bucket. Rounds end when they link
little.

What is left in buckets that still span several components is compared by its rarest
shingles: two sets that are similar enough share one among the first of each, in the
order of frequency. How many are first follows from both sizes, so sets are keyed by
shingle, class of their own size and class of the other's. Members outside a bucket's
largest component are verified against the members that share such a key and pass the
bound that the places of the shingle set. A pair that is left out is connected already
or proven not to be similar, so no link between components is lost, and no bucket is
expanded into its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossmill.llm.common import digest_key, stored
from glossmill.llm.components import components

BANDS, ROWS = 36, 5  # misses a pair at similarity 0.8 with probability 6e-7
COORDINATES = BANDS * ROWS
STARS = 4  # most rounds in which a bucket's members meet one of them
LITTLE = 20  # a round is the last one if it joins fewer than one component per 20 pairs
CLASS = 1.05  # ratio of the sizes at the ends of a class of sizes
CACHE = 100_000  # word hashes a worker holds at a time
ROW = "struct<r0: long, r1: long>"  # names a row by its content
_U = np.uint64


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_words(text: bytes | None) -> list[bytes]:
    """ASCII-lowered words; bytes.split() splits at exactly the six ASCII blanks."""
    return text.lower().split() if text else []


def shingle_set(words: list[bytes], size: int) -> frozenset:
    """Exact shingles; the whole sequence where there are fewer words."""
    if not words:
        return frozenset()
    if len(words) <= size:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[i:] for i in range(size)]))


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted."""
    if not words:
        return np.empty(0, _U)
    each = np.fromiter(map(_HASHES.__getitem__, words), _U, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, _U)
    for i in range(size):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + each[i : i + n])
    return np.unique(out)


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """A row of `t` values per non-empty set; all rows at once, round by round."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    items = np.concatenate(sets) if sets else np.empty(0, _U)
    empty = np.iinfo(np.uint64).max
    out = np.full(len(sets) * t, empty, _U)
    for at in range(2 * t):
        y = _mix(items + _U((at + 1) * 0xD1B54A32D192ED03 % 2**64))
        if at < t:
            place = (((y >> _U(32)) * _U(t)) >> _U(32)).astype(np.int64)
        else:
            place = at - t
        place = owner * t + place
        value = (_U(at) << _U(54)) | (_mix(y) >> _U(10))
        # Values grow with the round, so filled coordinates stay as they are.
        np.minimum.at(out, place, value)
        open_ = (out.reshape(-1, t) == empty).any(axis=1)
        if not open_.any():
            break
        left = open_[owner]
        owner, items = owner[left], items[left]
    return out.reshape(-1, t)


def _bands(values: np.ndarray) -> np.ndarray:
    parts = values.reshape(len(values), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), parts.shape[:2]).copy()
    for i in range(ROWS):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + parts[:, :, i])
    return out.view(np.int64)


def _sketch_task(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text").cast(pa.large_binary())
            # A few hundred texts at a time: memory follows one text, not a batch.
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = [
                    shingle_hashes(text_words(t.as_py()), size)
                    for t in texts.slice(start, 500)
                ]
                filled = [i for i, s in enumerate(sets) if len(s)]
                bands = _bands(sketches([sets[i] for i in filled]))
                ends = np.zeros(len(sets) + 1, np.int32)
                ends[1:][filled] = BANDS
                digest = np.zeros((len(sets), 2), np.int64)
                for i in filled:
                    code = xxhash.xxh3_128_digest(sets[i].tobytes())
                    digest[i] = np.frombuffer(code, np.int64)
                yield pa.record_batch(
                    {
                        "__key": part.column("__key"),
                        "__row": part.column("__row"),
                        "__n": pa.array([len(s) for s in sets], pa.int64()),
                        "__d0": pa.array(digest[:, 0]),
                        "__d1": pa.array(digest[:, 1]),
                        "__bands": pa.ListArray.from_arrays(
                            pa.array(np.cumsum(ends, dtype=np.int32)),
                            pa.array(bands.reshape(-1)),
                        ),
                    }
                )

    return run


def _verify_task(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, frozenset()
        for batch in batches:
            left = batch.column("text_a").cast(pa.large_binary())
            right = batch.column("text_b").cast(pa.large_binary())
            hits = []
            for i, node in enumerate(batch.column("a").to_pylist()):
                if node != last:
                    last, mine = node, shingle_set(text_words(left[i].as_py()), size)
                other = shingle_set(text_words(right[i].as_py()), size)
                both = len(mine & other)
                hits.append(100 * both >= percent * (len(mine) + len(other) - both))
            yield batch.select(["root_a", "root_b"]).filter(pa.array(hits, pa.bool_()))
            pa.default_memory_pool().release_unused()

    return run


def _shingle_task(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            rest = batch.drop_columns(["text"])
            for start in range(0, batch.num_rows, 500):
                part = texts.slice(start, 500)
                sets = [shingle_hashes(text_words(t.as_py()), size) for t in part]
                which = np.repeat(np.arange(start, start + len(sets)), [len(s) for s in sets])
                tokens = np.concatenate(sets).view(np.int64)
                yield rest.take(pa.array(which)).append_column("token", pa.array(tokens))

    return run


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`key, n_shingles, component_id, kept`, a row per row.

    Documents are linked if 100 * intersection >= percent * union of their sets of
    distinct shingles of `size` words (ASCII letters lowered). `component_id` is the
    smallest key reachable over links; `kept` marks the document that bears it.
    NULL texts and texts without words have the empty set and are linked with
    nothing. Rows that repeat a key are linked by their texts like any others. A
    NULL key never names a component that has another key; such a row is not kept
    unless all its component lacks keys. An empty table gives an empty one.
    """
    slim = docs.select(
        F.col(key).cast("long").alias("__key"),
        F.col(text).alias("__text"),
        F.lit(None).cast(ROW).alias("__row"),
    )
    sketched, rooted = _components(slim, size, percent)
    least = rooted.groupBy("root").agg(F.min("__first").alias("__least"))
    named = rooted.join(least, "root").select("__d0", "__d1", "__least")
    out = sketched.select("__key", "__n", "__d0", "__d1").join(named, ["__d0", "__d1"], "left")
    component = F.when(F.col("__n") > 0, F.col("__least")).otherwise(F.col("__key"))
    return out.select(
        F.col("__key").alias(key),
        F.col("__n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("__key").eqNullSafe(component).alias("kept"),
    )


def _components(slim: DataFrame, size: int, percent: int):
    """The sketched rows, and `__first, __best, root` of each class of equal sets.

    `__best` names the row of the class with the smallest key, NULL keys last, and
    among these the smallest `__row`.
    """
    sketched = stored(
        slim.mapInArrow(
            _sketch_task(size),
            f"__key long, __row {ROW}, __n long, __d0 long, __d1 long, __bands array<long>",
        ),
        "sketches",
    )
    best = F.struct(F.col("__key").isNull().alias("none"), "__key", "__row")
    classes = (
        sketched.filter("__n > 0")
        .groupBy("__d0", "__d1")
        .agg(
            F.min("__key").alias("__first"),
            F.min(best).alias("__best"),
            F.first("__n").alias("__n"),
            F.first("__bands").alias("__bands"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = stored(classes, "classes")
    each = classes.select("node", "__n", F.explode("__bands").alias("band"))
    shared = each.groupBy("band").count().filter("count > 1").select("band")
    members = stored(each.join(shared, "band"), "buckets")

    texts = _texts(slim, classes, members, size)
    live = members.withColumn("root", F.col("node"))
    roots = classes.select("node", F.col("node").alias("root"))
    for _ in range(STARS):
        live, pairs = _star(live, percent)
        live, roots, little = _joined(live, roots, pairs, texts, size, percent)
        if little:
            break
    _, roots, _ = _joined(live, roots, _rest(live, texts, size, percent), texts, size, percent)

    rooted = classes.select("node", "__d0", "__d1", "__first", "__best").join(roots, "node")
    return sketched, rooted


def _mixed(live: DataFrame) -> DataFrame:
    """Members of the buckets that span several components, with the bucket's size."""
    spans = live.groupBy("band").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("among")
    )
    return stored(live.join(spans.filter("lo < hi").select("band", "among"), "band"), "live")


def _largest(live: DataFrame) -> DataFrame:
    """`band, main, units`: the component with most members of each bucket, and their number."""
    counted = live.groupBy("band", "root").agg(F.count("*").alias("units"))
    most = counted.groupBy("band").agg(F.max(F.struct("units", "root")).alias("m"))
    return most.select("band", F.col("m.root").alias("main"), F.col("m.units").alias("units"))


def _pairs(joined: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes whose set sizes allow for a link, and their components.

    From (node, n, root) and (other, m, its); components come in order of their ids.
    """
    sizes = f"100 * least(__n, m) >= {percent} * greatest(__n, m)"
    return joined.filter(sizes).select(
        F.least("node", "other").alias("a"),
        F.greatest("node", "other").alias("b"),
        F.least("root", "its").alias("root_a"),
        F.greatest("root", "its").alias("root_b"),
    )


def _star(live: DataFrame, percent: int):
    """Members of mixed buckets but for one of each, and its pairs with them.

    That one is outside the largest component, where there is one, and has the most
    members beside it in all its buckets: the text of which others are variants.
    """
    live = _mixed(live)
    central = live.groupBy("node").agg(F.sum("among").alias("met"))
    draw = F.struct("met", F.xxhash64("node").alias("h"), "node", "__n", "root")
    heads = (
        live.join(central, "node")
        .join(_largest(live), "band")
        .filter("root <> main or units = 1")
        .groupBy("band")
        .agg(F.max(draw).alias("c"))
    )
    heads = heads.select("band", "c.node", "c.__n", "c.root").toDF("band", "other", "m", "its")
    met = live.join(heads, "band")
    left = met.filter("node <> other").select("band", "node", "__n", "root")
    return left, _pairs(met.filter("root <> its"), percent)


def _size_class(n: Column) -> Column:
    return F.floor(F.log(F.greatest(n, F.lit(1))) / F.log(F.lit(CLASS))).cast("int")


def _rest(live: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs of members of mixed buckets that may be similar, one outside the largest component.

    Sets of n and m shingles are similar if they share at least percent * (n + m) /
    (100 + percent). In one order of all shingles, the rarest first, the first one they
    share has at least that many shingles from it on in both sets.
    """
    live = _mixed(live)
    nodes = (
        live.join(_largest(live), "band")
        .groupBy("node", "__n", "root")
        .agg(F.max(F.col("root") != F.col("main")).alias("outside"))
    )
    columns = "node long, __n long, root long, outside boolean"
    tokens = stored(
        nodes.join(texts, "node")
        .select(*nodes.columns, "text")
        .mapInArrow(_shingle_task(size), f"{columns}, token long"),
        "shingles",
    )
    often = tokens.groupBy("token").count().filter("count > 1")
    mine = W.partitionBy("node")
    rank = F.row_number().over(mine.orderBy("count", "token"))
    # Shingles of no other member come before these.
    place = F.col("__n") - F.count("*").over(mine) + rank - 1
    first = tokens.join(often, "token").withColumn("after", F.col("__n") - place)
    first = first.filter(F.col("after") * 100 >= F.col("__n") * percent).select(
        *nodes.columns, "token", "after", _size_class(F.col("__n")).alias("own")
    )
    least = _size_class(F.floor(F.col("__n") * percent / 100))
    most = _size_class(F.ceil(F.col("__n") * 100 / percent))
    # Not above any size of the class, whatever the rounding.
    bound = F.floor(F.pow(F.lit(CLASS), "theirs") * (1 - 1e-9))
    keys = first.withColumn("theirs", F.explode(F.sequence(least, most))).filter(
        F.col("after") * (100 + percent) >= (F.col("__n") + bound) * percent
    )
    keys = stored(keys, "keys")
    here = keys.filter("outside").drop("outside")
    there = keys.select(
        "token",
        F.col("theirs").alias("own"),
        F.col("own").alias("theirs"),
        F.col("node").alias("other"),
        F.col("__n").alias("m"),
        F.col("root").alias("its"),
        F.col("after").alias("still"),
    )
    met = here.join(there, ["token", "own", "theirs"]).filter(
        f"root <> its and {100 + percent} * least(after, still) >= {percent} * (__n + m)"
    )
    return _pairs(met, percent)


def _joined(live, roots, pairs, texts, size, percent):
    """Verify pairs and join the components of those that pass; whether it joined little."""
    pairs = stored(pairs.distinct(), "pairs")
    merged = components(_verified(pairs, texts, size, percent).toDF("a", "b"))
    merged = stored(merged.toDF("root", "new"), "merged")

    def moved(df):
        new = F.coalesce("new", "root").alias("root")
        return df.join(merged, "root", "left").select(
            *[c for c in df.columns if c != "root"], new
        )

    roots = stored(moved(roots).select("node", "root"), "roots")
    return moved(live), roots, merged.count() * LITTLE <= pairs.count()


def _texts(slim, classes, members, size):
    """`node, text`: one text of every class that shares a bucket."""
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi")
    wanted = wanted.select("node", F.col("__first").alias("__key"), "__n", "__d0", "__d1")
    found = slim.join(wanted, slim["__key"].eqNullSafe(wanted["__key"])).select(
        "node", "__n", "__d0", "__d1", F.col("__text").alias("text")
    )

    # A key may be repeated with another text: keep the text that has the set.
    def same_set(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            d0, d1 = batch.column("__d0").to_pylist(), batch.column("__d1").to_pylist()
            keep = []
            for text, x, y in zip(texts, d0, d1, strict=True):
                code = xxhash.xxh3_128_digest(
                    shingle_hashes(text_words(text.as_py()), size).tobytes()
                )
                keep.append(tuple(np.frombuffer(code, np.int64)) == (x, y))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["node", "text"])

    repeated = found.mapInArrow(same_set, "node long, text string")
    return stored(repeated.dropDuplicates(["node"]), "texts")


def _verified(pairs, texts, size, percent):
    right = texts.toDF("b", "text_b")
    left = texts.toDF("a", "text_a")
    joined = pairs.join(right, "b").join(left, "a")
    return joined.mapInArrow(_verify_task(size, percent), "root_a long, root_b long")


def distinct_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """One row of each component, same columns: that with the smallest key.

    Rows without a key come last; of rows that share the key the smallest digest of
    the whole row decides, and rows equal in all columns are interchangeable. So keys
    may be repeated or missing. Texts without words are linked with nothing: all stay.
    """
    columns = docs.columns
    # The digest is computed from the row wherever it is needed: nothing to be stored.
    named = docs.select(
        F.struct(*[c.alias(f"r{i}") for i, c in enumerate(digest_key(*map(F.col, columns)))]).alias("__row"),
        F.struct(*[F.col(c) for c in columns]).alias("__doc"),
        F.col(key).cast("long").alias("__key"),
        F.col(text).alias("__text"),
    )
    _, rooted = _components(named.select("__key", "__text", "__row"), size, percent)
    kept = rooted.groupBy("root").agg(F.min("__best").alias("b")).select("b.__row")
    once = (
        named.select("__row", "__doc")
        .join(kept, "__row", "left_semi")
        .groupBy("__row")
        .agg(F.first("__doc").alias("__doc"))
        .select("__doc.*")
    )
    wordless = docs.filter(F.col(text).isNull() | ~F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    return once.unionByName(wordless)
