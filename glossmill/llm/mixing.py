"""Mixing sources to target weights by weighted fair queueing.

Every document waits in its source's queue, once per epoch and in an order
shuffled anew for each epoch. Its virtual finish time is what its source has
queued up to and with it, divided by the source's target. All queues are
merged by finish time and cut where the total budget is used up, so that every
source has then got the same share of its target, up to one document.

The running sums need no task that holds a source: a queue is cut into slices
by the leading bits of the shuffling hash, as many as its number of documents
asks for; slice totals are summed first, rows only within their slice. The cut
is found by refining one interval of finish times at a time. What is taken of a
queue is its beginning, so the last place taken of each queue tells a document how
often it is taken, and documents are not shuffled. The table of sources is held by
the driver: the caller gives each one a weight.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossmill.llm.common import stored, word_count

SLICE_ROWS = 2_000  # documents of a queue slice, on average
INTERVALS = 1024  # intervals a range of finish times is cut into at once


def cyclic_weights(pattern: Sequence[float]) -> Callable[[int], float]:
    return lambda at: float(pattern[at % len(pattern)])


def targets(
    sizes: Sequence[int], weights: Sequence[float], share: float, repeats: int
) -> list[float]:
    """Split `share` times all sizes by weight; none above `repeats` its size.

    What a capped source leaves is split again among the rest by weight.
    """
    left, out = share * sum(sizes), [0.0] * len(sizes)
    open_ = [i for i, size in enumerate(sizes) if size > 0]
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total >= repeats * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(repeats * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


#: A row's place in the queue of its source and epoch, in the order of its fields.
PLACE = pa.struct(
    {"slice": pa.int64(), "hash": pa.int64(), "name": pa.string(), "size": pa.int64(), "row": pa.int64()}
)


def _place(epoch: Column, seed: int) -> Column:
    drawn = F.xxhash64(F.lit(seed), epoch, "__at", "__name", "__size")
    # The sign bit is moved so that slices follow the order of the hash.
    moved = drawn.bitwiseXOR(F.expr("shiftleft(1L, 63)"))
    top = F.call_function("shiftrightunsigned", moved, 64 - F.col("__bits"))
    return F.struct(
        F.when(F.col("__bits") == 0, F.lit(0).cast("long")).otherwise(top).alias("slice"),
        drawn.alias("hash"),
        F.col("__name").alias("name"),
        F.col("__size").alias("size"),
        F.col("__row").alias("row"),
    )


def fair_mix(
    docs: DataFrame,
    weights: Callable[[int], float] = cyclic_weights((3, 1, 2)),
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 0,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """`key, size, source_size, target, taken` and the columns `keep`, a row per row.

    `weights` gives the weight of a source by its place in code point order,
    NULL last. `taken` is `size` times the number of times the mix holds the
    document, 0 to `repeats`. NULL and empty texts have size 0 and are taken 0
    times; equal rows are queued one by one; sources without words have target
    0. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ids = F.monotonically_increasing_id().alias("__row")
    rows = stored(
        docs.select(
            ids,
            F.col(key).alias("__key"),
            F.col(source).alias("__source"),
            word_count(F.col(text)).alias("__size"),
            *[F.col(c) for c in keep],
        ),
        "mix-rows",
    )
    found = rows.groupBy("__source").agg(F.count("*"), F.sum("__size")).collect()
    found.sort(key=lambda r: (r[0] is None, (r[0] or "").encode()))
    goal = targets(
        [r[2] for r in found], [weights(i) for i in range(len(found))], share, repeats
    )
    sources = [
        {
            "__source": r[0],
            "__at": i,
            "source_size": r[2],
            "target": goal[i],
            "__bits": max(0, (r[1] // SLICE_ROWS).bit_length()),
        }
        for i, r in enumerate(found)
    ]
    columns = {
        "__source": pa.string(),
        "__at": pa.int32(),
        "source_size": pa.int64(),
        "target": pa.float64(),
        "__bits": pa.int32(),
    }

    def named(table, columns):
        # By Arrow: no Python worker is started for it.
        table = spark.createDataFrame(pa.Table.from_pylist(table, pa.schema(columns)))
        # Never by a shuffle of the documents.
        both = rows.join(F.broadcast(table), rows["__source"].eqNullSafe(table["__source"]))
        return both.drop(table["__source"]).withColumn("__name", F.col("__key").cast("string"))

    queue = named(sources, columns).filter("__size > 0").select(
        "__row",
        "__at",
        "__size",
        "target",
        "__bits",
        "__name",
        F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("__epoch"),
    )
    queue = queue.withColumn("__place", _place(F.col("__epoch"), seed))
    queue = queue.withColumn("__slice", F.col("__place.slice"))
    slices = ["__at", "__epoch", "__slice"]
    totals = queue.groupBy(*slices).agg(F.sum("__size").alias("__total"))
    earlier = W.partitionBy("__at").orderBy("__epoch", "__slice")
    totals = totals.select(
        *slices,
        (F.sum("__total").over(earlier) - F.col("__total")).alias("__before"),
    )
    inside = W.partitionBy(*slices).orderBy("__place")
    served = F.col("__before") + F.sum("__size").over(
        inside.rowsBetween(W.unboundedPreceding, 0)
    )
    timed = stored(
        queue.join(totals, slices).select(
            "__row", "__at", "__epoch", "__size", "__place", (served / F.col("target")).alias("__end")
        ),
        "mix-times",
    )
    taken = _until(timed, sum(goal))
    ends = taken.groupBy("__at", "__epoch").agg(F.max("__place")).collect()
    last = {(at, epoch): place.asDict() for at, epoch, place in ends}
    for r in sources:
        r["__last"] = [last.get((r["__at"], epoch)) for epoch in range(repeats)]
    out = named(sources, columns | {"__last": pa.list_(PLACE)})
    times = F.lit(0)
    for epoch in range(repeats):
        within = _place(F.lit(epoch), seed) <= F.get("__last", F.lit(epoch))
        times = times + F.when(within, 1).otherwise(0)
    out = out.withColumn("__taken", F.col("__size") * times)
    return out.select(
        F.col("__key").alias(key),
        F.col("__size").alias("size"),
        "source_size",
        "target",
        F.col("__taken").cast("long").alias("taken"),
        *keep,
    )


def _until(timed: DataFrame, budget: float) -> DataFrame:
    """Rows in order of finish time whose running size stays within the budget."""
    low, used = 0.0, 0
    high = timed.agg(F.max("__end")).first()[0]
    if high is None:
        return timed.limit(0)
    high = high * (1 + 1e-9) + 1e-300
    while True:
        at = F.floor((F.col("__end") - low) / ((high - low) / INTERVALS))
        within = timed.filter((F.col("__end") >= low) & (F.col("__end") < high))
        parts = (
            within.groupBy(at.alias("__part"))
            .agg(F.sum("__size"), F.count("*"), F.min("__end"), F.max("__end"))
            .collect()
        )
        cut = None
        for _, size, n, first, last in sorted(parts):
            if used + size > budget:
                cut = (n, first, last)
                break
            used += size
        if cut is None:
            return timed
        n, first, last = cut
        if n <= SLICE_ROWS or first == last:
            break
        low, high = first, last * (1 + 1e-12) + 1e-300
    # At most SLICE_ROWS rows, or one row of each source: ordered in one task.
    edge = timed.filter((F.col("__end") >= first) & (F.col("__end") <= last))
    running = F.sum("__size").over(
        W.orderBy("__end", "__at", "__epoch", "__row").rowsBetween(
            W.unboundedPreceding, 0
        )
    )
    fits = edge.withColumn("__run", running).filter(F.col("__run") <= budget - used)
    return timed.filter(F.col("__end") < first).unionByName(fits.drop("__run"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, same columns."""
    columns = docs.columns
    plan = fair_mix(
        docs.withColumn("__doc", F.struct(*[F.col(c) for c in columns])),
        keep=["__doc"],
        **options,
    ).filter("taken > 0")
    copies = F.expr("explode(sequence(1, cast(taken / size as int)))")
    return plan.select("__doc", copies).select("__doc.*")
