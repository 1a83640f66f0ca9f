"""Exact top-k by inner product over a bit-sliced index.

Rows are dealt into blocks. A block keeps, for every attribute (vector component)
and each of its leading bits, a bitmap over its rows. A query's score is added up
from bitmaps alone: bits of one weight are summed by carry-save adders into the
slices of the score, for all rows of the block at once. From the most significant
slice downward the k-th largest value is found by counting. The bits that were
left out of the slices bound the error, so rows that can still be among the best
k are few; their exact scores come from the stored integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossmill.llm.common import stored

BLOCK_ROWS = 32_768  # rows of a block, on average: long bitmaps cost fewer calls
BLOCK_VALUES = 1 << 22  # components of a block; long vectors have fewer rows
BATCH_QUERIES = 128  # queries that reach a task together, on average
HELD_BYTES = 64_000_000  # of blocks that a task holds
TASKS_PER_CORE = 2  # that share the blocks, where there are as many
DROPPED = 3  # low bits of an attribute that are not sliced
_U = np.uint64
_INDEX = (
    "block long, rows long, dims long, ids binary, vals binary, low binary, "
    "depth binary, slices binary"
)


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """`__key, __v`: floor(scale * component); rows without whole vectors go."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.col(key).isNotNull() & F.col(vector).isNotNull() & finite
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return vectors.filter(whole).select(
        F.col(key).cast("long").alias("__key"), values.cast("array<long>").alias("__v")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column; shorter ones are filled up with 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    dims = int(sizes.max(initial=0))
    if (np.abs(flat) >= 1 << 24).any():
        raise ValueError("a component is too large for exact scores")
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _pack(bits: np.ndarray) -> np.ndarray:
    """Bitmaps (last axis: 64-bit words) of booleans (last axis: rows)."""
    words = -(-bits.shape[-1] // 64)
    padded = np.zeros((*bits.shape[:-1], words * 64), bool)
    padded[..., : bits.shape[-1]] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view(_U)


def _rows_of(bitmap: np.ndarray, rows: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:rows])


def build_block(table: pa.Table) -> pa.Table:
    """The row of the index for the rows of one block."""
    ids = table.column("__key").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    vals = _matrix(table.column("__v").combine_chunks())[order]
    low = vals.min(axis=0, initial=0)
    above = (vals - low) >> DROPPED
    depth = np.array([int(m).bit_length() for m in above.max(axis=0, initial=0)], np.int64)
    slices = [_pack((above[:, d] >> b) & 1 > 0) for d in range(len(depth)) for b in range(depth[d])]
    row = {
        "block": table.column("block")[0].as_py(),
        "rows": len(ids),
        "dims": vals.shape[1],
        "ids": ids.tobytes(),
        "vals": vals.astype("<i4").tobytes(),
        "low": low.tobytes(),
        "depth": depth.tobytes(),
        "slices": b"".join(s.tobytes() for s in slices),
    }
    return pa.table({k: [v] for k, v in row.items()})


class _Block:
    def __init__(self, rows, dims, ids, vals, low, depth, slices):
        self.rows, self.words = rows, -(-rows // 64)
        self.ids = np.frombuffer(ids, np.int64)
        self.vals = np.frombuffer(vals, "<i4").reshape(rows, dims)
        self.low = np.frombuffer(low, np.int64)
        self.depth = np.frombuffer(depth, np.int64)
        self.first = np.cumsum(self.depth) - self.depth
        self.slices = np.frombuffer(slices, _U).reshape(-1, self.words)
        self.every = _pack(np.ones(rows, bool))

    def summed(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, least significant first, of the sum of |q| * attribute.

        Where q is negative the attribute is taken from its largest value down.
        """
        by_weight: dict[int, list[tuple[int, bool]]] = {}
        for d in np.flatnonzero(query):
            weight = abs(int(query[d]))
            for shift in range(weight.bit_length()):
                if weight >> shift & 1:
                    for b in range(self.depth[d]):
                        by_weight.setdefault(shift + b, []).append((self.first[d] + b, query[d] < 0))
        out, carried, at = [], np.empty((0, self.words), _U), 0
        while by_weight or len(carried):
            own = by_weight.pop(at, [])
            if own:
                index = np.array([i for i, _ in own])
                turned = np.array([t for _, t in own])
                maps = self.slices[index]
                maps[turned] ^= self.every
                maps = np.concatenate([maps, carried])
            else:
                maps = carried
            carries = []
            while len(maps) > 1:
                if len(maps) == 2:
                    carries.append(maps[:1] & maps[1:])
                    maps = maps[:1] ^ maps[1:]
                    continue
                third = len(maps) // 3
                a, b, c = maps[:third], maps[third : 2 * third], maps[2 * third : 3 * third]
                half = a ^ b
                carries.append((a & b) | (half & c))
                maps = np.concatenate([half ^ c, maps[3 * third :]])
            out.append(maps[0] if len(maps) else np.zeros(self.words, _U))
            carried = np.concatenate(carries) if carries else np.empty((0, self.words), _U)
            at += 1
        return out

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows; ties to smaller ids; not the query's own."""
        fits = min(len(query), self.vals.shape[1])
        q = np.zeros(self.vals.shape[1], np.int64)
        q[:fits] = query[:fits]
        allowed = self.every
        mine = np.arange(*np.searchsorted(self.ids, [own, own + 1]))
        if len(mine):
            off = np.zeros(self.rows, bool)
            off[mine] = True
            allowed = allowed & ~_pack(off)
        if self.rows - len(mine) <= k:
            rows = _rows_of(allowed, self.rows)
        else:
            slices = self.summed(q)
            kth = self._kth(slices, allowed, k)
            # What an attribute's dropped bits can add.
            error = int(np.abs(q).sum()) * (2**DROPPED - 1) >> DROPPED
            rows = _rows_of(self._at_least(slices, allowed, kth - error - 1), self.rows)
        scores = self.vals[rows].astype(np.int64) @ q
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[order]], scores[order]

    @staticmethod
    def _kth(slices, allowed, k) -> int:
        """The k-th largest sum among the allowed rows, bit by bit from the top."""
        value, inside = 0, allowed
        for at in reversed(range(len(slices))):
            ones = inside & slices[at]
            n = int(np.bitwise_count(ones).sum())
            if n >= k:
                value, inside = value | 1 << at, ones
            else:
                k, inside = k - n, inside & ~slices[at]
        return value

    @staticmethod
    def _at_least(slices, allowed, value) -> np.ndarray:
        if value <= 0:
            return allowed
        above, equal = np.zeros_like(allowed), allowed
        for at in reversed(range(len(slices))):
            if value >> at & 1:
                equal = equal & slices[at]
            else:
                above = above | (equal & slices[at])
                equal = equal & ~slices[at]
        return above | equal


def _search_task(k: int):
    """The blocks of a task, which come first, then the batches of queries one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("rows", "dims", "ids", "vals", "low", "depth", "slices")
        blocks: list[_Block] = []
        for batch in batches:
            for at in range(batch.num_rows):
                queries = batch.column("queries")[at].values
                if queries is None:
                    blocks.append(_Block(*(batch.column(f)[at].as_py() for f in fields)))
                    continue
                if not blocks:
                    continue
                owns = queries.field("__key").to_pylist()
                tags = queries.field("tag").to_pylist()
                out: dict[str, list] = {"query_id": [], "tag": [], "vec_id": [], "score": []}
                for own, tag, vector in zip(owns, tags, queries.field("__v"), strict=True):
                    query = vector.values.to_numpy()
                    found = [block.best(own, query, k) for block in blocks]
                    ids, scores = (np.concatenate(x) for x in zip(*found))
                    best = np.lexsort((ids, -scores))[:k]
                    out["query_id"] += [own] * len(best)
                    out["tag"] += [tag] * len(best)
                    out["vec_id"] += ids[best].tolist()
                    out["score"] += scores[best].tolist()
                yield pa.record_batch({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


def build_index(vectors: DataFrame) -> DataFrame:
    """Blocks of the rows of `quantised`, written to the shared folder."""
    rows, dims = vectors.agg(F.count(F.lit(1)), F.max(F.size("__v"))).first()
    blocks = -(-rows // min(BLOCK_ROWS, max(1, BLOCK_VALUES // (dims or 1)))) or 1
    dealt = vectors.withColumn(
        "block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    )
    index = dealt.groupBy("block").applyInArrow(build_block, _INDEX)
    return stored(index, "slices")


def _tasks(index: DataFrame, batches: int) -> tuple[int, int]:
    """Parts of the blocks and of the batches of queries; a task has one of each.

    None holds over HELD_BYTES of blocks (or one block). The batches are parted only
    where the blocks alone are too few to keep the cores busy.
    """
    held = F.octet_length("ids") + F.octet_length("vals") + F.octet_length("slices")
    blocks, most = index.agg(F.count(F.lit(1)), F.max(held)).first()
    busy = TASKS_PER_CORE * index.sparkSession.sparkContext.defaultParallelism
    least = -(-blocks // max(1, HELD_BYTES // (most or 1)))
    parts = max(1, min(blocks, max(busy, least)))
    return parts, min(batches, -(-busy // parts))


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k best rows of the index for each query.

    Queries are rows as `quantised` gives them. A task holds some blocks, and batches
    of queries pass by; no block meets a batch in a shuffle and nothing is broadcast.
    It hands on k rows per query. Equal queries are answered once, queries that share
    an id but not the vector each for itself.
    """
    asked = queries.dropDuplicates().withColumn("tag", F.xxhash64("__key", "__v"))
    batches = -(-asked.count() // BATCH_QUERIES) or 1
    parts, shares = _tasks(index, batches)
    batch = F.pmod("tag", F.lit(batches)).cast("int").alias("batch")
    asked = asked.groupBy(batch).agg(F.collect_list(F.struct("__key", "tag", "__v")).alias("queries"))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # Blocks are numbered from 0 with hardly a gap.
    held = index.withColumn("part", F.pmod("block", F.lit(parts)).cast("int")).withColumn("share", every(shares))
    passing = asked.select(F.pmod("batch", F.lit(shares)).alias("share"), "queries", every(parts).alias("part"))
    found = (
        held.unionByName(passing, allowMissingColumns=True)
        .repartitionById(parts * shares, F.col("part") * shares + F.col("share"))
        .sortWithinPartitions(F.col("queries").isNotNull())
        .mapInArrow(_search_task(k), "query_id long, tag long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """For each row whose id is divisible by `every`: its k best other rows.

    Components become floor(scale * x); the score is the integer inner product, ties
    go to the smaller id, fewer than k rows give all. Rows without an id, with a NULL
    vector or with a component that is NULL or not finite take no part. Shorter
    vectors count as filled up with 0. Rows that repeat an id are candidates each,
    but never for their own id. An empty table gives an empty result.
    """
    rows = quantised(vectors, key, vector, scale)
    return search(build_index(rows), rows.filter(F.col("__key") % every == 0), k)
