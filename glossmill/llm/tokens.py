"""Texts to token files and back.

Documents are range-partitioned by id; a task encodes its range in order and rolls
a file whenever enough ids are gathered. What a range holds becomes known only
then, so the place of a file's first id among all ids is set at commit, from the
manifest: one row per file.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.llm import packing, shards
from glossmill.llm.arrays import gather, text_bytes, text_chunks

FILE_IDS = 4_000_000  # ids of a file, up to one document more
CACHE = 1_000_000  # short chunks whose ids a worker remembers (about 200 MB)
CHUNK = 4 << 20  # bytes of the texts that a task encodes together
_BATCH = 2048  # chunks encoded at once
_IS_BLANK = np.isin(np.arange(256), list(b"\t\n\v\f\r "))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


@functools.lru_cache(maxsize=1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # Strings of special tokens are ordinary text where a text holds them.
    tokenizer.encode_special_tokens = True
    return tokenizer, {}


def _chunks(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Chunks between ASCII blanks, in lower case: places among the distinct ones, these,
    and how many chunks the texts up to each have."""
    data, ends = text_bytes(texts)
    filled = ~_IS_BLANK[data]
    cut = np.zeros(len(data) + 1, bool)  # before this byte
    cut[ends] = True
    cut[1:] |= ~np.append(filled, False)[:-1] if len(data) else False
    starts = np.flatnonzero(filled & cut[:-1])
    cut[:] = False
    cut[ends] = True
    cut[:-1] |= ~filled
    stops = np.flatnonzero(filled & cut[1:]) + 1
    offsets = np.append(0, np.cumsum(stops - starts)).astype("<i4")
    # The tokenizer lowers all letters; ASCII ones may be lowered before.
    lowered = _LOWER[data[filled]]
    each = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(lowered)])
    each = each.dictionary_encode()
    return each.indices.to_numpy(), each.dictionary, np.searchsorted(starts, ends)


def _encoded(tokenizer, chunks: list[bytes]) -> list[bytes]:
    """Ids of each chunk (little-endian 32 bits), all chunks in one call.

    A mark that no chunk holds stands between them; should its id come up elsewhere
    too, each chunk is encoded by itself.
    """
    texts = [c.decode() for c in chunks]
    mark = tokenizer.encode("~", add_special_tokens=False).ids
    if len(mark) == 1 and not any("~" in t for t in texts):
        (coded,) = tokenizer.encode_batch_fast([" ~ ".join([*texts, ""])], add_special_tokens=False)
        ids = np.array(coded.ids, "<u4")
        ends = np.flatnonzero(ids == mark[0])
        if len(ends) == len(texts):
            starts = np.append(0, ends[:-1] + 1)
            return [ids[a:b].tobytes() for a, b in zip(starts, ends)]
    if len(chunks) > 1:
        half = len(chunks) // 2
        return _encoded(tokenizer, chunks[:half]) + _encoded(tokenizer, chunks[half:])
    return [np.array(tokenizer.encode(texts[0], add_special_tokens=False).ids, "<u4").tobytes()]


def _encoder(path: str):
    """Function from texts (an array) to the ids of all and where each text's begin and end.

    The tokenizer cuts texts at white space before it merges, and drops that, so a
    text's ids are those of its chunks between ASCII blanks. Distinct chunks are
    encoded once, and those seen before are looked up.
    """
    tokenizer, known = _tokenizer(path)

    def stem(chunk: bytes) -> bytes:
        """The chunk without a last mark that is a token of its own after a letter."""
        return chunk[:-1] if chunk[-1:] in (b".", b",") and chunk[-2:-1].islower() else chunk

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        places, distinct, ends = _chunks(texts)
        chunks = distinct.to_pylist()
        codes = list(map(known.get, chunks))
        new = [c for c, code in zip(chunks, codes) if code is None]
        stems = list({s for s in map(stem, new) if s not in known} | {b".", b","})
        fresh: dict[bytes, bytes] = {}
        for at in range(0, len(stems), _BATCH):
            some = stems[at : at + _BATCH]
            fresh.update(zip(some, _encoded(tokenizer, some), strict=True))
        for chunk in new:
            if chunk not in fresh:
                short = stem(chunk)
                fresh[chunk] = (known.get(short) or fresh[short]) + fresh[chunk[-1:]]
        codes = [fresh[c] if code is None else code for c, code in zip(chunks, codes)]
        if len(known) + len(fresh) > CACHE:
            known.clear()
        known.update((c, i) for c, i in fresh.items() if len(c) <= 32)
        count = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        values = np.frombuffer(b"".join(codes), "<u4")
        ids, stops = gather(values, np.cumsum(count) - count, count, places)
        return ids, np.append(0, stops)[ends]

    return encode


def _write_task(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        where = TaskContext.get().partitionId()
        names: list = []
        ids: list[np.ndarray] = []
        held, at = 0, 0

        def roll():
            nonlocal names, ids, held, at
            data = packing.build(names, ids)
            row = {
                "temporary": shards.write_part(folder, data),
                "range": where,
                "at": at,
                "docs": len(names),
                "ids": held,
                "bytes": len(data),
            }
            names, ids, held, at = [], [], 0, at + 1
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for part, texts in text_chunks(batch, "__text", CHUNK):
                coded, ends = encode(texts)
                for key, lo, hi in zip(part.column("__key").to_pylist(), ends, ends[1:]):
                    names.append(key)
                    ids.append(np.append(coded[lo:hi], end_id).astype(np.uint32))
                    held += len(ids[-1])
                    if held >= FILE_IDS:
                        yield roll()
        if names:
            yield roll()

    return run


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> list[dict]:
    """Write the ids of all texts in ascending `key` order; returns the manifest.

    NULL and empty texts have the end id alone. NULL keys come first; rows of equal
    key are ordered by a hash of the text, so equal rows may stand in any order. An
    empty table gives a manifest without files. `tokenizer` is the path of its file
    on every executor. Each file of the manifest has `start`, the number of ids in
    the files before it.
    """
    ordered = docs.select(
        F.col(key).cast("long").alias("__key"),
        F.col(text).alias("__text"),
        F.xxhash64(text).alias("__tie"),
    )
    ordered = ordered.repartitionByRange("__key", "__tie").sortWithinPartitions("__key", "__tie")
    written = ordered.select("__key", "__text").mapInArrow(
        _write_task(folder, tokenizer, end_id),
        "temporary string, range long, at long, docs long, ids long, bytes long",
    )
    parts = sorted((r.asDict() for r in written.collect()), key=lambda p: (p["range"], p["at"]))
    start = 0
    for part in parts:
        part["start"] = start
        start += part["ids"]
    return shards.commit(folder, parts, "tokens-{:08d}.bin")


def _read_task(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column("start"), batch.column("content"), strict=True):
                file = packing.TokenFile.parse(data.as_buffer().to_pybytes())
                rows = []
                for name, first, ids in file.documents():
                    coded = ids.astype("<u4")
                    row = {
                        "doc_id": name,
                        "start": base.as_py() + first,
                        "n_tokens": len(ids),
                        "ids_crc32": zlib.crc32(coded.tobytes()),
                    }
                    rows.append(row | ({"ids": coded.astype(np.int64)} if with_ids else {}))
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows)

    return run


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` and, if asked for, `ids` of each document.

    `start` counts the ids of all documents before; the checksum is that of all ids
    as little-endian 32-bit integers. Only files of the manifest are read.
    """
    files = shards.contents(spark, folder, shards.manifest(folder), "name string, start long")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if with_ids:
        schema += ", ids array<long>"
    return files.select("start", "content").mapInArrow(_read_task(with_ids), schema)
