"""Web archives: a deterministic sharded writer, and a reader.

Records are range-sorted by page id. The split points come from a sample that a
hash of the ids draws, so that runs over the same pages cut the same shards. A
task writes its shard record by record, each a gzip member, rolls to a new file
when the compressed size is reached, regenerates all headers and digests, and
reports the files; the driver renames them and writes the manifest (see
`shards`). A payload that an earlier page has is written as a revisit.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.llm import shards

FILE_BYTES = 64 << 20  # compressed size at which a file is rolled
SHARD_ROWS = 5_000  # pages of a shard, on average
SAMPLE = 64  # ids sampled per shard
LEVEL = 6
_SLICE = 8192

# Fixed values of the format.
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # name space of URLs
_DATE = "1970-01-01T00:00:00Z"


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}|{url}')}>"


def _line(value: str) -> str:
    """A header's value: no line breaks, bytes beyond ASCII escaped."""
    return "".join(c if " " < c < "\x7f" and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id, url, payload: bytes, refers_to, refers_url) -> bytes:
    """One record; a revisit if `refers_to` is given, with the headers alone."""
    digest = _sha1(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, url),
        "WARC-Date": _DATE,
        "WARC-Target-URI": _line(url or ""),
        "Page-ID": "" if page_id is None else str(page_id),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{_sha1(block)}",
    }
    if refers_to is not None:
        headers |= {
            "WARC-Profile": _PROFILE,
            "WARC-Refers-To": record_id(refers_to, refers_url),
            "Refers-To-Page-ID": str(refers_to),
        }
    headers["Content-Length"] = str(len(block))
    head = "\r\n".join(f"{k}: {v}" for k, v in headers.items())
    return b"\r\n".join([_VERSION, head.encode(), b"", block, b"", b""])


def _gzip(data: bytes) -> bytes:
    """A gzip member without a time stamp, so equal records give equal bytes."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _split_points(keys: DataFrame, rows: int) -> list[int]:
    """Page ids that cut the pages into shards of about equal numbers.

    A hash of the id decides what is sampled: `SAMPLE` ids per shard are expected,
    whatever their order or partitions, and equal ids stay together.
    """
    parts = -(-rows // SHARD_ROWS)
    if parts < 2:
        return []
    share = min(1.0, SAMPLE * parts / rows)
    drawn = F.pmod(F.xxhash64("__key"), F.lit(1 << 30)) < int(share * (1 << 30))
    found = keys.filter(drawn & F.col("__key").isNotNull()).select("__key").distinct()
    sample = sorted(r[0] for r in found.collect())
    return sorted({sample[len(sample) * i // parts] for i in range(1, parts)} if sample else [])


def _write_task(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        held, at, shard, records = 0, 0, None, 0

        def roll():
            nonlocal parts, held, at, records
            data = b"".join(parts)
            row = {
                "temporary": shards.write_part(folder, data),
                "shard": shard,
                "at": at,
                "records": records,
                "bytes": len(data),
                "sha1": _sha1(data),
            }
            parts, held, at, records = [], 0, at + 1, 0
            return pa.RecordBatch.from_pylist([row])

        marks: dict[str, tuple] = {}
        names = ("__shard", "__key", "__url", "__mark", "__refers", "__refers_url")
        last = None
        for batch in batches:
            pages = batch.column("__payload").cast(pa.large_binary())
            columns = [batch.column(c) for c in names]
            for i in range(batch.num_rows):
                its, key, url, mark, refers, refers_url = (c[i].as_py() for c in columns)
                if (its, key) != last:
                    marks, last = {}, (its, key)
                if mark is not None:
                    marks[mark] = (refers, refers_url)
                    continue
                if parts and (its != shard or held >= file_bytes):
                    yield roll()
                if its != shard:
                    shard, at = its, 0
                payload = pages[i].as_py() or b""
                earlier = marks.get(hashlib.sha1(payload).hexdigest(), (None, None))
                data = _gzip(record(key, url, payload, *earlier))
                parts.append(data)
                held += len(data)
                records += 1
        if parts:
            yield roll()

    return run


def write_warc(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
) -> list[dict]:
    """Write a record per page; returns the manifest: files, shards, sizes, digests.

    Of pages with equal payloads of at least `revisit_bytes` bytes, those with the
    smallest page id are responses and the others revisit them; shorter payloads
    are responses all. A NULL payload is empty. Pages without an id are sorted
    first and never referred to while another page has one. Pages that repeat the
    smallest id are responses all. An empty table gives a manifest without files.
    """
    slim = pages.select(
        F.col(key).cast("long").alias("__key"),
        F.col(url).cast("string").alias("__url"),
        F.col(payload).cast("string").alias("__payload"),
    )
    payload_bytes = F.coalesce("__payload", F.lit("")).cast("binary")
    named = slim.select(
        "__key", "__url", F.sha1(payload_bytes).alias("__digest"),
        F.length(payload_bytes).alias("__size"),
    )
    # A third of all pages may be one payload: partial minima come first and nothing
    # of a group is gathered.
    place = F.struct("__key", "__url")
    first = (
        named.filter(F.col("__size") >= revisit_bytes)
        .groupBy("__digest")
        .agg(
            F.count("*").alias("n"),
            F.min(place).alias("any"),
            F.min(F.when(F.col("__key").isNotNull(), place)).alias("known"),
        )
        .filter("n > 1")
        .select("__digest", F.coalesce("known", "any").alias("__first"))
    )
    rows = slim.agg(F.count("*")).first()[0]
    points = np.array(_split_points(slim, rows), np.int64)

    def shard_of(batches):
        for batch in batches:
            keys = batch.column("__key").to_pandas()
            missing = keys.isna().to_numpy()
            at = np.searchsorted(points, keys.fillna(0).to_numpy(np.int64), side="right")
            at[missing] = 0
            yield batch.append_column("__shard", pa.array(at.astype(np.int32)))

    # Revisits are told to the writer by rows of their own, sorted before the page's:
    # payloads are moved once, to their shards, and joined with nothing.
    later = ~F.col("__key").eqNullSafe(F.col("__first.__key"))
    marks = named.join(first, "__digest").filter(later)
    marks = marks.select(
        "__key",
        F.lit(None).cast("string").alias("__url"),
        F.lit(None).cast("string").alias("__payload"),
        F.col("__digest").alias("__mark"),
        F.col("__first.__key").alias("__refers"),
        F.col("__first.__url").alias("__refers_url"),
    )
    marked = marks.unionByName(
        slim.select(
            "*",
            F.lit(None).cast("string").alias("__mark"),
            F.lit(None).cast("long").alias("__refers"),
            F.lit(None).cast("string").alias("__refers_url"),
        )
    )
    schema = T.StructType([*marked.schema.fields, T.StructField("__shard", T.IntegerType())])
    placed = marked.mapInArrow(shard_of, schema)
    order = ["__shard", "__key", F.col("__mark").isNull(), "__url", F.xxhash64("__payload")]
    sharded = placed.repartitionById(len(points) + 1, "__shard").sortWithinPartitions(*order)
    written = sharded.mapInArrow(
        _write_task(folder, file_bytes),
        "temporary string, shard long, at long, records long, bytes long, sha1 string",
    )
    parts = sorted((r.asDict() for r in written.collect()), key=lambda p: (p["shard"], p["at"]))
    return shards.commit(folder, parts, "pages-{:08d}.warc.gz")


def _members(data: bytes) -> Iterator[bytes]:
    """Contents of the gzip members; fed in small slices, as what follows is copied."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(view):
                raise ValueError("the file ends within a record")
            parts.append(unpacker.decompress(view[at : at + _SLICE]))
            at += _SLICE
        at = min(at, len(view)) - len(unpacker.unused_data)
        yield b"".join(parts)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a file of gzip members."""
    for raw in _members(data):
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines)
        block = rest[: int(headers["Content-Length"])]
        if version.encode() != _VERSION or rest[len(block) :] != b"\r\n\r\n":
            raise ValueError("not a whole record")
        if headers["WARC-Block-Digest"] != f"sha1:{_sha1(block)}":
            raise ValueError(f"block digest of {headers['WARC-Record-ID']}")
        yield headers, block


def _read_task(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                rows = []
                for headers, block in records(data.as_buffer().to_pybytes()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"]
                    if kind == "response" and (
                        size != len(payload) or digest != f"sha1:{_sha1(payload)}"
                    ):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']}")
                    refers = headers.get("Refers-To-Page-ID")
                    row = {
                        "page_id": int(headers["Page-ID"]) if headers["Page-ID"] else None,
                        "payload_bytes": size,
                        "payload_digest": digest.removeprefix("sha1:"),
                        "record_type": kind,
                        "refers_to": int(refers) if refers else None,
                        "url": headers["WARC-Target-URI"],
                    }
                    rows.append(row | ({"payload": payload} if with_payload else {}))
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_pylist(rows, _schema(with_payload))
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, _schema(with_payload))

    return run


def _schema(with_payload: bool) -> pa.Schema:
    fields = [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
    ]
    return pa.schema(fields + [("payload", pa.binary())] * with_payload)


def read_warc(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the files in the manifest; digests are verified.

    `payload` is empty for revisits.
    """
    files = shards.contents(spark, folder, shards.manifest(folder), "name string, records long")
    schema = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, url string" + ", payload binary" * with_payload
    )
    return files.select("content").mapInArrow(_read_task(with_payload), schema)
