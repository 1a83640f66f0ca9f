"""Files that tasks write and the driver commits.

A task writes under a temporary name of its own attempt and reports what it
wrote. Only reports of attempts that succeeded reach the driver, which gives the
files their final names and then writes the manifest. A reader trusts the
manifest alone, so a retried or speculative task leaves nothing that is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPORARY = "_temporary"
MANIFEST = "manifest.json"


def _store(folder: str):
    return fs.FileSystem.from_uri(folder)


def write_part(folder: str, data: bytes) -> str:
    """Write a file under a temporary name; returns that name."""
    store, path = _store(folder)
    attempt = TaskContext.get().taskAttemptId()
    name = f"{TEMPORARY}/{attempt}-{uuid.uuid4().hex}"
    store.create_dir(f"{path}/{TEMPORARY}", recursive=True)
    with store.open_output_stream(f"{path}/{name}") as out:
        out.write(data)
    return name


def commit(folder: str, parts: Sequence[dict], name: str) -> list[dict]:
    """Rename the parts, in the order given, and write the manifest.

    `name` is the final name with a place for the number. Each part is a dict with
    the key "temporary"; the manifest has them with "name" in its place.
    """
    store, path = _store(folder)
    store.create_dir(path, recursive=True)
    out = []
    for at, part in enumerate(parts):
        final = name.format(at)
        store.move(f"{path}/{part['temporary']}", f"{path}/{final}")
        out.append({"name": final} | {k: v for k, v in part.items() if k != "temporary"})
    with store.open_output_stream(f"{path}/{MANIFEST}.new") as stream:
        stream.write(json.dumps({"files": out}).encode())
    store.move(f"{path}/{MANIFEST}.new", f"{path}/{MANIFEST}")
    return out


def manifest(folder: str) -> list[dict]:
    store, path = _store(folder)
    with store.open_input_stream(f"{path}/{MANIFEST}") as stream:
        return json.loads(stream.readall())["files"]


def contents(spark: SparkSession, folder: str, files: Sequence[dict], schema: str) -> DataFrame:
    """A row per file: the manifest's fields of `schema`, and `content` (binary).

    The manifest's rows, as many as there are files, are given to every task.
    """
    names = [f"{folder}/{f['name']}" for f in files]
    if not names:
        return spark.createDataFrame([], f"{schema}, content binary")
    fields = [c.split()[0] for c in schema.split(", ")]
    listed = spark.createDataFrame([tuple(f[c] for c in fields) for f in files], schema)
    found = spark.read.format("binaryFile").load(names).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "content"
    )
    return found.join(F.broadcast(listed), "name").select(*fields, "content")
