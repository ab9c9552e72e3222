"""Schemas and row counts of many Parquet files in one pass over their footers.

Workers open each file's footer and reduce its schema to a fingerprint. The driver gets one small row a
file and reads the schema itself only once for each distinct fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql import types as T

FILES_PER_TASK = 64
THREADS_PER_TASK = 8
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"  # fixed value: where Spark keeps its own schema
FOOTER = "path STRING, fingerprint STRING, row_count LONG, error STRING"
UNREACHED, BROKEN = "unreached", "not a Parquet file"


@dataclass
class Alike:
    """Files with one schema, in path order, each with its row count."""

    schema: T.StructType
    files: dict[str, int] = field(default_factory=dict)


def _opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), path


def _footer(path: str) -> tuple[str, str | None, int | None, str | None]:
    try:
        system, name = _opened(path)
        file = system.open_input_file(name)
    except Exception:  # noqa: BLE001  a store, or settings of it, that only the session knows; or no file
        return path, None, None, UNREACHED
    try:
        with file:
            found = pq.ParquetFile(file).metadata
    except (pa.ArrowException, OSError) as error:
        return path, None, None, f"{BROKEN}: {error}"
    own = (found.metadata or {}).get(SPARK_SCHEMA, b"")
    schema = str(found.schema).partition("\n")[2].encode()  # the first line names an object in memory
    return path, hashlib.sha256(own + b"\0" + schema).hexdigest(), found.num_rows, None


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "fingerprint", "row_count", "error"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string()]
    with ThreadPoolExecutor(THREADS_PER_TASK) as threads:
        for batch in batches:
            rows = list(threads.map(_footer, batch.column("path").to_pylist()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names)


def _asked(spark: SparkSession, path: str) -> tuple[str, str | None, int | None, str | None]:
    """The same of a file that only Spark can open."""
    try:
        found = spark.read.parquet(path)
        return path, found.schema.json(), found.count(), None
    except Exception as error:  # noqa: BLE001
        return path, None, None, str(error)


def by_schema(spark: SparkSession, paths: Sequence[str]) -> tuple[list[Alike], dict[str, str]]:
    """Groups of files that have exactly the same schema, in order of their first file, and errors by path.

    Equal means equal to the last nested field, as stored; so what one file's values look like never
    depends on which files are read with it.
    """
    paths = sorted(set(paths))
    if not paths:
        return [], {}
    tasks = -(-len(paths) // FILES_PER_TASK)
    listed = spark.createDataFrame([(path,) for path in paths], "path STRING")
    rows = [tuple(row) for row in listed.repartition(tasks, "path").mapInArrow(_footers, FOOTER).collect()]
    unreached = [row[0] for row in rows if row[3] == UNREACHED]
    with ThreadPoolExecutor(THREADS_PER_TASK) as threads:
        asked = list(threads.map(lambda path: _asked(spark, path), unreached))
    groups: dict[str, Alike] = {}
    errors: dict[str, str] = {}
    for path, fingerprint, row_count, error in sorted([row for row in rows if row[3] != UNREACHED] + asked):
        if fingerprint is None:
            errors[path] = error
            continue
        if fingerprint not in groups:
            groups[fingerprint] = Alike(spark.read.parquet(path).schema)
        groups[fingerprint].files[path] = row_count
    return list(groups.values()), errors
