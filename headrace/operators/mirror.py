"""Mirror of raw source files: their rows as stored, one directory per file name."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.sources.files import by_halves
from headrace.sources.footers import Alike, by_schema

SOURCE_FILE = "source_file"
OUTCOME = "path STRING, source_file STRING, status STRING, row_count LONG"
OK, MISSING, FAILED = "ok", "missing", "failed"
SCHEMAS_AT_ONCE = 4
# Characters that Spark writes as %XX in the name of a partition's directory.
_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^") | {chr(c) for c in range(1, 32)}


def _name(path: str) -> str:
    return path.rpartition("/")[2]


def _directory(destination: str, name: str) -> str:
    escaped = "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in name)
    return f"{destination.rstrip('/')}/{SOURCE_FILE}={escaped}"


def _own_name() -> Column:
    """A row's file name as it is on disk; Spark's metadata has blanks and signs percent-encoded."""
    name = F.col("_metadata.file_name")
    return F.when(name.contains("%"), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)


def _copy(spark: SparkSession, group: Alike, paths: Sequence[str], destination: str) -> None:
    """Files of one schema and of different names, each over the older copy of its name."""
    reader = spark.read.schema(group.schema)
    filled = [path for path in paths if group.files[path]]
    if filled:
        rows = reader.parquet(*filled).withColumn(SOURCE_FILE, _own_name())
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SOURCE_FILE).parquet(destination)
    for path in set(paths) - set(filled):  # no rows, so no partition that would replace the older one
        reader.parquet(path).write.mode("overwrite").parquet(_directory(destination, _name(path)))


def _copied(spark: SparkSession, groups: Sequence[Alike], chosen: Mapping[str, str], destination: str) -> set[str]:
    """Copy one file for each name; returns the paths that went through. Halving finds those that do not."""
    wanted = set(chosen.values())

    def copy_alike(group: Alike) -> list[tuple[list[str], None | Exception]]:
        paths = [path for path in group.files if path in wanted]
        return by_halves(paths, lambda some: _copy(spark, group, some, destination), may_split=lambda error: True)

    # Files of one schema touch directories of their own, so several schemas can be written at a time.
    with ThreadPoolExecutor(SCHEMAS_AT_ONCE) as threads:
        outcomes = chain.from_iterable(threads.map(copy_alike, groups))
        return {path for paths, error in outcomes if error is None for path in paths}


def mirror_files(spark: SparkSession, paths: Sequence[str], destination: str) -> DataFrame:
    """Copy the rows of each file to ``destination/source_file=<name>``, replacing an older copy.

    Returns ``path, source_file, status, row_count`` with status ``ok``, ``missing`` or ``failed``. Where
    several paths end in one name, the last of them that can be copied is what the mirror holds, as if they
    had been copied one after another; earlier ones are ``ok`` without being written first. Footers are
    read once, files with the same schema are written together, a large file by as many tasks as it has
    splits. When a write fails, halving finds the files at fault and the rest still goes through.
    """
    paths = list(dict.fromkeys(paths))
    groups, errors = by_schema(spark, paths)
    statuses = {path: MISSING if "PATH_NOT_FOUND" in error else FAILED for path, error in errors.items()}
    counts = {path: n for group in groups for path, n in group.files.items()}
    waiting: dict[str, list[str]] = defaultdict(list)
    for path in paths:
        if path in counts:
            waiting[_name(path)].append(path)
    while waiting:
        chosen = {name: candidates.pop() for name, candidates in waiting.items()}
        done = _copied(spark, groups, chosen, destination)
        for name, path in chosen.items():
            statuses[path] = OK if path in done else FAILED
            if path in done:
                statuses.update(dict.fromkeys(waiting[name], OK))
                del waiting[name]
        waiting = {name: candidates for name, candidates in waiting.items() if candidates}
    outcomes = [(path, _name(path), statuses[path], counts[path] if statuses[path] == OK else 0) for path in paths]
    return spark.createDataFrame(outcomes, OUTCOME)
