"""Shared scratch folder and the few file-system calls the sinks need.

Everything a job stages goes below the folder named by ``spark.checkpoint.dir``,
which every executor can reach. Only a local-mode session without that setting
gets a folder of its own.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, or a new local one in local mode only."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="quayside-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder for one run of one job."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/quayside/{app}/{label}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Delete this application's scratch folders, once their results have been read."""
    folder = f"{shared_root(spark)}/quayside/{spark.sparkContext.applicationId}"
    if exists(spark, folder):
        delete(spark, folder)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def is_folder(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).getFileStatus(_path(spark, path)).isDirectory()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as file listings spell it."""
    return _fs(spark, path).makeQualified(_path(spark, path)).toString().rstrip("/")


def literal(path: str) -> str:
    """The path for a reader, which takes brackets, braces and stars as patterns unless told otherwise."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob pattern; empty when nothing matches."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(status.getPath().toString() for status in found) if found else []


def children(spark: SparkSession, path: str) -> list[str]:
    """Direct children of a folder, hidden and bookkeeping entries left out."""
    if not exists(spark, path):
        return []
    found = _fs(spark, path).listStatus(_path(spark, path))
    names = sorted(status.getPath().toString() for status in found)
    return [n for n in names if not n.rsplit("/", 1)[1].startswith(("_", "."))]


def delete(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)


def delete_all(spark: SparkSession, paths: Iterable[str], at_once: int = 8) -> None:
    """Delete files; one that is there and cannot be deleted is an error, one that is gone is not."""

    def gone(path: str) -> None:
        if not delete(spark, path) and exists(spark, path):
            raise OSError(f"could not delete {path}")

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        list(pool.map(gone, paths))


def make_folder(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).mkdirs(_path(spark, path))


def move_all(spark: SparkSession, moves: dict[str, str], at_once: int = 8) -> None:
    """Rename each source to its target, replacing what a failed attempt left there."""
    if not moves:
        return
    fs = _fs(spark, next(iter(moves)))

    def move(pair: tuple[str, str]) -> None:
        old, new = (_path(spark, path) for path in pair)
        fs.mkdirs(new.getParent())
        fs.delete(new, True)
        if not fs.rename(old, new):
            raise OSError(f"could not move {pair[0]} to {pair[1]}")

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        list(pool.map(move, moves.items()))
