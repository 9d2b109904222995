"""Landing zones: file listings, arrival streams and document folders."""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import workspace
from quayside.functions.names import plain_path
from quayside.sources.delimited import as_schema


SOURCE = "__source_file"
#: What a listing made by tasks holds; the size of a folder is null.
LISTED = "path binary, size long"
#: Folders a task lists or files it reads, and bytes of these files, about.
PATHS, BYTES = 10_000, 128 << 20
#: Bytes of the texts that a task holds at once, if no single text is longer.
HELD = 8 << 20
#: Endings of files that are left to Spark's reader, which unpacks them.
PACKED = (".bz2", ".deflate", ".gz", ".lz4", ".snappy", ".zst", ".zstd")


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``(path, size, modified)`` of every file below a folder.

    The content column is never selected, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(
        F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def with_prefix_suffix(df: DataFrame, column: str, prefix: str = "", suffix: str = "") -> DataFrame:
    """Rows whose path starts and ends as asked."""
    return df.where(F.col(column).startswith(prefix) & F.col(column).endswith(suffix))


def stream_arrivals(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    pattern: str = "*.csv",
    delete_after: bool = False,
    sep: str = ",",
    multi_line: bool = True,
    max_files: int | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Stream of newly arrived header CSV files matching a suffix.

    Quoted cells may hold line breaks, and a row that does not fit the schema stops
    the stream unless ``mode`` says otherwise. ``delete_after`` removes a file once
    the batch that read it is committed; each row then names its file in ``SOURCE``,
    by which the sink removes what the last batch read.
    """
    reader = (
        spark.readStream.schema(as_schema(schema))
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", mode)
        .option("columnPruning", False)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
    )
    if delete_after:
        reader = reader.option("cleanSource", "delete")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.csv(folder)
    return files.withColumn(SOURCE, plain_path("_metadata.file_path")) if delete_after else files


def _passed_over(name: bytes, folder: bool) -> bool:
    """Names that Spark's readers take for hidden."""
    if name.startswith(b"_") and b"=" not in name:
        return not (folder and name.startswith((b"_metadata", b"_common_metadata")))
    return name.startswith(b".") or name.endswith(b"._COPYING_")


def _in_folder(folder: bytes) -> Iterator[tuple[bytes, int | None]]:
    with os.scandir(folder) as found:
        for entry in found:
            try:
                size = None if entry.is_dir() else entry.stat().st_size
            except FileNotFoundError:  # a link to nothing, or gone meanwhile
                continue
            if size != 0 and not _passed_over(entry.name, size is None):
                yield entry.path, size


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        yield from batch.column(0).to_pylist()


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder, a few thousand entries at a time."""
    found = itertools.chain.from_iterable(map(_in_folder, _paths(batches)))
    for some in itertools.batched(found, PATHS):
        paths, sizes = zip(*some, strict=True)
        yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.binary()), "size": pa.array(sizes, pa.int64())})


def _check(path: bytes, content: bytes) -> None:
    """Stop where a file differs from the checksums that Hadoop has put beside it; most have none."""
    folder, name = os.path.split(path)
    try:
        with open(os.path.join(folder, b"." + name + b".crc"), "rb") as file:
            head, sums = file.read(8), file.read()
    except FileNotFoundError:
        return
    if head[:4] != b"crc\0":
        return
    step = int.from_bytes(head[4:])
    found = b"".join(zlib.crc32(content[k : k + step]).to_bytes(4) for k in range(0, len(content), step))
    if found != sums:
        raise OSError(f"checksum error: {os.fsdecode(path)}")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id and bytes of each file. The first comes alone, so that a sample reads one file."""

    def batch(held: list[tuple[str, bytes]]) -> pa.RecordBatch:
        ids, contents = zip(*held, strict=True) if held else ((), ())
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.string()), "content": pa.array(contents, pa.binary())})

    held, size, most = [], 0, 1
    for path in _paths(batches):
        with open(path, "rb") as file:
            content = file.read()
        _check(path, content)
        held.append((f"file:{path.decode(errors='replace')}", content))
        size += len(content)
        if size >= most:
            yield batch(held)
            held, size, most = [], 0, HELD
    yield batch(held)


def _dealt(paths: DataFrame, tasks: int) -> DataFrame:
    """The paths in so many partitions; adaptive execution leaves a given number alone."""
    return paths.select("path").repartition(tasks, "path")


def _list_mounted(spark: SparkSession, roots: list[str]) -> DataFrame:
    """The files below folders that all executors have mounted, listed level by level into a table below scratch."""
    place, cores = workspace.scratch(spark, "file-listing"), spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([(root.encode(),) for root in roots], "path binary")
    for depth in itertools.count():
        number = folders.count()
        if not number:
            return spark.read.schema(LISTED).parquet(place).where(F.col("size").isNotNull()).select("path", "size")
        level = f"{place}/level={depth}"
        tasks = max(min(number, cores), -(-number // PATHS))
        _dealt(folders, tasks).mapInArrow(_list, LISTED).write.parquet(level)
        folders = spark.read.schema(LISTED).parquet(level).where(F.col("size").isNull())


def _read_with_spark(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(paths, wholetext=True)
        .select(plain_path("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))
    )


def read_documents(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """One row per text file below an inclusion prefix: ``(doc_id, text)``; the id is the path that listings give.

    Hidden and empty files are passed over. Folders that all executors have mounted (``file:``) are listed now, and read
    when asked for, by Python in tasks: Spark's reader holds the status of every file in the driver. Other stores,
    single files and packed files are left to that reader.
    """
    place = f"{root}/{prefix}".rstrip("/")
    roots = workspace.glob(spark, place)
    if not roots or not all(workspace.is_folder(spark, path) and path.startswith("file:/") for path in roots):
        return _read_with_spark(spark, place)
    files = _list_mounted(spark, [path.removeprefix("file:") for path in roots])
    name = F.col("path").cast("string")
    is_packed = F.lower(name).rlike(rf"({'|'.join(map(re.escape, PACKED))})$")
    packed = [workspace.literal(f"file:{row.name}") for row in files.where(is_packed).select(name.alias("name")).collect()]
    files = files.where(~is_packed)
    number, size = files.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    cores = spark.sparkContext.defaultParallelism
    tasks = max(1, min(number, cores), -(-number // PATHS), -(-size // BYTES))
    read = _dealt(files, tasks).mapInArrow(_read, "doc_id string, content binary")
    texts = read.select("doc_id", F.col("content").cast("string").alias("text"))
    return texts.unionByName(_read_with_spark(spark, packed)) if packed else texts
