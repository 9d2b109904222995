"""One text file for each document, in a folder that names its key."""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside import workspace

#: How Spark's writer names the folder of a null key.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def write_documents(documents: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> None:
    """Write each text, a null one as empty, with a line end to a file of its own below ``folder/key=.../``.

    ``key`` is of whole numbers. In a folder that all executors have mounted (``file:``) tasks write the files themselves:
    Hadoop's local files start a ``chmod`` four times for each, which is nearly all the time of small
    ones. A file is put in place whole, so a task that runs again replaces its own. Other stores are left to Spark's writer.
    Texts that share a key share a file if one task holds them.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(key).cast("string").alias(key), F.coalesce(F.col(text), F.lit("")).alias("value"))
    at = workspace.qualified(spark, folder)
    if urlparse(at).scheme != "file":
        rows.write.partitionBy(key).text(folder)
        return
    workspace.make_folder(spark, folder)
    root = urlparse(at).path

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, written = TaskContext.get(), 0
        for name, texts in itertools.groupby(_rows(batches), key=lambda row: row[0]):
            place = f"{root}/{key}={NO_KEY if name is None else name}"
            os.makedirs(place, exist_ok=True)
            part = f"part-{task.partitionId():05d}"
            begun = f"{place}/.{part}-{task.taskAttemptId()}"
            with open(begun, "wb") as file:
                file.writelines(value + b"\n" for _, value in texts)
            os.replace(begun, f"{place}/{part}.txt")
            written += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([written], pa.int64())})

    # Sorted, so that texts of one key follow each other.
    binary = rows.select(key, F.col("value").cast("binary").alias("value")).sortWithinPartitions(key)
    binary.mapInArrow(write, "files long").agg(F.sum("files")).collect()
