"""Clickstream delivery: record transform, hourly folders, buffered writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside import workspace
from quayside.functions.text import decode_base64, encode_base64, with_newline
from quayside.streaming.buffer import buffered
from quayside.streaming.jobs import ROCKSDB, start

# Flush interval and size of the delivery, and the record results.
FLUSH_INTERVAL = "60 seconds"
FLUSH_SECONDS = 60
FLUSH_BYTES = 1_048_576
OK = "Ok"
FAILED = "ProcessingFailed"

#: Folder levels of an hour below its result, with the piece of ``yyyy-MM-dd-HH`` that each one names.
BY_PARTS = {"year": (1, 4), "month": (6, 2), "day": (9, 2), "hour": (12, 2)}
BY_HOUR = {"datehour": (1, 13)}
MERGE_SMALL = "spark.sql.adaptive.coalescePartitions.enabled"


def transform_records(records: DataFrame) -> DataFrame:
    """Decode each record, end it with a newline, encode it again; ids are kept.

    A record that is not base64 comes back unchanged, marked as failed. Other
    columns pass through. Nothing is remembered between records.
    """
    text = decode_base64("data")
    return records.withColumns(
        {
            "result": F.when(text.isNotNull(), OK).otherwise(FAILED),
            "data": F.coalesce(encode_base64(with_newline(text)), F.col("data")),
        }
    )


def hourly_lines(transformed: DataFrame, arrival: str = "arrival_ts") -> DataFrame:
    """``(value, result, datehour)``: the text to write, the record's result and the hour it arrived.

    The hour is that of arrival, so nothing is ever late. The text sink ends each
    line, so the newline the transform added is taken off again.
    """
    text = F.rtrim(decode_base64("data"), F.lit("\n"))
    hour = F.date_format(F.coalesce(F.col(arrival), F.localtimestamp()), "yyyy-MM-dd-HH")
    return transformed.select(
        F.when(F.col("result") == OK, text).otherwise(F.col("data")).alias("value"),
        F.coalesce(F.col("result"), F.lit(FAILED)).alias("result"),
        hour.alias("datehour"),
    )


def _below(root: str, levels: dict, result: str, hour: str, batch_id: int) -> str:
    folders = [f"{name}={hour[at - 1 : at - 1 + n]}" for name, (at, n) in levels.items()]
    return "/".join([root, f"result={result}", *folders, f"batch={batch_id}"])


def write_hour_folders(batch: DataFrame, batch_id: int, root: str, levels: dict = BY_PARTS) -> None:
    """Append one micro-batch below ``result=/year=/month=/day=/hour=/batch=``, in one write.

    Spark's committer puts the files in place; the driver moves nothing. Rows are
    gathered by hour first, so a backlog does not leave a file per task and hour; the
    rebalance splits an hour that holds much of the batch.

    A marker is set before the write. A batch that finds its own was cut off or not
    recorded: what it left in its hours, and unfinished work below the root, goes first,
    so it replaces itself. A root belongs to one stream.
    """
    spark = batch.sparkSession
    marker = f"{root}/_begun/{batch_id}"
    if workspace.exists(spark, marker):
        workspace.delete(spark, f"{root}/_temporary")
        for row in batch.select("result", "datehour").distinct().toLocalIterator():
            workspace.delete(spark, _below(root, levels, row.result, row.datehour, batch_id))
    else:
        workspace.make_folder(spark, marker)
    folders = {name: F.substring("datehour", at, n) for name, (at, n) in levels.items()}
    gathered = batch.hint("rebalance", "result", "datehour")
    rows = gathered.select(
        "value", "result", *[part.alias(name) for name, part in folders.items()], F.lit(batch_id).alias("batch")
    )
    # Opening a folder costs more than its bytes, so small shares of the hours are not merged into one task.
    before = spark.conf.get(MERGE_SMALL)
    spark.conf.set(MERGE_SMALL, "false")
    try:
        rows.write.mode("append").partitionBy("result", *folders, "batch").text(root)
    finally:
        spark.conf.set(MERGE_SMALL, before)
    workspace.delete(spark, f"{root}/_begun/{batch_id - 1}")


def deliver(
    records: DataFrame,
    root: str,
    checkpoint: str,
    interval: str | None = FLUSH_INTERVAL,
    hook: Callable[[DataFrame], DataFrame] = transform_records,
    levels: dict = BY_PARTS,
) -> StreamingQuery:
    """Deliver a record stream to hour folders; ``hook`` is the record transform."""
    lines = hourly_lines(records.transform(hook))
    writer = lines.writeStream.foreachBatch(lambda b, i: write_hour_folders(b, i, root, levels))
    return start(writer, checkpoint, interval)


def deliver_hive(
    records: DataFrame,
    root: str,
    checkpoint: str,
    interval: str | None = FLUSH_INTERVAL,
    hook: Callable[[DataFrame], DataFrame] = transform_records,
) -> StreamingQuery:
    """The same delivery with one ``datehour=`` folder an hour."""
    return deliver(records, root, checkpoint, interval, hook, BY_HOUR)


def deliver_buffered(
    records: DataFrame,
    root: str,
    checkpoint: str,
    flush_bytes: int = FLUSH_BYTES,
    flush_seconds: float = FLUSH_SECONDS,
    interval: str = "1 second",
    lanes: int = 8,
    hook: Callable[[DataFrame], DataFrame] = transform_records,
    levels: dict = BY_PARTS,
) -> StreamingQuery:
    """The delivery with a buffer: lines of an hour are written once ``flush_bytes`` are there or ``flush_seconds`` are over.

    The query looks every ``interval`` and writes no file while no buffer is due. An hour fills ``lanes``
    buffers side by side. It keeps running; a stopped one goes on with what it held back when it is
    started again, and ``deliver`` without an interval is the one that leaves nothing behind.
    """
    lines = buffered(hourly_lines(records.transform(hook)), flush_bytes, int(flush_seconds * 1000), lanes)
    writer = lines.writeStream.outputMode("append").foreachBatch(lambda b, i: write_hour_folders(b, i, root, levels))
    return start(writer, checkpoint, interval, ROCKSDB)
