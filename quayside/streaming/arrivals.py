"""Arriving files: to dated Parquet, or to gzip with the source removed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quayside import workspace
from quayside.sinks.delimited import ROWS_PER_GZIP, write_csv
from quayside.sources.landing import SOURCE
from quayside.streaming.jobs import start

#: Ends a file name in the list of what a batch read: a name may hold a line break.
NAME_END = "\0"


def batch_folder(spark: SparkSession, out: str, day: dt.date | None, form: str, batch_id: int) -> str:
    """Folder of a batch below its day: the given one, or the day on which the batch first ran."""
    name = f"batch-{batch_id:08d}"
    begun = workspace.glob(spark, f"{out}/*/{name}")
    return begun[0] if begun else f"{out}/{day or dt.date.today():{form}}/{name}"


def to_dated_parquet(
    files: DataFrame, out: str, day: dt.date | None, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """New files become Parquet below ``out/yyyy-MM-dd/batch-<id>``, each exactly once.

    Without a day every batch goes by the date on which it runs; a batch that runs
    again replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(batch.sparkSession, out, day, "%Y-%m-%d", batch_id)
        batch.drop(SOURCE).write.mode("overwrite").parquet(folder)

    return start(files.writeStream.foreachBatch(write), checkpoint, interval)


def to_gzip(
    files: DataFrame, out: str, day: dt.date | None, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """New files become gzip CSV below ``out/yyyyMMdd/batch-<id>``.

    Read them with ``stream_arrivals(..., delete_after=True)`` to have each source
    file removed after the batch that wrote it is committed. The stream itself
    removes files one batch later; a run that ends also removes those of its last.
    """
    sources = f"{checkpoint}-sources"

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(batch.sparkSession, out, day, "%Y%m%d", batch_id)
        write_csv(batch.drop(SOURCE), folder, ",", "gzip", ROWS_PER_GZIP)
        if SOURCE in batch.columns:
            names = batch.select(SOURCE).distinct()
            names.write.mode("overwrite").option("lineSep", NAME_END).text(f"{sources}/{batch_id}")

    query = start(files.writeStream.foreachBatch(write), checkpoint, interval)
    spark = files.sparkSession
    last = query.lastProgress
    if interval is None and last is not None and workspace.exists(spark, f"{sources}/{last['batchId']}"):
        # One file name a row, however many rows the files hold.
        names = spark.read.option("lineSep", NAME_END).text(f"{sources}/{last['batchId']}").toLocalIterator()
        workspace.delete_all(spark, (row.value for row in names))
    return query
