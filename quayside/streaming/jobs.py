"""Starting a streaming write: run what is there, or keep running."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

#: State on the executors' disks with changes alone written to the checkpoint, for state that outgrows memory.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def start(
    writer: DataStreamWriter, checkpoint: str, interval: str | None = None, settings: Mapping[str, str] | None = None
) -> StreamingQuery:
    """Start with a checkpoint.

    Without an interval the query takes all available input and ends before this
    returns; with one it keeps running at that interval. A query takes the session's
    settings along when it starts, so ``settings`` are its own: the session gets its old ones back.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    spark = SparkSession.active()
    before = {name: spark.conf.get(name, None) for name in settings or {}}
    for name, value in (settings or {}).items():
        spark.conf.set(name, value)
    try:
        query = writer.start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    if not interval:
        query.awaitTermination()
    return query
