"""Running visit counter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quayside.operators.profile import visit_counts
from quayside.sinks.keyed import KeyedTable, merge
from quayside.streaming.jobs import ROCKSDB, start


def count_visits(
    visits: DataFrame, page: str, totals: KeyedTable, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep the total views per page in a keyed table.

    Visits combine inside each task before they reach the state, so a page that draws most visits
    costs one row per task and batch. The state lies in RocksDB, and a batch gives on the totals it
    changed only: they replace those of their pages, in the buckets of these pages.
    """
    counted = visit_counts(visits, page)
    writer = counted.writeStream.outputMode("update").foreachBatch(lambda batch, _: merge(totals, batch))
    return start(writer, checkpoint, interval, ROCKSDB)
