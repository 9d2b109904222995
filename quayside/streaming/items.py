"""Keyed puts as a stream: the last write of each key is the table's state."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.operators.latest import latest_items
from quayside.sinks.keyed import KeyedTable, merge
from quayside.streaming.jobs import start


def put_items(
    puts: DataFrame, newest: Sequence[str], state: KeyedTable, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Merge each batch into the keyed table, of which only the buckets of its keys are rewritten.

    ``newest`` lists the write time and its tie-breaks; an unknown time is the oldest. A put replaces the
    row of its key unless that is newer, so a batch that runs again changes nothing.
    """

    def wins(old: Callable[[str], Column], new: Callable[[str], Column]) -> Column:
        return F.struct(*[new(name) for name in newest]) >= F.struct(*[old(name) for name in newest])

    def put(batch: DataFrame, _: int) -> None:
        merge(state, latest_items(batch, state.keys, *newest), wins)

    return start(puts.writeStream.foreachBatch(put), checkpoint, interval)
