"""Lines held back by hour until there are enough of them, or the oldest has waited long enough."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "value string, result string, datehour string"


class HourBuffer(StatefulProcessor):
    """The lines of one result, hour and lane. A group never holds more than ``most`` bytes and one batch of rows."""

    def __init__(self, most: int, wait_ms: int):
        self.most, self.wait_ms = most, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lines = handle.getListState("lines", "value string")
        self.held = handle.getValueState("held", "bytes long, due long")

    def _taken(self, key: tuple, fresh: list) -> pd.DataFrame:
        values = [row[0] for row in self.lines.get()] + fresh
        self.lines.clear()
        return pd.DataFrame({"value": values, "result": key[0], "datehour": key[1]}, dtype=object)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.held.get() if self.held.exists() else None
        size, due = (held[0], held[1]) if held else (0, None)
        for part in rows:
            values, sizes = part["value"].tolist(), part["size"].to_numpy(np.int64)
            low, ends = 0, np.cumsum(sizes)
            while low < len(values):
                gone = int(ends[low - 1]) if low else 0
                full = int(np.searchsorted(ends, self.most - size + gone))
                if full >= len(values):
                    self.lines.appendList([(value,) for value in values[low:]])
                    size += int(ends[-1]) - gone
                    if due is None:
                        due = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
                        self.handle.registerTimer(due)
                    break
                yield self._taken(key, values[low : full + 1])
                if due is not None:
                    self.handle.deleteTimer(due)
                low, size, due = full + 1, 0, None
        if due is None:
            self.held.clear()
        else:
            self.held.update((size, due))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        yield self._taken(key, [])

    def close(self) -> None:
        pass


def buffered(lines: DataFrame, most: int, wait_ms: int, lanes: int) -> DataFrame:
    """``hourly_lines`` that leave once ``most`` bytes of an hour and lane are there, or the first has waited ``wait_ms``.

    Lines of the running hour are nearly all lines there are, so every hour is dealt over ``lanes`` by
    the hash of the line, each with a buffer of its own. Lines of equal text share a lane. What is held
    back is in the state store and outlives a restart. A null line counts as an empty one.
    """
    size = F.coalesce(F.octet_length("value"), F.lit(0)) + 1
    lane = F.pmod(F.xxhash64("value"), F.lit(lanes)).cast("int")
    return (
        lines.select("value", "result", "datehour", size.cast("long").alias("size"), lane.alias("lane"))
        .groupBy("result", "datehour", "lane")
        .transformWithStateInPandas(HourBuffer(most, wait_ms), OUTPUT, "Append", "ProcessingTime")
    )
