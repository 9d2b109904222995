"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Keep one row per key, the first in the given order.

    ``row_number() = 1`` lets Spark cut each key to one row inside every map task
    (WindowGroupLimit), so a key that holds much of the table ships one row per
    task. Give an order that ends in a unique column to make ties repeatable.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_items(df: DataFrame, keys: Sequence[str], written_at: str, *ties: str) -> DataFrame:
    """State of a key-value table after whole-item puts: the last write of a key wins."""
    order = [F.col(name).desc_nulls_last() for name in (written_at, *ties)]
    return latest_per_key(df, keys, order)
