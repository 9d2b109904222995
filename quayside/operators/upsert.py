"""Staged rows into a target table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from quayside.operators.combine import union_strict
from quayside.operators.latest import latest_per_key
from quayside.sinks.keyed import KeyedTable, merge


def upsert(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column],
) -> DataFrame:
    """Target rows whose key is not staged, and the newest staged row of each key.

    Staged rows without a key count as one key, and replace no target row.
    """
    fresh = latest_per_key(staged, keys, newest_first)
    kept = target.join(staged.select(*keys), list(keys), "left_anti").select(*target.columns)
    return union_strict([kept, fresh.select(*target.columns)])


def upsert_table(target: KeyedTable, staged: DataFrame, newest_first: Sequence[Column]) -> list[int]:
    """The same into a keyed table: reads and replaces only the buckets that hold a staged key.

    The target is not shuffled; the staged rows are dealt as it lies. Returns the rewritten buckets.
    """
    return merge(target, latest_per_key(staged, target.keys, newest_first), match_nulls=False)
