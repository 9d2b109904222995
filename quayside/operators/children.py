"""Child records of listed parents."""

from __future__ import annotations

from pyspark.sql import DataFrame


def of_parents(
    children: DataFrame, parents: DataFrame, child_key: str, parent_key: str | None = None
) -> DataFrame:
    """Children whose parent is listed; a parent listed twice counts once.

    Both sides are plain shuffles unless one is small enough to broadcast, so that
    adaptive execution can split a parent that holds much of the table.
    """
    listed = parents.select(parents[parent_key or child_key].alias(child_key))
    return children.join(listed, child_key, "left_semi").select(*children.columns)
