"""Column widths, key checks, counters and existence tests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: spare characters on top of the header's length.
WIDTH_MARGIN = 200


def width_profile(df: DataFrame) -> DataFrame:
    """``(ordinal, column_name, width)``: text width each column needs.

    A width starts at the header's length plus a margin and grows to the longest
    value. All columns are measured in one pass.
    """
    longest = df.agg(
        *[F.max(F.length(F.col(f"`{n}`").cast("string"))).alias(f"w{i}") for i, n in enumerate(df.columns)]
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("ordinal"),
            F.lit(n.lower()).alias("column_name"),
            F.greatest(F.col(f"w{i}"), F.lit(len(n) + WIDTH_MARGIN)).alias("width"),
        )
        for i, n in enumerate(df.columns)
    ]
    return longest.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def staging_schema(profile: DataFrame) -> T.StructType:
    """Text columns of a staging table, each with its width as ``max_len``."""
    return T.StructType(
        [
            T.StructField(r.column_name, T.StringType(), True, {"max_len": int(r.width)})
            for r in profile.orderBy("ordinal").collect()
        ]
    )


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null or held by more than one row."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where(null_key | (F.col("copies") > 1)).withColumn(
        "problem", F.when(null_key, "null").otherwise("duplicate")
    )


def any_rows(df: DataFrame) -> bool:
    """Existence test; stops at the first row found."""
    return not df.isEmpty()


def exists_by(df: DataFrame, by: Sequence[str], condition: Column) -> DataFrame:
    """Existence test per group: does any row meet the condition."""
    return df.groupBy(*by).agg(F.bool_or(F.coalesce(condition, F.lit(False))).alias("found"))


def visit_counts(visits: DataFrame, page: str) -> DataFrame:
    """Visits per page; the same expression serves a batch and a stream."""
    return visits.groupBy(page).agg(F.count(F.lit(1)).alias("views"))
