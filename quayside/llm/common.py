"""Helpers the operators of this folder share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import workspace

#: The white space of every operator here: space and the controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, rows: DataFrame, label: str, folders: list[str] | None = None) -> DataFrame:
    """The rows, written to the shared scratch folder and read from there; the folder joins ``folders``."""
    folder = workspace.scratch(spark, label)
    rows.write.parquet(folder)
    if folders is not None:
        folders.append(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def freed(spark: SparkSession, folders: list[str]) -> None:
    """Delete staged folders once all that was made of them is written."""
    while folders:
        workspace.delete(spark, folders.pop())


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other letter left alone."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fingerprint(*parts: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; together a key that two different values do not share."""
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)


def hash_bound(most: int, total: int) -> int:
    """The largest 64-bit hash of a sample of about ``most`` of ``total`` rows, whatever their number."""
    return min((most << 64) // max(total, 1), (1 << 64) - 1) - (1 << 63)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of the named columns in which null equals null."""
    found = F.lit(True)
    for name in names:
        found = found & left[name].eqNullSafe(right[name])
    return found
