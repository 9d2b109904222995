"""Run log: one committed record per source and day, the gate of the load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import workspace

RUN_SCHEMA = "file string, rows long, source string, load_date string"


class MarkerNotFound(RuntimeError):
    """The run that should have come first left no marker."""


def mark_run(
    spark: SparkSession, log: str, source: str, day: dt.date, files: dict[str, int]
) -> None:
    """Record a finished run; writing it again replaces the record."""
    rows = spark.createDataFrame(list(files.items()), "file string, rows long")
    path = f"{log}/source={source}/load_date={day:%Y%m%d}"
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def run_log(spark: SparkSession, log: str) -> DataFrame:
    """Every recorded run; empty before the first."""
    if not workspace.exists(spark, log):
        return spark.createDataFrame([], RUN_SCHEMA)
    return spark.read.schema(RUN_SCHEMA).parquet(log)


def has_run(spark: SparkSession, log: str, source: str, day: dt.date) -> bool:
    found = run_log(spark, log).where(
        (F.col("source") == source) & (F.col("load_date") == f"{day:%Y%m%d}")
    )
    return not found.isEmpty()


def require_run(spark: SparkSession, log: str, source: str, day: dt.date) -> None:
    """Stop unless the run of the day is recorded."""
    if not has_run(spark, log, source, day):
        raise MarkerNotFound(f"no run of {source} on {day:%Y-%m-%d}")


def require_samples(files: DataFrame) -> None:
    """Stop a set-up that has no sample file to learn its schema from; one file is read."""
    if not files.take(1):
        raise MarkerNotFound("no sample files")
