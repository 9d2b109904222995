"""Landed files against a list of required files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.names import base_name, clean_file_name, is_blank_name


def present_files(
    listing: DataFrame, path: str = "path", by: Sequence[str] = (), lower: bool = True
) -> DataFrame:
    """Cleaned file names of a listing; a folder marker names no file and is null."""
    named = listing.select(*by, clean_file_name(base_name(path), lower).alias("file"))
    return named.withColumn("file", F.when(~is_blank_name("file"), F.col("file")))


def only_required(df: DataFrame, required: Sequence[str], column: str = "file") -> DataFrame:
    """Rows whose file is on the list."""
    return df.where(F.col(column).isin(list(required)))


def manifest_report(
    present: DataFrame, required: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Per delivery and file: how often it is present and how often required.

    The listing is counted by name first, so a delivery or a name that floods it
    shrinks to one row per task before the shuffle. The deliveries are taken from
    those counts, each gets the required names, and both sides are added up; the
    listing is read once. A delivery of nothing but folder markers misses every file.
    """
    by = list(by)
    counted = present.groupBy(*by, "file").agg(F.count(F.lit(1)).alias("present"))
    if by:
        deliveries = counted.groupBy(*by).agg(F.max("present").alias("most")).where("most > 0")
    else:
        deliveries = present.sparkSession.range(1)
    expected = F.explode(F.array(*[F.lit(name) for name in required])).alias("file")
    wanted = deliveries.select(*by, expected, F.lit(0).cast("bigint").alias("present"))
    # Both branches use the count, so both keep the one counted shuffle.
    named = counted.where(F.when(F.col("file").isNotNull(), F.col("present")) > 0)
    stacked = named.withColumn("required", F.lit(0)).unionByName(
        wanted.withColumn("required", F.lit(1))
    )
    counted = stacked.groupBy(*by, "file").agg(
        F.sum("present").alias("present"), F.sum("required").alias("required")
    )
    state = (
        F.when(F.col("present") == F.col("required"), "ok")
        .when(F.col("present") < F.col("required"), "missing")
        .when(F.col("required") == 0, "extra")
        .otherwise("repeated")
    )
    return counted.withColumn("state", state)


def complete_exactly(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Complete when the present names are exactly the required ones, each as often."""
    return report.groupBy(*by).agg(
        F.count_if(F.col("state") == "missing").alias("missing"),
        F.count_if(F.col("state") == "extra").alias("extra"),
        F.count_if(F.col("state") == "repeated").alias("repeated"),
        F.every(F.col("state") == "ok").alias("complete"),
    )


def complete_at_least(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Complete when every required name is present; more files are allowed."""
    return report.groupBy(*by).agg(
        F.count_if(F.col("state") == "missing").alias("missing"),
        F.every(F.col("state") != "missing").alias("complete"),
    )
