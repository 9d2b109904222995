"""Dated Parquet and delimited gzip output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import number_text
from quayside.sources.delimited import BEL

# A gzip part is read back by a single task, so parts are kept to this many rows.
ROWS_PER_GZIP = 2_000_000


def write_dated_parquet(df: DataFrame, out: str, day: dt.date) -> str:
    """Write below ``out/yyyy-MM-dd``; a rerun of the day replaces it."""
    path = f"{out}/{day:%Y-%m-%d}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    compression: str | None = None,
    rows_per_file: int = 0,
    partition_by: str | None = None,
) -> str:
    """Header CSV as a folder of parts; null and empty cells are both written empty."""
    text = df.select(
        *[
            (number_text(f"`{c}`") if kind == "double" else F.col(f"`{c}`").cast("string")).alias(c)
            for c, kind in df.dtypes
        ]
    )
    writer = (
        text.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
    )
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)
    return path


def write_bel_gzip(
    df: DataFrame, folder: str, day: dt.date, name: str, rows_per_file: int = ROWS_PER_GZIP
) -> str:
    """BEL-delimited gzip with header at ``{folder}{yyyyMMdd}/{name}.csv.gz``, all columns.

    The result is a folder of parts, each with the header, so loading stays
    parallel although gzip cannot be split.
    """
    return write_csv(df, f"{folder}{day:%Y%m%d}/{name}.csv.gz", BEL, "gzip", rows_per_file)
