"""Clickstream files: external JSON table, hourly folders and raw records."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import workspace
from quayside.config import CLICKSTREAM_SCHEMA, RECORD_SCHEMA
from quayside.functions.text import encode_base64
from quayside.sources.delimited import as_schema

#: Folder of an hour below the root of a table: as plain names, or as ``deliver`` and ``deliver_hive`` write them.
HOUR_FORMAT = "%Y/%m/%d/%H"
DELIVERED = "result=Ok/year=%Y/month=%m/day=%d/hour=%H"
HIVE = "result=Ok/datehour=%Y-%m-%d-%H"
CHECKS_AT_ONCE = 16


def read_json_table(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType = CLICKSTREAM_SCHEMA,
    mode: str = "FAILFAST",
) -> DataFrame:
    """JSON lines projected on the declared columns; other keys are not kept.

    A line that does not fit stops the read; ``mode="PERMISSIVE"`` keeps it as nulls.
    """
    return spark.read.schema(as_schema(schema)).option("mode", mode).json(path)


def hours_between(start: dt.datetime, end: dt.datetime | None = None) -> list[str]:
    """Hour folders from ``start`` to ``end``, both included; without an end, to now in UTC."""
    end = end or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    hour = start.replace(minute=0, second=0, microsecond=0)
    found = []
    while hour <= end:
        found.append(hour.strftime(HOUR_FORMAT))
        hour += dt.timedelta(hours=1)
    return found


def hour_paths(
    spark: SparkSession,
    root: str,
    start: dt.datetime,
    end: dt.datetime | None = None,
    layout: str = HOUR_FORMAT,
) -> list[str]:
    """Existing folders of a range: a day that is wanted whole is one folder, if the layout has day folders.

    The paths are computed from the range and the layout, and each is looked up; nothing is listed.
    """
    days: dict[str, list[dt.datetime]] = {}
    for hour in hours_between(start, end):
        moment = dt.datetime.strptime(hour, HOUR_FORMAT)
        days.setdefault(hour[:10], []).append(moment)
    above = layout.rsplit("/", 1)[0]
    wanted = []
    for hours in days.values():
        whole = len(hours) == 24 and "%d" in above
        wanted += [hours[0].strftime(above)] if whole else [hour.strftime(layout) for hour in hours]
    paths = [f"{root}/{path}" for path in wanted]
    with ThreadPoolExecutor(max_workers=CHECKS_AT_ONCE) as pool:
        there = pool.map(lambda path: workspace.exists(spark, path), paths)
        return [path for path, found in zip(paths, there) if found]


def hour_of(path: Column, layout: str = HOUR_FORMAT) -> Column:
    """``yyyy/MM/dd/HH`` out of the path of a file, whatever folders the layout makes of it."""
    folder = layout.replace("%Y", "([0-9]{4})")
    for part in ("%m", "%d", "%H"):
        folder = folder.replace(part, "([0-9]{2})")
    return F.regexp_replace(path, f"^.*/{folder}/.*$", "$1/$2/$3/$4")


def read_hours(
    spark: SparkSession,
    root: str,
    start: dt.datetime,
    end: dt.datetime | None = None,
    schema: str | T.StructType = CLICKSTREAM_SCHEMA,
    mode: str = "FAILFAST",
    layout: str = HOUR_FORMAT,
) -> DataFrame:
    """Rows of the hours in range with their ``datehour``, reading only those folders.

    A line that does not fit stops the read; ``mode="PERMISSIVE"`` keeps it as nulls.
    """
    schema = as_schema(schema)
    paths = hour_paths(spark, root, start, end, layout)
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("datehour", F.lit(None).cast("string"))
    rows = (
        spark.read.schema(schema)
        .option("mode", mode)
        .option("recursiveFileLookup", True)
        .json(paths)
    )
    return rows.select("*", hour_of(F.col("_metadata.file_path"), layout).alias("datehour"))


def hour_table(
    spark: SparkSession,
    root: str,
    schema: str | T.StructType = CLICKSTREAM_SCHEMA,
    mode: str = "FAILFAST",
    layout: str = HOUR_FORMAT,
) -> DataFrame:
    """All hours of a tree as one table with its ``datehour`` (``yyyy/MM/dd/HH``), which prunes.

    The hour is worked out of each file's path, so a plain filter on it is settled
    before any file is opened: only files of wanted hours are read, however the filter is
    said. Folders that are no hours of this layout are left out.
    """
    rows = (
        spark.read.schema(as_schema(schema))
        .option("mode", mode)
        .option("recursiveFileLookup", True)
        .json(root)
    )
    path = F.col("_metadata.file_path")
    hour = hour_of(path, layout)
    return rows.where(hour != path).select("*", hour.alias("datehour"))


def read_hive_hours(
    spark: SparkSession,
    root: str,
    start: dt.datetime,
    end: dt.datetime | None = None,
    schema: str | T.StructType = CLICKSTREAM_SCHEMA,
    mode: str = "FAILFAST",
) -> DataFrame:
    """The same range over the ``datehour=`` folders of ``deliver_hive``."""
    return read_hours(spark, root, start, end, schema, mode, HIVE)


def to_records(bodies: DataFrame, record_id: str, body: str, arrival: str) -> DataFrame:
    """Request bodies as delivery records: the body in base64 with its id and arrival.

    Takes a batch or a stream, such as the ``key``, ``value`` and ``timestamp`` of a
    message source.
    """
    return bodies.select(
        F.col(record_id).cast("string").alias("recordId"),
        encode_base64(F.col(body).cast("string")).alias("data"),
        F.col(arrival).cast("timestamp_ntz").alias("arrival_ts"),
    )


def stream_records(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """Stream of base64 records; ``max_bytes`` caps one micro-batch."""
    reader = spark.readStream.schema(as_schema(RECORD_SCHEMA))
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)
