"""Clickstream: base64 records to hour folders and back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import workspace
from quayside.plans.tables import EVENT_K, event_k, table
from quayside.sources.clickstream import (
    DELIVERED, hour_table, read_hive_hours, read_hours, read_json_table, stream_records, to_records,
)
from quayside.streaming.clickstream import (
    deliver,
    deliver_hive,
    transform_records,
)

FIRST = dt.datetime(2024, 1, 1, 0)
LAST = dt.datetime(2024, 1, 31, 23)
RANGE = (dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 10, 11))


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the JSON text that its page sends."""
    body = F.to_json(
        F.struct(
            F.col("event_type").alias("element_clicked"),
            F.col("value").cast("int").alias("time_spent"),
            F.concat(F.lit("menu"), event_k().cast("string")).alias("source_menu"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
            F.col("user_id").alias("not_in_the_table"),
        )
    )
    return table(spark, sf_dir, "events").withColumn("body", body)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a base64 record with its arrival time."""
    return to_records(_bodies(spark, sf_dir), "event_id", "body", "ts")


def _stream(spark: SparkSession, sf_dir: str, root: str, max_bytes: int | None = None) -> DataFrame:
    _records(spark, sf_dir).write.json(f"{root}/records")
    return stream_records(spark, f"{root}/records", max_bytes)


def record_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_records(_records(spark, sf_dir)).select("recordId", "result", "data")


def clickstream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records streamed to hour folders, read back and counted by hour."""
    root = workspace.scratch(spark, "clickstream")
    deliver(_stream(spark, sf_dir, root), f"{root}/hours", f"{root}/checkpoint", interval=None)
    rows = read_hours(spark, f"{root}/hours", FIRST, LAST, layout=DELIVERED)
    return rows.groupBy("datehour").agg(
        F.count(F.lit(1)).alias("records"), F.sum("time_spent").alias("time_spent")
    )


def clickstream_hour_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six hours of the hour folders, every column."""
    root = workspace.scratch(spark, "clickstream")
    deliver(_stream(spark, sf_dir, root), f"{root}/hours", f"{root}/checkpoint", interval=None)
    return read_hours(spark, f"{root}/hours", *RANGE, layout=DELIVERED).select("*")


def clickstream_hive_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same six hours through partition folders, the whole backlog in one delivery."""
    root = workspace.scratch(spark, "clickstream-hive")
    stream = _stream(spark, sf_dir, root)
    deliver_hive(stream, f"{root}/hours", f"{root}/checkpoint", interval=None)
    return read_hive_hours(spark, f"{root}/hours", *RANGE)


def clickstream_where_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hour folders as a table, queried with a plain ``WHERE`` on the hour."""
    root = workspace.scratch(spark, "clickstream-where")
    deliver(_stream(spark, sf_dir, root), f"{root}/hours", f"{root}/checkpoint", interval=None)
    hour_table(spark, f"{root}/hours", layout=DELIVERED).createOrReplaceTempView("click_hours")
    return spark.sql("SELECT * FROM click_hours WHERE datehour BETWEEN '2024/01/10/06' AND '2024/01/10/11'")


def clickstream_json_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as JSON lines, read back on the declared columns."""
    path = f"{workspace.scratch(spark, 'clickstream-json')}/lines"
    _bodies(spark, sf_dir).select("body").write.text(path)
    return read_json_table(spark, path)


QUERIES = {
    "record_transform": record_transform,
    "clickstream_json_table": clickstream_json_table,
    "clickstream_hourly": clickstream_hourly,
    "clickstream_hour_range": clickstream_hour_range,
    "clickstream_hive_range": clickstream_hive_range,
    "clickstream_where_range": clickstream_where_range,
}

_CLICKS = f"""
SELECT event_type AS element_clicked, CAST(trunc(value) AS INTEGER) AS time_spent,
       'menu' || CAST({EVENT_K} AS VARCHAR) AS source_menu,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at, strftime(ts, '%Y/%m/%d/%H') AS datehour
FROM events"""
_SIX_HOURS = f"""
SELECT * FROM ({_CLICKS}) WHERE datehour BETWEEN '2024/01/10/06' AND '2024/01/10/11'"""
_BODY = rf"""
'{{' || concat_ws(',',
  '"element_clicked":"' || replace(replace(event_type, '\', '\\'), '"', '\"') || '"',
  '"time_spent":' || CAST(CAST(trunc(value) AS INTEGER) AS VARCHAR),
  '"source_menu":"menu' || CAST({EVENT_K} AS VARCHAR) || '"',
  '"created_at":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"',
  '"not_in_the_table":' || CAST(user_id AS VARCHAR)) || '}}'"""

ORACLE = {
    "record_transform": f"""
SELECT CAST(event_id AS VARCHAR) AS "recordId", 'Ok' AS result,
       base64(encode({_BODY} || chr(10))) AS data
FROM events""",
    "clickstream_json_table": f"SELECT * EXCLUDE (datehour) FROM ({_CLICKS})",
    "clickstream_hourly": f"""
SELECT datehour, count(*) AS records, CAST(sum(time_spent) AS BIGINT) AS time_spent
FROM ({_CLICKS}) WHERE datehour BETWEEN '2024/01/01/00' AND '2024/01/31/23' GROUP BY datehour""",
    "clickstream_hour_range": _SIX_HOURS,
    "clickstream_hive_range": _SIX_HOURS,
    "clickstream_where_range": _SIX_HOURS,
}
