"""Driver tables and the frames derived from them that several plans share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.monitor import MTA_SOURCE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A session setting: how many partitions the texts of a table are dealt into before they are worked on. Unset, they
#: are read as they lie. It is for tables whose one row group is one task, such as a small table on many cores.
PARTITIONS = "quayside.partitions"


def spread(rows: DataFrame) -> DataFrame:
    """The rows, dealt into as many partitions as the session asks for, if it does."""
    partitions = rows.sparkSession.conf.get(PARTITIONS, None)
    return rows.repartition(int(partitions)) if partitions else rows


def event_k() -> Column:
    """The counter inside an event's ``props``."""
    return F.get_json_object("props", "$.k").try_cast("int")


EVENT_K = "try_cast(regexp_extract(props, '\"k\" *: *([0-9]+)', 1) AS INTEGER)"


def status_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh runs read from the event table."""
    k = event_k()
    info = F.when(k % 8 != 7, F.element_at(
        F.array(*[F.lit(x) for x in ("etlmonitor-daily", "etlmonitor-weekly", "etlmonitor-monthly", "")]),
        k % 4 + 1,
    ))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("customer"),
        F.when(F.col("event_type") == "purchase", MTA_SOURCE)
        .otherwise(F.col("event_type")).alias("source"),
        F.col("ts").alias("lrd"),
        F.when(F.col("value") < 100, "success").otherwise("failed").alias("status"),
        info.alias("info"),
        F.concat(F.lit("https://airflow.example/"), F.col("event_id").cast("string")).alias("airflow"),
        F.col("event_id").alias("run_id"),
    )


STATUS_SQL = f"""
runs AS (
  SELECT CAST(user_id AS VARCHAR) AS customer,
         CASE WHEN event_type = 'purchase' THEN 'MTA Build' ELSE event_type END AS source,
         ts AS lrd,
         CASE WHEN value < 100 THEN 'success' ELSE 'failed' END AS status,
         CASE WHEN k % 8 = 7 THEN NULL
              WHEN k % 4 = 0 THEN 'etlmonitor-daily'
              WHEN k % 4 = 1 THEN 'etlmonitor-weekly'
              WHEN k % 4 = 2 THEN 'etlmonitor-monthly'
              WHEN k % 4 = 3 THEN '' END AS info,
         'https://airflow.example/' || CAST(event_id AS VARCHAR) AS airflow,
         event_id AS run_id
  FROM (SELECT *, {EVENT_K} AS k FROM events)
),
status AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer, source
                                 ORDER BY lrd DESC NULLS LAST, run_id DESC NULLS LAST) AS rn
    FROM runs)
  WHERE rn = 1
)"""
