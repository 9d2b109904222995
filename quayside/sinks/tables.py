"""Warehouse tables: create, refresh, publish and export."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayside import workspace

EXPORTS_AT_ONCE = 5
#: What the folders of full loads begin with; their names sort by time.
LOAD = "load="


def staging_table_name(schema: str, source: str, file_stem: str) -> str:
    return f"{schema}.{source}_{file_stem}" if schema else f"{source}_{file_stem}"


def create_table_if_absent(
    spark: SparkSession, name: str, schema: T.StructType, location: str
) -> bool:
    """Create a Parquet table at a shared location; an existing one is left alone."""
    if spark.catalog.tableExists(name):
        return False
    spark.catalog.createTable(name, path=location, source="parquet", schema=schema)
    return True


def location_of(spark: SparkSession, name: str) -> str:
    """The folder that a table of the catalogue reads."""
    told = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()
    return told["data_type"].rstrip("/")


def refresh_table(df: DataFrame, name: str) -> None:
    """Replace all rows of a table, columns matched by name.

    The rows are written to a folder beside the one that is read, and the table is then pointed
    there: a load that fails half-way leaves the old rows, and a reader sees the old or the new
    ones. The folder before stays for readers that have begun; older ones go. Types are reconciled as by an
    insert: a value that does not fit stops the load. Partitioned tables keep a folder for each partition and are refused.
    """
    spark = df.sparkSession
    table = spark.table(name)
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        raise ValueError(f"{name} is partitioned")
    absent = [column for column in table.columns if column not in df.columns]
    if absent:
        raise ValueError(f"no {', '.join(absent)} for {name}")
    before, folder = location_of(spark, name).rsplit("/", 1)
    base = before if folder.startswith(LOAD) else f"{before}/{folder}-loads"
    path = f"{base}/{LOAD}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        df.to(table.schema).write.parquet(path)
    except BaseException:
        workspace.delete(spark, path)
        raise
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    for old in workspace.glob(spark, f"{base}/{LOAD}*"):
        if folder.startswith(LOAD) and old.rsplit("/", 1)[1] < folder:
            workspace.delete(spark, old)


def version_path(root: str, number: int) -> str:
    return f"{root}/version={number:08d}"


def versions(spark: SparkSession, root: str) -> list[str]:
    """Committed versions below a folder, oldest first."""
    found = workspace.glob(spark, f"{root}/version=*/_SUCCESS")
    return sorted(path.rsplit("/", 1)[0] for path in found)


def publish(df: DataFrame, root: str) -> str:
    """Write a new version beside the one that may be read meanwhile.

    A version counts once its ``_SUCCESS`` marker is there, so readers move over
    in one step and a lost attempt is simply written again.
    """
    done = versions(df.sparkSession, root)
    number = int(done[-1].rsplit("version=", 1)[1]) + 1 if done else 1
    path = version_path(root, number)
    df.write.mode("overwrite").parquet(path)
    return path


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed version."""
    done = versions(spark, root)
    if not done:
        raise FileNotFoundError(f"nothing published below {root}")
    return spark.read.parquet(done[-1])


def export_tables(
    spark: SparkSession,
    tables: Sequence[str],
    read: Callable[[str], DataFrame],
    out: str,
    at_once: int = EXPORTS_AT_ONCE,
) -> dict[str, str]:
    """Snapshot each listed table to Parquet, a few Spark jobs at a time."""

    def export(name: str) -> str:
        path = f"{out}/{name}"
        read(name).write.mode("overwrite").parquet(path)
        return path

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return dict(zip(tables, pool.map(export, tables)))
