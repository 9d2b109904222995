"""Table scans, driver table lists and schema crawls."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import workspace
from quayside.functions.names import lower_headers
from quayside.sources.delimited import read_header_csv

CATALOG_SCHEMA = "table_name string, ordinal int, column_name string, data_type string"


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan one table over JDBC, split on a numeric column when bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in {"fetchsize": "10000", **(properties or {})}.items():
        reader = reader.option(key, value)
    if column is not None:
        if lower is None or upper is None:
            raise ValueError("a split scan needs both bounds")
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def read_table(spark: SparkSession, database: str, schema: str, table: str) -> DataFrame:
    """One catalog table, named the way a profiling job is given it."""
    parts = [part for part in (database, schema, table) if part]
    return spark.table(".".join(f"`{part}`" for part in parts))


def run_query(spark: SparkSession, query: str, **args) -> DataFrame:
    """Scan the result of a query; values are bound as named parameters."""
    return spark.sql(query, args=args or None)


#: What a script is cut by: quoted text and comments stay whole, a semicolon ends a statement.
_SCRIPT_PARTS = re.compile(r"""'(?:[^']|'')*'|"[^"]*"|`[^`]*`|(--[^\n]*|/\*.*?\*/)|(;)""", re.DOTALL)


def statements(script: str) -> list[str]:
    """The statements of a script without its comments; a lone comment has none."""
    plain = _SCRIPT_PARTS.sub(lambda m: " " if m[1] else "\0" if m[2] else m[0], script)
    return [part.strip() for part in plain.split("\0") if part.strip()]


def run_scripts(
    spark: SparkSession,
    scripts: Iterable[str],
    args: Mapping | None = None,
    folders: Mapping[str, str] | None = None,
) -> list[DataFrame]:
    """Run a customer's scripts one after another, e.g. load and then upsert.

    A script may hold several statements, or only a comment. ``{name}`` is replaced by
    the folder of that name before a statement runs; ``args`` are bound as values.
    """
    found = []
    for script in scripts:
        for name, folder in (folders or {}).items():
            script = script.replace("{" + name + "}", folder)
        found += [spark.sql(one, args=dict(args) if args else None) for one in statements(script)]
    return found


def table_list(spark: SparkSession, path: str) -> list[str]:
    """Work items of a header CSV with a ``tables`` column, in file order.

    The list names tables, so it is small by nature; blank names are skipped.
    """
    names = lower_headers(read_header_csv(spark, path)).select(F.trim("tables").alias("t"))
    return [row.t for row in names.collect() if row.t]


def _all_parts(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with the columns of all its parts: tasks read the footers, not the driver."""
    return spark.read.option("mergeSchema", True).parquet(path)


def crawl(
    spark: SparkSession,
    root: str,
    reader: Callable[[SparkSession, str], DataFrame] | None = None,
    tables: Iterable[str] | None = None,
    at_once: int = 8,
) -> DataFrame:
    """Catalog frame of every table below a folder, a few tables at a time.

    A column counts that any part of a table holds, in the order in which parts bring them. Parts
    that give a column different types stop the crawl.
    """
    paths = [f"{root}/{t}" for t in tables] if tables else workspace.children(spark, root)

    def columns(path: str) -> list[tuple]:
        name = path.rstrip("/").rsplit("/", 1)[1].split(".")[0]
        fields = (reader or _all_parts)(spark, path).schema.fields
        return [(name, at, field.name, field.dataType.simpleString()) for at, field in enumerate(fields, start=1)]

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        rows = [row for found in pool.map(columns, paths) for row in found]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def crawl_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added, removed or retyped since the last crawl; nothing is altered."""
    keys = ["table_name", "column_name"]
    old = before.select(*keys, F.col("data_type").alias("old_type"))
    new = after.select(*keys, F.col("data_type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    return (
        old.join(new, keys, "full_outer")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
    )
