"""Keyed tables: one row a key, in bucket folders of which a merge replaces only those it touches.

The table is partitioned by the bucket of the key and bucketed by the key itself, so that it joins
by key without being shuffled. A merge writes the touched buckets into a new folder and then points
their partitions there, one after another: a bucket is always its old or its new self, other
buckets stay the files they were, and a merge that was cut off is simply run again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import workspace

#: Two hashes of the key, and the number of its bucket.
FIRST, SECOND, BUCKET = "__key1", "__key2", "__bucket"
#: Enough for a bucket to fit into a task's memory; fixed once the table is there.
BUCKETS = 64
#: Folders of a bucket that are kept: the one that is read, and the one before it for readers that began earlier.
KEPT_LOADS = 2


class BucketsDiffer(ValueError):
    """The table was made with another number of buckets."""


@dataclass(frozen=True)
class KeyedTable:
    """A table of the catalogue with its folder, its key columns and the number of its buckets."""

    name: str
    root: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).drop(FIRST, SECOND, BUCKET)


def open_table(
    spark: SparkSession, name: str, schema: T.StructType, keys: Sequence[str], root: str, buckets: int = BUCKETS
) -> KeyedTable:
    """Create the table if the catalogue does not have it.

    A folder with finished loads is taken up: every bucket goes on from its newest one. The key
    columns may hold nulls; equal nulls are one key.
    """
    table = KeyedTable(name, root, tuple(keys), buckets)
    if spark.catalog.tableExists(name):
        told = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Num Buckets'").first()
        if told is None or int(told["data_type"]) != buckets:
            raise BucketsDiffer(f"{name} does not have {buckets} buckets")
        return table
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {FIRST} bigint, {SECOND} bigint, {BUCKET} int) USING parquet "
        f"PARTITIONED BY ({BUCKET}) CLUSTERED BY ({FIRST}, {SECOND}) INTO {buckets} BUCKETS LOCATION '{root}/empty'"
    )
    _point(spark, table, {bucket: paths[-1] for bucket, paths in _loads(spark, root).items()})
    return table


def _loads(spark: SparkSession, root: str) -> dict[int, list[str]]:
    """By bucket its folders in finished loads, oldest first."""
    done = {path.rsplit("/", 1)[0] for path in workspace.glob(spark, f"{root}/load=*/_SUCCESS")}
    found: dict[int, list[str]] = {}
    for path in workspace.glob(spark, f"{root}/load=*/{BUCKET}=*"):
        load, bucket = path.rsplit("/", 1)
        if load in done:
            found.setdefault(int(bucket.partition("=")[2]), []).append(path)
    return found


def _point(spark: SparkSession, table: KeyedTable, folders: dict[int, str]) -> None:
    there = {row["partition"] for row in spark.sql(f"SHOW PARTITIONS {table.name}").collect()}
    for bucket, folder in sorted(folders.items()):
        old = f"{BUCKET}={bucket}" in there
        change = f"PARTITION ({BUCKET} = {bucket}) SET" if old else f"ADD PARTITION ({BUCKET} = {bucket})"
        spark.sql(f"ALTER TABLE {table.name} {change} LOCATION '{folder}'")


def _hashed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows with the hashes of their key and the bucket in which the bucketed writer puts them."""
    parts = [F.struct(F.col(f"`{key}`").isNull(), F.col(f"`{key}`")) for key in keys]
    hashed = rows.withColumns({FIRST: F.xxhash64(*parts), SECOND: F.xxhash64(F.lit("second"), *parts)})
    return hashed.withColumn(BUCKET, F.pmod(F.hash(FIRST, SECOND), F.lit(buckets)))


def merged(
    spark: SparkSession,
    table: KeyedTable,
    fresh: DataFrame,
    touched: Sequence[int],
    wins: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    match_nulls: bool = True,
) -> DataFrame:
    """The touched buckets with ``fresh`` in them: ``fresh`` is dealt as the table lies, which does not move.

    ``fresh`` has one row a key. ``wins(old, new)`` says by the columns of both whether the new row
    replaces the old one; without it, it does. Unless nulls match, a row without a whole key replaces none.
    """
    columns = [name for name in table.rows(spark).columns]
    new = _hashed(fresh.select(*[f"`{name}`" for name in columns]), table.keys, table.buckets)
    whole = F.lit(True)
    for key in table.keys:
        whole = whole & F.col(f"`{key}`").isNotNull()
    meets = F.lit(True) if match_nulls else whole
    ids = [F.when(meets, F.col(name)).alias(f"{name}_of_new") for name in (FIRST, SECOND)]
    new = new.select(F.struct(*new.columns).alias("new"), *ids)
    dealt = new.repartition(table.buckets, f"{FIRST}_of_new", f"{SECOND}_of_new")
    old = spark.table(table.name).where(F.col(BUCKET).isin(list(touched)))
    old = old.select(F.struct(*[F.col(f"`{name}`") for name in old.columns]).alias("old"), FIRST, SECOND)
    joined = old.join(
        dealt.hint("merge"), (F.col(FIRST) == F.col(f"{FIRST}_of_new")) & (F.col(SECOND) == F.col(f"{SECOND}_of_new")), "full_outer"
    )
    replaced = F.col("new").isNotNull()
    if wins is not None:
        replaced = replaced & (F.col("old").isNull() | wins(lambda name: F.col("old")[name], lambda name: F.col("new")[name]))
    return joined.select(F.when(replaced, F.col("new")).otherwise(F.col("old")).alias("row")).select(
        *[F.col("row")[name].alias(name) for name in (*columns, FIRST, SECOND, BUCKET)]
    )


def merge(
    table: KeyedTable,
    fresh: DataFrame,
    wins: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    match_nulls: bool = True,
) -> list[int]:
    """Put the rows of ``fresh`` into the table; returns the buckets that were rewritten.

    ``fresh`` is read once: it is written to the scratch folder first. See ``merged`` for who wins.
    """
    spark = fresh.sparkSession
    folder = workspace.scratch(spark, "fresh")
    fresh.write.parquet(folder)
    fresh = spark.read.schema(fresh.schema).parquet(folder)
    found = _hashed(fresh, table.keys, table.buckets).select(BUCKET).distinct().collect()
    touched = sorted(row[BUCKET] for row in found)
    if touched:
        # Names sort by time, and a load counts once it is whole.
        load = f"load={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        writer = f"{table.name}_{load[-8:]}"
        rows = merged(spark, table, fresh, touched, wins, match_nulls)
        rows.write.partitionBy(BUCKET).bucketBy(table.buckets, FIRST, SECOND).option(
            "path", f"{table.root}/{load}"
        ).saveAsTable(writer)
        spark.sql(f"DROP TABLE {writer}")
        _point(spark, table, {bucket: f"{table.root}/{load}/{BUCKET}={bucket}" for bucket in touched})
        loads = _loads(spark, table.root)
        for bucket in touched:
            for old in loads[bucket][:-KEPT_LOADS]:
                workspace.delete(spark, old)
    workspace.delete(spark, folder)
    return touched


def detached(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """Drop the table from the catalogue and return its rows, read from the folders that hold them."""
    schema = spark.table(table.name).drop(BUCKET).schema
    spark.sql(f"DROP TABLE {table.name}")
    folders = [paths[-1] for paths in _loads(spark, table.root).values()]
    if not folders:
        return spark.createDataFrame([], schema).drop(FIRST, SECOND)
    return spark.read.schema(schema).parquet(*folders).drop(FIRST, SECOND)
