"""Landed API payloads: ``{"items": [...]}`` envelopes and bare arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.text import col
from quayside.sources.delimited import as_schema


def parse_json(c: Column | str, schema: str | T.StructType, mode: str = "PERMISSIVE") -> Column:
    """Parse JSON text; single-quoted text is accepted, broken text gives null or, by mode, an error."""
    return F.from_json(col(c), schema, {"allowSingleQuotes": "true", "mode": mode})


def _items_schema(items: str | T.StructType) -> T.StructType:
    return T.StructType([T.StructField("items", T.ArrayType(as_schema(items)))])


def items_of(
    df: DataFrame, payload: str, item_schema: str | T.StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """One row per item of a payload column; a payload without ``items`` gives no row.

    A payload that is broken or does not fit stops the read; ``PERMISSIVE`` gives nulls.
    """
    parsed = parse_json(payload, _items_schema(item_schema), mode)
    kept = [name for name in df.columns if name != payload]
    return df.select(*kept, F.explode(F.coalesce(parsed["items"], F.array())).alias("item")).select(
        *kept, "item.*"
    )


def read_items(
    spark: SparkSession,
    path: str | list[str],
    item_schema: str | T.StructType | None = None,
    multi_line: bool = False,
    limit: int | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Rows of ``items`` over all landed envelopes, read in one scan.

    A broken envelope or a value that does not fit stops the read, unless ``mode``
    is ``PERMISSIVE``.

    Without a schema one pass over the files infers it. ``limit`` mimics a single
    page request and is off by default: every item is read.
    """
    reader = spark.read.option("multiLine", multi_line).option("allowSingleQuotes", True)
    reader = reader.option("mode", mode)
    if item_schema is not None:
        reader = reader.schema(_items_schema(item_schema))
    envelopes = reader.json(path)
    kind = dict(zip(envelopes.columns, envelopes.schema.fields)).get("items")
    is_list = kind is not None and isinstance(kind.dataType, T.ArrayType)
    if not is_list or not isinstance(kind.dataType.elementType, T.StructType):
        return spark.createDataFrame([], T.StructType([]))
    rows = envelopes.select(F.explode("items").alias("item")).select("item.*")
    return rows if limit is None else rows.limit(limit)


def read_array(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    multi_line: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Rows of bare-array payloads; with ``multi_line`` off each line is one payload.

    ``mode`` is as in ``read_items``.
    """
    reader = spark.read.option("multiLine", multi_line).option("allowSingleQuotes", True)
    reader = reader.option("mode", mode)
    if schema is not None:
        reader = reader.schema(as_schema(schema))
    return reader.json(path)
