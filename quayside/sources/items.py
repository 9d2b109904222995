"""Key-value exports: items written as ``{attribute: {type tag: value}}``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import as_boolean

ITEM_TYPE = "map<string,map<string,string>>"


def read_items_export(
    spark: SparkSession, path: str | list[str], attributes: Mapping[str, str], mode: str = "FAILFAST"
) -> DataFrame:
    """Typed columns for the declared attributes; a missing attribute is null."""
    return typed_items(spark.read.text(path), "value", attributes, mode)


def typed_items(
    df: DataFrame, item: str, attributes: Mapping[str, str], mode: str = "FAILFAST"
) -> DataFrame:
    """Take each attribute's only tagged value and give it the declared type.

    A value tagged ``NULL`` is null. An item that is not JSON, or a value that does
    not fit its type, stops the read; ``PERMISSIVE`` makes it null.
    """
    parsed = df.select(F.from_json(F.col(item), ITEM_TYPE, {"mode": mode}).alias("item"))
    columns = []
    for name, kind in attributes.items():
        tagged = F.col("item")[name]
        text = F.when(F.map_keys(tagged)[0] != "NULL", F.map_values(tagged)[0])
        value = as_boolean(text) if kind == "boolean" else text.try_cast(kind)
        if mode == "FAILFAST":
            unfit = F.concat(F.lit(f"{name} is not a {kind}: "), text)
            failed = F.raise_error(unfit).cast(kind)
            value = F.when(text.isNotNull() & value.isNull(), failed).otherwise(value)
        columns.append(value.alias(name))
    return parsed.select(*columns)


def tagged_item(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Write rows as tagged JSON items; a null attribute is left out of the item."""
    attributes = [
        F.when(
            F.col(name).isNotNull(), F.struct(F.col(name).cast("string").alias(tag))
        ).alias(name)
        for name, tag in tags.items()
    ]
    return df.select(F.to_json(F.struct(*attributes)).alias("value"))
