"""Clean-up applied while staged text is loaded."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.text import replace_invalid, trim_blanks, truncate
from quayside.functions.times import parse_twelve_hour


def clean_for_load(
    df: DataFrame,
    schema: T.StructType,
    timestamps: Iterable[str] = (),
    width_mode: str = "chars",
) -> DataFrame:
    """Replace invalid characters, trim trailing blanks, cut to width, parse times.

    Widths are the ``max_len`` metadata of the schema; ``timestamps`` names the
    columns holding 12-hour times.
    """
    parsed = set(timestamps)
    columns = []
    for field in schema.fields:
        text = trim_blanks(replace_invalid(F.col(f"`{field.name}`")))
        if field.name in parsed:
            columns.append(parse_twelve_hour(text).alias(field.name))
            continue
        if "max_len" in field.metadata:
            text = truncate(text, field.metadata["max_len"], width_mode)
        columns.append(text.alias(field.name, metadata=dict(field.metadata)))
    return df.select(*columns)
