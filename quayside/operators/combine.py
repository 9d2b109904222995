"""Projection by configuration and unions by name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Configured columns in configured order; one the data lacks is null."""
    return df.select(
        *[
            F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string").alias(name)
            for name in columns
        ]
    )


def cast_to_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Give the listed columns the text type; a missing one is added as null."""
    return df.withColumns(
        {
            name: (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast("string")
            for name in columns
        }
    )


def union_outer(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack by name: the columns of all frames, nulls where one lacks them, copies kept.

    A column whose type differs between frames gets the wider number type if all are
    numbers, and becomes text otherwise.
    """
    kinds: dict[str, dict[str, T.DataType]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            if field.dataType.typeName() != "void":
                kinds.setdefault(field.name, {})[field.dataType.simpleString()] = field.dataType
    mixed = {name: _common(list(found.values())) for name, found in kinds.items() if len(found) > 1}
    alike = [
        frame.withColumns({n: F.col(f"`{n}`").cast(mixed[n]) for n in frame.columns if n in mixed})
        for frame in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alike)


#: Digits that a value of an integer type may have.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
_MOST_DIGITS = 38


def _common(kinds: list[T.DataType]) -> str:
    """The type that holds all values of these types.

    Integers widen to ``bigint``, integers and decimals to a decimal with the digits of all before and
    behind the point, or to text where 38 digits do not hold them; with ``float`` or ``double`` numbers
    become ``double``, which rounds beyond 15 digits; the rest becomes text.
    """
    if all(isinstance(kind, T.IntegralType) for kind in kinds):
        return "bigint"
    if all(isinstance(kind, (T.IntegralType, T.DecimalType)) for kind in kinds):
        scale = max(kind.scale if isinstance(kind, T.DecimalType) else 0 for kind in kinds)
        whole = max(
            kind.precision - kind.scale if isinstance(kind, T.DecimalType) else _DIGITS[kind.simpleString()]
            for kind in kinds
        )
        return f"decimal({whole + scale},{scale})" if whole + scale <= _MOST_DIGITS else "string"
    return "double" if all(isinstance(kind, T.NumericType) for kind in kinds) else "string"


def union_strict(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames of one schema; a different name or type is an error."""
    first = dict(frames[0].dtypes)
    for at, frame in enumerate(frames[1:], start=2):
        other = dict(frame.dtypes)
        if other != first:
            differing = sorted(set(first.items()) ^ set(other.items()))
            raise ValueError(f"frame {at} does not match the first: {differing}")
    return reduce(lambda a, b: a.unionByName(b), frames)
