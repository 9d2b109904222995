"""Flatten nested payloads to plain columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.StructType, T.ArrayType, T.MapType)
#: Between the steps of a path while names and places must be told apart.
STEP = "\x01"


def _arrays(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def array_widths(df: DataFrame) -> DataFrame:
    """``(column_name, width)``: longest array of every list column, in one pass."""
    names = _arrays(df)
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, width int")
    widest = df.agg(
        *[F.coalesce(F.max(F.size(f"`{n}`")), F.lit(0)).alias(n) for n in names]
    )
    pairs = [
        F.struct(F.lit(n).alias("column_name"), F.greatest(F.col(f"`{n}`"), F.lit(0)).alias("width"))
        for n in names
    ]
    return widest.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def drop_nested(df: DataFrame) -> DataFrame:
    """Leave out every list, struct and map column."""
    return df.select(
        *[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, NESTED)]
    )


def list_widths(df: DataFrame) -> DataFrame:
    """``(path, width)``: the longest length of every list at every depth that is not always empty.

    Lists inside lists count for each place of the outer list: ``a``, ``a_0_b``, ``a_1_b``.
    All depths come from one aggregate over the data.
    """
    longest = _longest(df)
    return longest.select(F.replace("path", F.lit(STEP), F.lit("_")).alias("path"), "width")


def _longest(df: DataFrame) -> DataFrame:
    """The same with the steps of a path kept apart, so that ``a_0`` and the first of ``a`` are two paths."""
    none = F.array().cast("array<struct<path:string,width:int>>")
    lists = [_lists(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)) for f in df.schema.fields if _has_list(f.dataType)]
    found = df.select(F.explode(F.concat(none, *lists)).alias("l")).select("l.*")
    return found.groupBy("path").agg(F.max("width").alias("width"))


def _has_list(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_list(f.dataType) for f in kind.fields)
    return isinstance(kind, T.ArrayType)


def _lists(value: Column, kind: T.DataType, path: Column) -> Column:
    """Array of ``(path, width)`` for the lists in one value that hold something."""
    none = F.array().cast("array<struct<path:string,width:int>>")
    if isinstance(kind, T.StructType):
        inner = [_lists(value.getField(f.name), f.dataType, F.concat(path, F.lit(STEP + f.name)))
                 for f in kind.fields if _has_list(f.dataType)]
        return F.concat(none, *inner)
    here = F.when(F.size(value) > 0, F.array(F.struct(path.alias("path"), F.size(value).alias("width")))).otherwise(none)
    if not _has_list(kind.elementType):
        return here
    inner = F.transform(value, lambda x, i: _lists(x, kind.elementType, F.concat(path, F.lit(STEP), i.cast("string"))))
    return F.concat(here, F.coalesce(F.flatten(inner), none))


def flatten(df: DataFrame, max_columns: int = 4000, maps: Sequence[str] = ()) -> DataFrame:
    """Nested keys joined by ``_`` and list elements by index: ``a_0_b``.

    The widths of the lists of all depths come from one aggregate, so the data are read
    once for them and once for the result, however deep they are. Empty lists and empty
    objects give no column. Where two paths give one name, the later path that has a
    value wins, as text if their types differ.

    Lists named in ``maps`` (``a``, ``a_b`` for lists ``b`` in the elements of ``a``) stay one
    column each: a map from the rest of the path to the value as text. Lists that would make more
    than ``max_columns`` columns are an error that names the widest; nothing turns into a map by itself.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    widths: dict[str, int] = {}
    listed = [n for n, kind in kinds.items() if _has_list(kind) and n not in maps]
    if listed:
        found = _longest(df.select(*[F.col(f"`{n}`") for n in listed])).where(~_plain("path").isin(list(maps)))
        # No more rows than a table of max_columns can have lists.
        widths = {r.path: r.width for r in found.orderBy(F.desc("width"), "path").limit(max_columns + 1).collect()}
        if sum(widths.values()) - len(widths) > max_columns:
            widest = ", ".join(f"{p.replace(STEP, '_')} ({w})" for p, w in list(widths.items())[:3])
            raise ValueError(f"lists would make over {max_columns} columns, the widest: {widest}; name them in maps")
    parts: dict[str, list[tuple[Column, T.DataType]]] = {}
    for name, kind in kinds.items():
        for path, value, leaf in _leaves(F.col(f"`{name}`"), kind, (name,), widths, frozenset(maps)):
            parts.setdefault("_".join(path), []).append((value, leaf))
    if len(parts) > max_columns:
        raise ValueError(f"{len(parts)} columns are over {max_columns}; name lists in maps: {sorted(widths)[:3]}")
    return df.select(*[_merge(values).alias(name) for name, values in parts.items()])


def _plain(path: str) -> Column:
    """The path of a list without the places in lists above it, joined by ``_``."""
    return F.replace(F.regexp_replace(path, f"{STEP}[0-9]+(?={STEP}|$)", ""), F.lit(STEP), F.lit("_"))


def _leaves(
    value: Column, kind: T.DataType, path: tuple[str, ...], widths: dict[str, int], maps: frozenset[str], named: str = ""
) -> Iterator[tuple[tuple[str, ...], Column, T.DataType]]:
    """The columns that one value makes: path, value and type, in the order of the schema."""
    named = named or path[0]
    if isinstance(kind, T.StructType):
        for sub in kind.fields:
            yield from _leaves(value.getField(sub.name), sub.dataType, (*path, sub.name), widths, maps, f"{named}_{sub.name}")
    elif isinstance(kind, T.ArrayType) and named in maps:
        entries = _entries(value, kind, F.lit(""))
        cut = F.transform(entries, lambda e: F.struct(F.substring(e["path"], 2, 2**31 - 1), e["value"]))
        yield path, F.map_from_entries(cut), T.MapType(T.StringType(), T.StringType())
    elif isinstance(kind, T.ArrayType):
        for at in range(widths.get(STEP.join(path), 0)):
            yield from _leaves(F.get(value, F.lit(at)), kind.elementType, (*path, str(at)), widths, maps, named)
    else:
        yield path, value, kind


def _merge(values: list[tuple[Column, T.DataType]]) -> Column:
    if len(values) == 1:
        return values[0][0]
    same = all(kind == values[0][1] for _, kind in values)
    return F.coalesce(*[v if same else v.cast("string") for v, _ in reversed(values)])


def flatten_entries(df: DataFrame, keep: list[str]) -> DataFrame:
    """The same paths in long form: ``keep`` columns, then ``path`` and ``value``.

    Width is no limit here: each present value is a row of its own.
    """
    entries = [
        _entries(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name))
        for f in df.schema.fields
        if f.name not in keep
    ]
    rows = df.select(*keep, F.explode(F.concat(*entries)).alias("entry"))
    return rows.select(*keep, "entry.path", "entry.value")


def _entries(value: Column, kind: T.DataType, path: Column) -> Column:
    """Array of ``(path, value)`` for one value; empty when the value is absent."""
    empty = F.array().cast("array<struct<path:string,value:string>>")
    if isinstance(kind, T.StructType):
        found = [
            _entries(value.getField(s.name), s.dataType, F.concat(path, F.lit(f"_{s.name}")))
            for s in kind.fields
        ]
        return F.when(value.isNull() | F.lit(not found), empty).otherwise(F.concat(empty, *found))
    if isinstance(kind, T.ArrayType):
        inner = F.transform(
            value,
            lambda x, i: _entries(x, kind.elementType, F.concat(path, F.lit("_"), i.cast("string"))),
        )
        return F.coalesce(F.flatten(inner), empty)
    entry = F.struct(path.alias("path"), value.cast("string").alias("value"))
    return F.when(value.isNull(), empty).otherwise(F.array(entry))
