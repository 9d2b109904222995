"""Delimited text: header CSV, typed CSV, BEL-delimited gzip and mapped imports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEL = "\u0007"


def _reader(spark: SparkSession, sep: str, multi_line: bool, mode: str):
    """CSV reader. Cells are counted against the header, so every column is parsed."""
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", mode)
        .option("columnPruning", False)
    )


def as_schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_header_csv(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    multi_line: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Every column as text, named by the header line; blank cells are null.

    Quoted cells may hold line breaks, for which a file is read by one task; with
    ``multi_line`` off large files are split. ``mode`` decides on rows with too many
    or too few cells: ``FAILFAST`` stops, ``PERMISSIVE`` cuts them or fills them with
    nulls. A part whose header differs from the first one's stops the read.
    """
    return _reader(spark, sep, multi_line, mode).option("enforceSchema", False).csv(path)


def read_typed_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    sep: str = ",",
    mode: str = "FAILFAST",
    multi_line: bool = True,
) -> DataFrame:
    """Load with a declared schema by position, skipping the header line.

    Quoted cells may hold line breaks, as in the bulk load, unless ``multi_line`` is off.
    ``mode`` decides on rows that do not fit: ``FAILFAST`` stops the load,
    ``PERMISSIVE`` keeps them with nulls, ``DROPMALFORMED`` leaves them out.
    """
    return (
        _reader(spark, sep, multi_line, mode)
        .schema(as_schema(schema))
        .option("enforceSchema", True)
        .csv(path)
    )


def read_bel_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """BEL-delimited, quoted, gzip by extension; an explicit column list names the fields.

    A gzip part is read by one task in any case, so line breaks inside quotes are
    always honoured here. A row with an extra or a missing cell stops the load.
    """
    reader = _reader(spark, BEL, True, mode)
    if columns:
        schema = T.StructType([T.StructField(name.lower(), T.StringType()) for name in columns])
        reader = reader.schema(schema).option("enforceSchema", True)
    return reader.csv(path)


def import_mapped_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    mapping: Mapping[str, str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Bring a header CSV into a declared table: match by lower-cased name, then cast.

    ``mapping`` gives the header name of a table column where the two differ.
    A value that does not fit its type, or a cell too many, stops the import.
    """
    raw = read_header_csv(spark, path, multi_line=multi_line)
    by_name = {name.lower(): name for name in raw.columns}
    wanted = {k.lower(): v.lower() for k, v in (mapping or {}).items()}
    fields = []
    for field in as_schema(schema).fields:
        header = by_name[wanted.get(field.name.lower(), field.name.lower())]
        fields.append(_strict_cast(F.col(f"`{header}`"), field.dataType).alias(field.name))
    return raw.select(*fields)


def _strict_cast(text, kind: T.DataType):
    if isinstance(kind, T.StringType):
        return text
    value = text.try_cast(kind)
    unfit = F.concat(F.lit(f"not a {kind.simpleString()}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(unfit).cast(kind)).otherwise(value)
