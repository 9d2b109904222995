"""File and column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import WHITESPACE, col


def plain_path(encoded: Column | str) -> Column:
    """The path as listings spell it, of one that is written as a URI: ``_metadata.file_path``.

    Only ``%`` introduces a code in such a path; a plus sign is itself.
    """
    return F.url_decode(F.replace(col(encoded), F.lit("+"), F.lit("%2B")))


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def path_level(path: Column | str, level: int) -> Column:
    """The ``level``-th part of a path, counted from zero; null beyond the end."""
    return F.try_element_at(F.split(col(path), "/"), F.lit(level + 1))


def stem(path: Column | str) -> Column:
    """Base name up to its first dot."""
    return F.element_at(F.split(base_name(path), r"\."), 1)


def clean_file_name(name: Column | str, lower: bool = True) -> Column:
    """``CertifiedUsers - 03-29-2023.csv`` becomes ``certifiedusers.csv``.

    The text before the first dash is kept and stripped; a name that already ends
    in ``.csv`` is not given the suffix twice.
    """
    head = F.btrim(F.split_part(col(name), F.lit("-"), F.lit(1)), F.lit(WHITESPACE))
    bare = F.btrim(F.regexp_replace(head, r"(?i)\.csv$", ""), F.lit(WHITESPACE))
    return F.concat(F.lower(bare) if lower else bare, F.lit(".csv"))


def is_blank_name(clean: Column | str) -> Column:
    """True for what a folder marker cleans to."""
    return (F.length(col(clean)) == 0) | (col(clean) == ".csv")


def lower_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])
