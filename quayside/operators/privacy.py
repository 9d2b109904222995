"""Personal data: column reports, masking and quarantine."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.patterns import CATEGORIES, ENTITIES, Entity, card_numbers, has_entity, may_hold

THRESHOLD = 0.1
REPORT_SCHEMA = (
    "column_name string, category string, entity string, matched bigint, non_null bigint, "
    "rate double, flagged boolean"
)


def entities_of(
    categories: str = CATEGORIES, custom: Mapping[str, str] | None = None
) -> list[Entity]:
    """Entities of a comma-separated list of categories, user patterns included."""
    wanted = [c.strip() for c in categories.split(",") if c.strip()]
    known = {e.category for e in ENTITIES} | {"custom"}
    unknown = [c for c in wanted if c not in known]
    if unknown:
        raise ValueError(f"unknown detection categories: {unknown}")
    chosen = [e for e in ENTITIES if e.category in wanted]
    if "custom" in wanted:
        chosen += [Entity(name, "custom", pattern) for name, pattern in (custom or {}).items()]
    return chosen


def scalar_columns(df: DataFrame) -> list[str]:
    """Columns that are looked at unless told: a card number may be stored as a number."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.BinaryType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]


def sampled(df: DataFrame, key: str, portion: float = 1.0) -> DataFrame:
    """Rows looked at by detection, chosen by a hash of the key: the same in every run.

    A row is in when the first 32 bits of the key's MD5 lie below the portion of their
    range; rows without a key are out of every true portion.
    """
    if portion >= 1.0:
        return df
    bits = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.where(bits < F.lit(int(portion * 2**32)))


def column_report(
    df: DataFrame,
    entities: Sequence[Entity],
    columns: Sequence[str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per column and entity: cells that match, cells with a value, their rate, the flag.

    All pairs are counted in one aggregate: one scan, one row per task shuffled. Cells in
    which all patterns together find nothing are not looked at entity by entity.
    """
    columns = list(columns) if columns is not None else scalar_columns(df)
    totals = [F.count(F.col(f"c{i}")).alias(f"n{i}") for i in range(len(columns))]
    hits, rows = [], []
    for i, column in enumerate(columns):
        cell = F.when(F.col(f"may{i}"), F.col(f"c{i}"))
        for j, entity in enumerate(entities):
            if entity.by_column_name:
                named = re.search(entity.pattern, column, re.IGNORECASE) is not None
                matched = F.col(f"n{i}") if named else F.lit(0).cast("long")
            else:
                hits.append(F.count_if(has_entity(cell, entity)).alias(f"m{i}_{j}"))
                matched = F.col(f"m{i}_{j}")
            rows.append(
                F.struct(
                    F.lit(column).alias("column_name"),
                    F.lit(entity.category).alias("category"),
                    F.lit(entity.name).alias("entity"),
                    matched.alias("matched"),
                    F.col(f"n{i}").alias("non_null"),
                )
            )
    if not rows:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    cells = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
    marked = cells.select("*", *[may_hold(F.col(f"c{i}"), entities).alias(f"may{i}") for i in range(len(columns))])
    counted = marked.agg(*totals, *hits)
    report = counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    rate = F.when(F.col("non_null") > 0, F.col("matched") / F.col("non_null")).otherwise(F.lit(0.0))
    return report.withColumn("rate", rate).withColumn(
        "flagged", (F.col("non_null") > 0) & (F.col("rate") >= threshold)
    )


def flagged_columns(report: DataFrame) -> list[str]:
    """Columns a report flags for any entity; at most the table's own columns."""
    found = report.where("flagged").select("column_name").distinct().orderBy("column_name")
    return [r.column_name for r in found.collect()]


def mask(text: Column, entities: Iterable[Entity]) -> Column:
    """Replace every matched span by the entity's tag, in the order given.

    Card numbers go by their Luhn test, the longest first; the other entities are
    plain replacements. A text in which all patterns together find nothing stays as it is.
    """
    masked, entities = text, list(entities)
    for entity in entities:
        if entity.by_column_name:
            continue
        if entity.luhn:
            masked = _mask_cards(masked, entity)
        else:
            replaced = F.regexp_replace(masked, entity.pattern, re.escape(entity.tag))
            if entity.needs:
                replaced = F.when(F.contains(masked, F.lit(entity.needs)), replaced).otherwise(masked)
            masked = replaced
    return F.when(may_hold(text, entities), masked).otherwise(text)


def _mask_cards(text: Column, entity: Entity) -> Column:
    sized = F.transform(
        F.array_distinct(card_numbers(text)), lambda c: F.struct(F.length(c).alias("n"), c.alias("c"))
    )
    longest_first = F.sort_array(sized, asc=False)
    return F.aggregate(
        longest_first, text, lambda done, card: F.replace(done, card["c"], F.lit(entity.tag))
    )


def mask_columns(df: DataFrame, columns: Sequence[str], entities: Sequence[Entity]) -> DataFrame:
    return df.withColumns({c: mask(F.col(f"`{c}`"), entities) for c in columns})


def hash_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace whole cells by their SHA-256; null stays null."""
    return df.withColumns(
        {c: F.sha2(F.col(f"`{c}`").cast("string").cast("binary"), 256) for c in columns}
    )


def holds_personal_data(columns: Sequence[str], entities: Sequence[Entity]) -> Column:
    """True when any listed column of the row holds any entity."""
    found = F.lit(False)
    for column in columns:
        cell, hit = F.col(f"`{column}`").cast("string"), F.lit(False)
        for entity in entities:
            if not entity.by_column_name:
                hit = hit | F.coalesce(has_entity(cell, entity), F.lit(False))
        found = found | F.when(may_hold(cell, entities), hit).otherwise(False)
    return found


def zoned(df: DataFrame, columns: Sequence[str], entities: Sequence[Entity]) -> DataFrame:
    """Mark each row ``quarantine`` or ``clean``."""
    hit = holds_personal_data(columns, entities)
    return df.withColumn("zone", F.when(hit, "quarantine").otherwise("clean"))


def write_zones(df: DataFrame, path: str) -> None:
    """Write both sides of a zoned frame in one pass, one folder per zone."""
    df.write.mode("overwrite").partitionBy("zone").parquet(path)
