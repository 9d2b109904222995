"""Scalar functions over whole table columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import names, text, times
from quayside.operators.manifest import only_required
from quayside.plans.tables import table
from quayside.sources.landing import with_prefix_suffix

AS_OF = dt.date(2024, 1, 31)


def scalar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names taken apart and cleaned, labels, lower-cased headers."""
    doc = F.col("doc_id").cast("string")
    listed = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("Doc_ID"),
        F.concat(F.lit("in/"), "lang", F.lit("/"), F.upper("source"), F.lit(" - "), doc, F.lit(".part.csv")).alias("Path"),
    )
    listed = names.lower_headers(listed)
    base = names.base_name("path")
    return listed.select(
        "doc_id",
        base.alias("base"),
        names.path_level("path", 1).alias("level_1"),
        names.path_level("path", 7).alias("level_7"),
        names.stem("path").alias("stem"),
        names.clean_file_name(base).alias("clean_lower"),
        names.clean_file_name(base, lower=False).alias("clean"),
        text.label(F.concat(F.lit("load_"), "path")).alias("label"),
    )


def scalar_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date folders, 12-hour parsing, day arithmetic, minute rounding."""
    clock = F.date_format("ts", times.TWELVE_HOUR)
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.day_folder("ts").alias("day_folder"),
        times.dashed_day("ts").alias("dashed_day"),
        times.hour_folder("ts").alias("hour_folder"),
        times.parse_twelve_hour(clock).alias("parsed"),
        times.round_to_minute("ts").alias("rounded"),
        times.round_to_minute(F.date_trunc("minute", "ts").cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(30))).alias("tie"),
        (F.col("ts") <= times.days_before(AS_OF, 7)).alias("week_old"),
    )


def scalar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimming, cutting, replacing, null tests, templates, links, coercion."""
    documents = table(spark, sf_dir, "documents")
    body = F.concat("text", F.lit("�  "))
    return documents.select(
        "doc_id",
        text.trim_blanks(body).alias("trimmed"),
        text.replace_invalid(F.concat("source", F.lit("�"))).alias("replaced"),
        text.truncate("text", 12).alias("cut"),
        text.truncate("text", 12, "bytes").alias("cut_bytes"),
        text.blank(F.when(F.col("doc_id") % 3 > 0, F.substring("source", 1, F.col("doc_id") % 3 - 1))).alias("blank"),
        text.fill_template(
            "{lang}:{source}:{lang}:{other}", {"lang": F.col("lang"), "source": F.col("source")}
        ).alias("filled"),
        text.hyperlink(F.concat(F.lit("https://x.example/?a=1&b="), "source")).alias("link"),
        text.as_boolean(F.element_at(F.array(*[F.lit(w) for w in ("False", "true", "0", "yes", "x")]), F.col("doc_id").cast("int") % 5 + 1)).alias("active"),
        text.as_text("n_chars").alias("n_chars"),
    )


def scalar_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base64 both ways over whole texts, with the newline a record gets."""
    turns = table(spark, sf_dir, "conversations")
    encoded = text.encode_base64(text.with_newline("text"))
    return turns.select(
        "conv_id", "turn", encoded.alias("encoded"), text.decode_base64(encoded).alias("decoded")
    )


def required_and_prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose file is required and lies below a prefix."""
    listed = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("in/"), "lang", F.lit("/"), "source", F.lit(".csv")).alias("path"),
    )
    below = with_prefix_suffix(listed, "path", "in/en/", ".csv")
    named = below.withColumn("file", names.clean_file_name(names.base_name("path")))
    return only_required(named, ["src1.csv", "src7.csv", "src19.csv"])


def item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random ids: as many as rows, none twice."""
    ids = table(spark, sf_dir, "orders").select(text.random_id().alias("id"))
    per_id = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(F.sum("n").alias("items"), F.count(F.lit(1)).alias("distinct_ids"))


QUERIES = {
    "scalar_names": scalar_names,
    "scalar_times": scalar_times,
    "scalar_text": scalar_text,
    "scalar_codec": scalar_codec,
    "required_and_prefixed": required_and_prefixed,
    "item_ids": item_ids,
}

# Longest prefix of at most twelve bytes: every prefix is tried.
_CUT_BYTES = (
    "list_max(list_filter(list_transform(range(0, 13), lambda n: {'n': n, 's': left(text, n)}), "
    "lambda p: strlen(p.s) <= 12)).s"
)

ORACLE = {
    "scalar_names": r"""
SELECT doc_id, base, CASE WHEN base IS NOT NULL THEN lang END AS level_1, CAST(NULL AS VARCHAR) AS level_7,
       split_part(base, '.', 1) AS stem, lower(trim(split_part(base, '-', 1))) || '.csv' AS clean_lower,
       trim(split_part(base, '-', 1)) || '.csv' AS clean,
       upper(replace('load_in/' || lang || '/' || base, '_', ' ')) AS label
FROM (SELECT *, upper(source) || ' - ' || CAST(doc_id AS VARCHAR) || '.part.csv' AS base FROM documents)""",
    "scalar_times": """
SELECT event_id, strftime(ts, '%Y%m%d') AS day_folder, strftime(ts, '%Y-%m-%d') AS dashed_day,
       strftime(ts, '%Y/%m/%d/%H') AS hour_folder, date_trunc('second', ts) AS parsed,
       make_timestamp(CAST(round_even(CAST(epoch_us(ts) AS DOUBLE) / 60000000, 0) AS BIGINT) * 60000000) AS rounded,
       date_trunc('minute', ts) + CASE WHEN minute(ts) % 2 = 1 THEN INTERVAL 1 MINUTE ELSE INTERVAL 0 MINUTE END AS tie,
       ts <= TIMESTAMP '2024-01-24 00:00:00' AS week_old
FROM events""",
    "scalar_text": f"""
SELECT doc_id, rtrim(text || chr(65533) || '  ', ' ') AS trimmed, source || ' ' AS replaced,
       left(text, 12) AS cut, {_CUT_BYTES} AS cut_bytes,
       coalesce(length(CASE WHEN doc_id % 3 > 0 THEN left(source, CAST(doc_id % 3 - 1 AS INTEGER)) END), 0) < 1 AS blank,
       coalesce(lang, '') || ':' || coalesce(source, '') || ':' || coalesce(lang, '') || ':{{other}}' AS filled,
       '<a target="_blank" href="https://x.example/?a=1&amp;b=' || source || '">LINK</a>' AS link,
       CASE doc_id % 5 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN true END AS active,
       CAST(n_chars AS VARCHAR) AS n_chars
FROM documents""",
    "scalar_codec": """
SELECT conv_id, turn, base64(encode(text || chr(10))) AS encoded, text || chr(10) AS decoded
FROM conversations""",
    "required_and_prefixed": """
SELECT doc_id, 'in/' || lang || '/' || source || '.csv' AS path, lower(source) || '.csv' AS file
FROM documents WHERE lang LIKE 'en%' AND ('in/' || lang || '/') LIKE 'in/en/%'
  AND source IN ('src1', 'src7', 'src19')""",
    "item_ids": "SELECT count(*) AS items, count(*) AS distinct_ids FROM orders",
}
