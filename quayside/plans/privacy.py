"""Personal data: reports, masking, hashing, quarantine, sampling."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import workspace
from quayside.config import PERSONAL_HEALTH_SCHEMA
from quayside.functions import patterns
from quayside.functions.patterns import CARD, Entity
from quayside.operators import privacy
from quayside.operators.combine import union_strict
from quayside.plans.tables import spread, table
from quayside.sinks.delimited import write_csv
from quayside.sinks.tables import create_table_if_absent, refresh_table
from quayside.sources.delimited import read_typed_csv
from quayside.sources.tables import read_table

CUSTOM = {"hex_token": "[0-9a-f]{40}"}
ENTITIES = privacy.entities_of(custom=CUSTOM)
SCANNED = {
    "documents": ("text", "lang", "source"),
    "conversations": ("role", "text"),
    "customer": ("c_name", "c_mktsegment"),
}
MASKED = ENTITIES


def pii_column_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text column of three tables against every entity of every category."""
    frames = []
    for name, columns in SCANNED.items():
        report = privacy.column_report(spread(table(spark, sf_dir, name).select(*columns)), ENTITIES, columns)
        frames.append(report.withColumn("table_name", F.lit(name)))
    return union_strict(frames)


def pii_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return privacy.mask_columns(documents, ["text"], MASKED)


def pii_mask_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return privacy.mask_columns(turns, ["text"], MASKED)


def pii_hash_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash the customer columns that the report flags."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    report = privacy.column_report(customers, ENTITIES)
    return privacy.hash_columns(customers, privacy.flagged_columns(report))


HEALTH_NAMES = [field.split()[0] for field in PERSONAL_HEALTH_SCHEMA.split(", ")]

# Where each column of the personal-health table is found in a document.
HEALTH_COLUMNS = {
    "email": patterns.EMAIL,
    "mobileNumber": patterns.US_PHONE,
    "creditCardNumber": "[0-9]{13,16}",
    "ssn": patterns.SSN,
    "geo": patterns.IPV4,
    "mbi": patterns.MBI,
}


def pii_health_table_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared personal-health table loaded from CSV and profiled, all 13 columns.

    A document gives as many rows as its most frequent kind has matches, and one if it has none.
    """
    root = workspace.scratch(spark, "health")
    columns = HEALTH_NAMES
    values = {name: F.lit(None).cast("string") for name in columns}
    values |= {"mpi": F.col("doc_id").cast("string"), "firstName": F.col("lang"), "lastName": F.col("source")}
    values |= {name: F.col(f"found.{name}") for name in HEALTH_COLUMNS}
    searched = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", *[
        F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias(name) for name, pattern in HEALTH_COLUMNS.items()
    ])
    documents = searched.select(
        "doc_id", "lang", "source", F.explode_outer(F.arrays_zip(*HEALTH_COLUMNS)).alias("found")
    )
    write_csv(documents.select(*[values[name].alias(name) for name in columns]), root)
    loaded = read_typed_csv(spark, root, PERSONAL_HEALTH_SCHEMA)
    return privacy.column_report(loaded, ENTITIES)


def pii_quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write quarantine and clean rows in one pass and read both sides back."""
    root = workspace.scratch(spark, "zones")
    documents = spread(table(spark, sf_dir, "documents"))
    privacy.write_zones(privacy.zoned(documents, ["text"], ENTITIES), root)
    return spark.read.parquet(root).select("doc_id", F.col("zone").cast("string").alias("zone"))


def pii_sampled_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detection on a portion of the rows, as the sampling option asks."""
    documents = privacy.sampled(table(spark, sf_dir, "documents"), "doc_id", 0.5)
    return privacy.column_report(documents, ENTITIES, ["text"])


def pii_catalog_table_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue table, named by catalogue, schema and table, profiled in every column but nested ones."""
    root = workspace.scratch(spark, "catalog")
    name = f"documents_{root.rsplit('-', 1)[1]}"
    create_table_if_absent(spark, name, table(spark, sf_dir, "documents").schema, f"{root}/table")
    refresh_table(table(spark, sf_dir, "documents"), name)
    report = privacy.column_report(read_table(spark, "spark_catalog", spark.catalog.currentDatabase(), name), ENTITIES)
    report.write.parquet(f"{root}/report")
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(f"{root}/report")


QUERIES = {
    "pii_catalog_table_report": pii_catalog_table_report,
    "pii_column_report": pii_column_report,
    "pii_mask": pii_mask,
    "pii_mask_conversations": pii_mask_conversations,
    "pii_hash_flagged": pii_hash_flagged,
    "pii_health_table_report": pii_health_table_report,
    "pii_quarantine_split": pii_quarantine_split,
    "pii_sampled_report": pii_sampled_report,
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _cards_sql(column: str) -> str:
    """List of Luhn-valid card numbers, worked out digit by digit."""
    digits = "regexp_replace(run, '[ -]', '', 'g')"
    digit = f"CAST(substr({digits}, length({digits}) + 1 - i, 1) AS INTEGER)"
    weighed = f"CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN {digit} * 2 - 9 ELSE {digit} * 2 END"
    total = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: {weighed}))"
    return (
        f"list_filter(regexp_extract_all({column}, {_quoted(CARD)}), lambda run: "
        f"length({digits}) BETWEEN 13 AND 16 AND {total} % 10 = 0)"
    )


def _hit_sql(column: str, entity: Entity) -> str:
    if entity.luhn:
        return f"len({_cards_sql(column)}) > 0"
    return f"regexp_matches({column}, {_quoted(entity.pattern)})"


def _counts_sql(source: str, columns, extra: str = "", cast: bool = False) -> list[str]:
    parts = []
    for column in columns:
        for entity in ENTITIES:
            if entity.by_column_name:
                named = re.search(entity.pattern, column, re.IGNORECASE)
                matched = f'count("{column}")' if named else "0"
            else:
                text = f"CAST({column} AS VARCHAR)" if cast else column
                matched = f"count(*) FILTER (WHERE {_hit_sql(text, entity)})"
            parts.append(
                f"SELECT {extra} '{column}' AS column_name, "
                f"'{entity.category}' AS category, '{entity.name}' AS entity, "
                f'{matched} AS matched, count("{column}") AS non_null FROM {source}'
            )
    return parts


def _rates_sql(parts: list[str]) -> str:
    return (
        "SELECT *, CASE WHEN non_null > 0 THEN CAST(matched AS DOUBLE) / non_null ELSE 0.0 END AS rate, "
        "non_null > 0 AND CAST(matched AS DOUBLE) / non_null >= 0.1 AS flagged FROM ("
        + "\nUNION ALL ".join(parts)
        + ")"
    )


def _report_sql() -> str:
    parts = []
    for name, columns in SCANNED.items():
        parts += _counts_sql(name, columns, f"'{name}' AS table_name,")
    return _rates_sql(parts)


def _health_sql() -> str:
    columns = HEALTH_NAMES
    values = {name: "CAST(NULL AS VARCHAR)" for name in columns}
    values |= {"mpi": "CAST(doc_id AS VARCHAR)", "firstName": "nullif(lang, '')", "lastName": "nullif(source, '')"}
    values |= {name: f"found_{name}[place]" for name in HEALTH_COLUMNS}
    picked = ", ".join(f'{values[name]} AS "{name}"' for name in columns)
    found = ", ".join(
        f"regexp_extract_all(text, {_quoted(pattern)}) AS found_{name}" for name, pattern in HEALTH_COLUMNS.items()
    )
    most = ", ".join(f"len(found_{name})" for name in HEALTH_COLUMNS)
    return (
        f"WITH searched AS (SELECT doc_id, lang, source, {found} FROM documents), "
        f"health AS (SELECT {picked} FROM (SELECT *, unnest(range(1, greatest(1, {most}) + 1)) AS place FROM searched)) "
    ) + _rates_sql(_counts_sql("health", columns))


def _mask_sql(column: str) -> str:
    masked = column
    for entity in MASKED:
        if entity.by_column_name:
            continue
        if entity.luhn:
            longest_first = (
                "list_transform(list_reverse_sort(list_transform(list_distinct("
                f"{_cards_sql(masked)}), lambda c: {{'n': length(c), 'c': c}})), lambda s: s.c)"
            )
            masked = (
                f"list_reduce(list_prepend({masked}, {longest_first}), "
                f"lambda done, card: replace(done, card, '{entity.tag}'))"
            )
        else:
            masked = f"regexp_replace({masked}, {_quoted(entity.pattern)}, '{entity.tag}', 'g')"
    return masked


_ANY_HIT = " OR ".join(
    f"coalesce({_hit_sql('text', e)}, false)" for e in ENTITIES if not e.by_column_name
)

ORACLE = {
    "pii_catalog_table_report": _rates_sql(
        _counts_sql("documents", ("doc_id", "text", "lang", "source", "n_chars"), cast=True)
    ),
    "pii_column_report": _report_sql(),
    "pii_health_table_report": _health_sql(),
    "pii_sampled_report": "WITH sampled AS (SELECT * FROM documents WHERE "
    "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) < 2147483648) "
    + _rates_sql(_counts_sql("sampled", ("text",))),
    "pii_mask": f"SELECT doc_id, {_mask_sql('text')} AS text FROM documents",
    "pii_mask_conversations": f"SELECT conv_id, turn, {_mask_sql('text')} AS text FROM conversations",
    "pii_hash_flagged": "SELECT c_custkey, sha256(c_name) AS c_name, c_mktsegment FROM customer",
    "pii_quarantine_split": (
        f"SELECT doc_id, CASE WHEN {_ANY_HIT} THEN 'quarantine' ELSE 'clean' END AS zone FROM documents"
    ),
}
