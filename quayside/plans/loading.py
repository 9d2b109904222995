"""Delimited files in and out, staged loads, keys and upserts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import workspace
from quayside.config import SALES_KEYS, SALES_SCHEMAS
from quayside.functions import times
from quayside.operators.combine import union_strict
from quayside.operators.latest import latest_items
from quayside.operators.load import clean_for_load
from quayside.operators.profile import key_violations, width_profile
from quayside.operators.upsert import upsert_table
from quayside.plans.tables import table
from quayside.sinks.delimited import write_bel_gzip, write_csv, write_dated_parquet
from quayside.sinks.keyed import detached, open_table
from quayside.sinks.tables import (
    create_table_if_absent,
    location_of,
    publish,
    read_published,
    refresh_table,
    staging_table_name,
)
from quayside.sources.delimited import (
    import_mapped_csv,
    read_bel_csv,
    read_header_csv,
    read_typed_csv,
)
from quayside.sources.items import read_items_export, tagged_item
from quayside.sources.tables import run_scripts
from quayside.streaming.items import put_items

DAY = dt.date(2024, 1, 31)
#: Buckets of the tables below, which are small.
STATE_BUCKETS = 8


def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header CSV to dated Parquet, every column as text."""
    root = workspace.scratch(spark, "csv-to-parquet")
    write_csv(table(spark, sf_dir, "customer"), f"{root}/raw")
    path = write_dated_parquet(read_header_csv(spark, f"{root}/raw"), f"{root}/output", DAY)
    return spark.read.parquet(path)


ORDER_TYPES = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice decimal(18,2), o_orderdate date, o_orderpriority string"
)


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderpriority",
    )


def _as_stored(orders: DataFrame) -> DataFrame:
    """The loaded types back to those of the order table."""
    return orders.withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("double"),
            "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz"),
        }
    )


def typed_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with a declared schema, by position."""
    root = workspace.scratch(spark, "typed-csv")
    write_csv(_order_rows(spark, sf_dir), root)
    return _as_stored(read_typed_csv(spark, root, ORDER_TYPES))


def mapped_csv_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV whose headers differ in case, order and one name from the table."""
    root = workspace.scratch(spark, "mapped-csv")
    rows = _order_rows(spark, sf_dir).select(
        F.col("o_orderpriority").alias("O_OrderPriority"),
        F.col("o_orderdate").alias("OrderedOn"),
        F.col("o_totalprice").alias("O_TOTALPRICE"),
        F.col("o_orderkey").alias("o_OrderKey"),
        F.col("o_custkey").alias("O_CustKey"),
        F.col("o_orderstatus").alias("O_OrderStatus"),
    )
    write_csv(rows, root)
    return _as_stored(import_mapped_csv(spark, root, ORDER_TYPES, {"o_orderdate": "OrderedOn"}))


# Widths of the staging columns below; the time column is parsed, not cut.
STAGING = {"orderkey": 20, "status": 10, "priority": 8, "ordered_at": 22, "note": 14}


def bel_roundtrip_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BEL gzip extract, staged clean-up, full refresh of the warehouse table."""
    root = workspace.scratch(spark, "bel-load")
    key = F.col("o_orderkey")
    note = F.concat(
        F.lit('say "'), F.col("o_orderstatus"), F.lit('",\n�\u0007'), F.col("o_orderpriority"), F.lit("  ")
    )
    ordered = F.col("o_orderdate") + F.make_dt_interval(hours=F.pmod(key, F.lit(24)).cast("int"))
    extract = table(spark, sf_dir, "orders").select(
        key.cast("string").alias("OrderKey"),
        F.concat("o_orderstatus", F.lit("   ")).alias("Status"),
        F.col("o_orderpriority").alias("Priority"),
        F.date_format(ordered, times.TWELVE_HOUR).alias("Ordered_At"),
        F.when(key % 3 != 0, note).alias("Note"),
    )
    path = write_bel_gzip(extract, f"{root}/data/", DAY, "orders")
    schema = T.StructType(
        [T.StructField(n, T.StringType(), True, {"max_len": w}) for n, w in STAGING.items()]
    )
    staged = clean_for_load(read_bel_csv(spark, path, list(STAGING)), schema, ["ordered_at"])
    name = staging_table_name("", "extract", f"orders_{root.rsplit('-', 1)[1]}")
    create_table_if_absent(spark, name, staged.schema, f"{root}/warehouse")
    refresh_table(staged, name)
    loaded = spark.read.schema(spark.table(name).schema).parquet(location_of(spark, name))
    spark.sql(f"DROP TABLE {name}")
    return loaded


def document_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return width_profile(table(spark, sf_dir, "documents"))


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


ITEM_TAGS = {"id": "S", "name": "S", "score": "N", "isActive": "BOOL", "updated_at": "S", "seq": "N"}
ITEM_TYPES = {
    "id": "string",
    "name": "string",
    "score": "double",
    "isActive": "boolean",
    "updated_at": "timestamp_ntz",
    "seq": "bigint",
}


def latest_item_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-value puts exported as tagged items; the last put of each key is its state."""
    root = workspace.scratch(spark, "items")
    puts = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_type").alias("name"),
        F.col("value").alias("score"),
        (F.col("value") < 100).alias("isActive"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("updated_at"),
        F.col("event_id").alias("seq"),
    )
    tagged_item(puts, ITEM_TAGS).write.text(f"{root}/export")
    items = read_items_export(spark, f"{root}/export", ITEM_TYPES)
    publish(latest_items(items, ["id", "name"], "updated_at", "seq"), f"{root}/state")
    return read_published(spark, f"{root}/state")


def latest_item_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same puts as a stream, merged batch by batch into the published state."""
    root = workspace.scratch(spark, "item-stream")
    puts = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_type").alias("name"),
        F.col("value").alias("score"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("seq"),
    )
    state = open_table(spark, f"items_{root.rsplit('-', 1)[1]}", puts.schema, ["id", "name"], f"{root}/state", STATE_BUCKETS)
    # Two landings, so that the second batch meets the state of the first.
    late = F.col("score").isNull() | (F.col("score") > 50)
    for half in (late, ~late):
        puts.where(half).write.mode("append").parquet(f"{root}/puts")
        stream = spark.readStream.schema(puts.schema).parquet(f"{root}/puts")
        put_items(stream, ["updated_at", "seq"], state, f"{root}/checkpoint")
    return detached(spark, state)


def _newest() -> list[Column]:
    """The latest order date first; ties go by the other columns."""
    names = ("o_orderdate", "o_custkey", "o_orderstatus", "o_totalprice")
    return [F.col(name).desc_nulls_last() for name in names]


def staged_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed orders as target; urgent orders, closed or not, staged with a new price."""
    orders = table(spark, sf_dir, "orders")
    root = workspace.scratch(spark, "upsert")
    target = open_table(spark, f"orders_{root.rsplit('-', 1)[1]}", orders.schema, ["o_orderkey"], root, STATE_BUCKETS)
    upsert_table(target, orders.where(F.col("o_orderstatus") != "O"), _newest())
    staged = orders.where(F.col("o_orderpriority") == "1-URGENT").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    upsert_table(target, staged, _newest())
    return detached(spark, target)


def sales_lead_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared lead table from a CSV with its own header spelling."""
    root = workspace.scratch(spark, "leads")
    balance = F.col("c_acctbal")
    leads = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("LeadSource"),
        F.lit("buyer").alias("JobRole"),
        F.concat(F.lit('said "call, '), F.col("c_name"), F.lit('"')).alias("ContactNotes"),
        F.col("c_name").alias("LeadProfile"),
        F.when(balance > 5000, "yes").otherwise("no").alias("UsedPromo"),
        F.when(balance < 0, "t").otherwise("f").alias("DoNotReachOut"),
        F.col("c_nationkey").alias("Region"),
        F.floor(balance).alias("Converted"),
        F.col("c_custkey").alias("ProspectID"),
    )
    write_csv(leads, root)
    return import_mapped_csv(spark, root, SALES_SCHEMAS["leaddata"])


# Source columns of the sales tables, in the order of their declared columns.
SALES_SOURCES = {
    "customer": ("customer", ("c_custkey", "c_name", "c_mktsegment"), "ID,Name,phonenumber"),
    "ordertable": ("orders", ("o_orderkey", "o_custkey"), "ID,customer_id"),
    "orderitem": (
        "lineitem",
        ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "ID,order_id,product_id,quantity",
    ),
}


def sales_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import the declared sales tables and check their primary keys.

    The declared ``int`` keys are read as ``bigint``, so that large tables fit.
    """
    root = workspace.scratch(spark, "sales")
    found = []
    for name, (source, columns, header) in SALES_SOURCES.items():
        rows = table(spark, sf_dir, source).select(*columns).toDF(*header.split(","))
        write_csv(rows, f"{root}/{name}")
        schema = SALES_SCHEMAS[name].replace(" int", " bigint")
        loaded = import_mapped_csv(spark, f"{root}/{name}", schema)
        key = SALES_KEYS[name]
        violations = key_violations(loaded, [key])
        found.append(violations.withColumnRenamed(key, "key").withColumn("table_name", F.lit(name)))
    return union_strict(found)


LOAD_SCRIPTS = (
    "CREATE OR REPLACE TEMPORARY VIEW staged_orders AS "
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, "
    "o_orderpriority FROM all_orders WHERE o_orderpriority = '1-URGENT'",
    "SELECT * FROM all_orders t LEFT ANTI JOIN staged_orders s ON t.o_orderkey = s.o_orderkey "
    "WHERE o_orderstatus = :status UNION ALL SELECT * FROM staged_orders",
)


def scripted_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's load and upsert scripts, run in order with bound values."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("all_orders")
    return run_scripts(spark, LOAD_SCRIPTS, {"status": "F"})[-1]


QUERIES = {
    "csv_to_parquet": csv_to_parquet,
    "typed_csv_load": typed_csv_load,
    "mapped_csv_import": mapped_csv_import,
    "bel_roundtrip_load": bel_roundtrip_load,
    "width_profile": document_widths,
    "pk_violations": pk_violations,
    "latest_item_per_key": latest_item_per_key,
    "latest_item_stream": latest_item_stream,
    "staged_upsert": staged_upsert,
    "scripted_upsert": scripted_upsert,
    "sales_lead_import": sales_lead_import,
    "sales_key_violations": sales_key_violations,
}

_ORDER_SQL = """
SELECT o_orderkey, o_custkey, nullif(o_orderstatus, '') AS o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate, nullif(o_orderpriority, '') AS o_orderpriority
FROM orders"""

_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

ORACLE = {
    "csv_to_parquet": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, nullif(c_name, '') AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal,
       nullif(c_mktsegment, '') AS c_mktsegment
FROM customer""",
    "typed_csv_load": _ORDER_SQL,
    "mapped_csv_import": _ORDER_SQL,
    "bel_roundtrip_load": """
SELECT CAST(o_orderkey AS VARCHAR) AS orderkey,
       nullif(left(rtrim(o_orderstatus || '   '), 10), '') AS status,
       nullif(left(rtrim(o_orderpriority), 8), '') AS priority,
       o_orderdate + to_hours(CAST(((o_orderkey % 24) + 24) % 24 AS INTEGER)) AS ordered_at,
       CASE WHEN o_orderkey % 3 <> 0 THEN
         left(rtrim('say "' || o_orderstatus || '",' || chr(10) || ' ' || chr(7) || o_orderpriority || '  '), 14)
       END AS note
FROM orders""",
    "width_profile": "\nUNION ALL\n".join(
        f"SELECT {i} AS ordinal, '{c}' AS column_name, "
        f"CAST(greatest(coalesce(max(length(CAST({c} AS VARCHAR))), 0), length('{c}') + 200) AS INTEGER) AS width "
        "FROM documents"
        for i, c in enumerate(_COLUMNS, start=1)
    ),
    "pk_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS copies,
       CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null' ELSE 'duplicate' END AS problem
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "latest_item_per_key": """
SELECT id, name, score, "isActive", updated_at, seq FROM (
  SELECT CAST(user_id AS VARCHAR) AS id, event_type AS name, value AS score,
         value < 100 AS "isActive", ts AS updated_at, event_id AS seq,
         row_number() OVER (PARTITION BY user_id, event_type
                            ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events)
WHERE rn = 1""",
    "latest_item_stream": """
SELECT id, name, score, updated_at, seq FROM (
  SELECT CAST(user_id AS VARCHAR) AS id, event_type AS name, value AS score, ts AS updated_at, event_id AS seq,
         row_number() OVER (PARTITION BY user_id, event_type
                            ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events)
WHERE rn = 1""",
    "sales_lead_import": """
SELECT nullif(c_mktsegment, '') AS leadsource, 'buyer' AS jobrole,
       'said "call, ' || c_name || '"' AS contactnotes, nullif(c_name, '') AS leadprofile,
       CASE WHEN c_acctbal > 5000 THEN 'yes' ELSE 'no' END AS usedpromo,
       CASE WHEN c_acctbal < 0 THEN true ELSE false END AS donotreachout,
       CAST(c_nationkey AS VARCHAR) AS region, CAST(floor(c_acctbal) AS INTEGER) AS converted,
       CAST(c_custkey AS VARCHAR) AS prospectid
FROM customer""",
    "sales_key_violations": " UNION ALL ".join(
        f"SELECT {columns[0]} AS key, count(*) AS copies, "
        f"CASE WHEN {columns[0]} IS NULL THEN 'null' ELSE 'duplicate' END AS problem, "
        f"'{name}' AS table_name FROM {source} GROUP BY {columns[0]} "
        f"HAVING count(*) > 1 OR {columns[0]} IS NULL"
        for name, (source, columns, _) in SALES_SOURCES.items()
    ),
    "scripted_upsert": """
SELECT * FROM orders t WHERE o_orderstatus = 'F'
  AND NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderpriority = '1-URGENT' AND s.o_orderkey = t.o_orderkey)
UNION ALL
SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "staged_upsert": """
SELECT * FROM orders t WHERE o_orderstatus <> 'O'
  AND NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderpriority = '1-URGENT' AND s.o_orderkey = t.o_orderkey)
UNION ALL
SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders WHERE o_orderpriority = '1-URGENT'
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC NULLS LAST, o_custkey DESC NULLS LAST,
  o_orderstatus DESC NULLS LAST, o_totalprice DESC NULLS LAST) = 1""",
}
