"""API payloads: envelopes, arrays, children of parents, unions, schema crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import workspace
from quayside.config import ENROLLMENT_TEXT_COLUMNS, endpoint_columns
from quayside.operators.children import of_parents
from quayside.operators.combine import cast_to_text, project, union_outer, union_strict
from quayside.operators.flatten import array_widths, drop_nested, flatten, flatten_entries, list_widths
from quayside.plans.tables import EVENT_K, event_k, table
from quayside.sources.payloads import items_of, read_array, read_items
from quayside.sources.tables import crawl, crawl_changes

CONFIG = {
    "Customer": {
        "DEMO": {
            "Columns": {
                "Events": [
                    "id", "name", "who_user", "who_tags_0", "who_tags_1", "who_tags_2",
                    "marks_0_n", "marks_0_w", "marks_1_n", "marks_1_w",
                ],
                "Registration_Line_Items": [
                    "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_comment", "l_shipdate",
                ],
            }
        }
    }
}
PAGE = 100
ITEM_SCHEMA = (
    "id bigint, name string, who struct<user: bigint, tags: array<string>>, "
    "marks array<struct<n: string, w: double>>"
)


def _land_envelopes(spark: SparkSession, sf_dir: str) -> str:
    """One landed response per event: some without ``items``, some empty, some with up to three."""
    root = workspace.scratch(spark, "envelopes")
    k = F.col("k")
    item = lambda i: F.struct(
        (F.col("event_id") * 10 + i).alias("id"),
        F.col("event_type").alias("name"),
        F.struct(
            F.col("user_id").alias("user"),
            F.slice(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.lit(1), k % 4).alias("tags"),
        ).alias("who"),
        F.when(
            k % 3 > 0,
            F.transform(
                F.sequence(F.lit(1), F.greatest(k % 3, F.lit(1))),
                lambda n: F.struct(n.alias("n"), F.col("value").alias("w")),
            ),
        ).alias("marks"),
    )
    items = F.when(k % 5 > 1, F.transform(F.sequence(F.lit(0), k % 3), item)).when(
        k % 5 == 1, F.transform(F.slice(F.array(F.lit(0)), 1, 0), item)
    )
    events = table(spark, sf_dir, "events").withColumn("k", event_k())
    events.select(F.to_json(F.struct(F.lit("ok").alias("state"), items.alias("items"))).alias("value")) \
        .write.text(root)
    return root


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_items(spark, _land_envelopes(spark, sf_dir), ITEM_SCHEMA)


def api_first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of one page request, which are any ``PAGE`` of them: how many came, and how many ids."""
    items = read_items(spark, _land_envelopes(spark, sf_dir), ITEM_SCHEMA, limit=PAGE)
    return items.agg(F.count(F.lit(1)).alias("items"), F.count_distinct("id").alias("ids"))


def api_items_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope items flattened to the configured columns."""
    flat = drop_nested(flatten(_items(spark, sf_dir)))
    return project(flat, endpoint_columns(CONFIG, "DEMO", "Events"))


def api_items_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same items as path and value rows."""
    return flatten_entries(_items(spark, sf_dir), ["id"])


def api_array_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    return array_widths(items.select("marks", F.col("who.tags").alias("tags")))


def api_list_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of all depths in nested items, with their longest lengths."""
    k = F.col("id") % 1000
    items = _items(spark, sf_dir).select(
        F.array(F.struct("marks", "who"), F.struct(F.slice("marks", 1, 1).alias("marks"), "who")).alias("both"),
        F.when(k > 0, F.struct(F.array(F.col("who.tags")).alias("tags"))).alias("in"),
    )
    return list_widths(items)


def api_lenient_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One single-quoted payload an order, as some endpoints answer, opened into its items."""

    def number(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("null"))

    payload = F.concat(
        F.lit("{'items': [{'id': "), number("o_orderkey"), F.lit(", 'customer': "), number("o_custkey"), F.lit("}]}")
    )
    answers = table(spark, sf_dir, "orders").select(payload.alias("payload"))
    return items_of(answers, "payload", "id bigint, customer bigint")


def api_parent_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of finished orders, from two pages with different columns."""
    lines = table(spark, sf_dir, "lineitem")
    returned = lines.where(F.col("l_returnflag").eqNullSafe("R")).drop("l_discount")
    others = lines.where(~F.col("l_returnflag").eqNullSafe("R")).drop("l_tax")
    finished = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    children = of_parents(union_outer([returned, others]), finished, "l_orderkey", "o_orderkey")
    return project(children, endpoint_columns(CONFIG, "DEMO", "Registration_Line_Items"))


ENROLLMENT = "Id bigint, UserId bigint, DateCompleted {kind}, CourseCollectionId {kind}"


def user_child_union_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrollments of listed users; responses that disagree on types meet as text."""
    root = workspace.scratch(spark, "enrollments")
    orders = table(spark, sf_dir, "orders")
    frames = []
    finished = F.col("o_orderstatus").eqNullSafe("F")
    for chosen, kind in ((finished, "string"), (~finished, "bigint")):
        month = F.date_format("o_orderdate", "yyyyMM").cast(kind)
        row = F.struct(
            F.col("o_orderkey").alias("Id"),
            F.col("o_custkey").alias("UserId"),
            month.alias("DateCompleted"),
            (F.col("o_orderkey") % 7).cast(kind).alias("CourseCollectionId"),
        )
        path = f"{root}/{kind}"
        orders.where(chosen).select(
            F.to_json(F.array(row)).alias("value")
        ).write.text(path)
        page = read_array(spark, path, ENROLLMENT.format(kind=kind), multi_line=False)
        frames.append(cast_to_text(page, ENROLLMENT_TEXT_COLUMNS))
    users = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return of_parents(union_strict(frames), users, "UserId", "c_custkey")


def schema_crawl_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema changes between two crawls of landed JSON, found in the data itself."""
    root = workspace.scratch(spark, "crawl")
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    number = F.to_json(F.struct("event_id", "value"))
    amount = F.to_json(F.struct("event_id", "value", F.col("value").alias("amount")))
    text = F.to_json(
        F.struct("event_id", F.concat(F.lit("v"), F.col("value").cast("string")).alias("value"))
    )
    before = events.where(~kind.isin("purchase", "error")).select(number.alias("j"))
    after = events.select(
        F.when(kind == "purchase", amount).when(kind == "error", text).otherwise(number).alias("j")
    )
    before.write.text(f"{root}/before/events")
    after.write.text(f"{root}/after/events")
    read_json = lambda session, path: session.read.json(path)
    return crawl_changes(
        crawl(spark, f"{root}/before", read_json), crawl(spark, f"{root}/after", read_json)
    )


QUERIES = {
    "api_items_flatten": api_items_flatten,
    "api_items_entries": api_items_entries,
    "api_first_page": api_first_page,
    "api_array_widths": api_array_widths,
    "api_list_widths": api_list_widths,
    "api_lenient_items": api_lenient_items,
    "api_parent_child": api_parent_child,
    "user_child_union_strict": user_child_union_strict,
    "schema_crawl_diff": schema_crawl_diff,
}

_ITEMS = f"""
items AS (
  SELECT event_id * 10 + i AS id, event_type AS name, user_id, k, value
  FROM (SELECT *, unnest(range(0, k % 3 + 1)) AS i
        FROM (SELECT *, {EVENT_K} AS k FROM events) WHERE k % 5 > 1)
)"""
_FLAT = """
SELECT id, name, user_id AS who_user,
       CASE WHEN k % 4 >= 1 THEN 'a' END AS who_tags_0,
       CASE WHEN k % 4 >= 2 THEN 'b' END AS who_tags_1,
       CASE WHEN k % 4 >= 3 THEN 'c' END AS who_tags_2,
       CASE WHEN k % 3 >= 1 THEN '1' END AS marks_0_n,
       CASE WHEN k % 3 >= 1 THEN value END AS marks_0_w,
       CASE WHEN k % 3 >= 2 THEN '2' END AS marks_1_n,
       CASE WHEN k % 3 >= 2 THEN value END AS marks_1_w
FROM items"""
_PATHS = (
    "name", "who_user", "who_tags_0", "who_tags_1", "who_tags_2",
    "marks_0_n", "marks_0_w", "marks_1_n", "marks_1_w",
)

ORACLE = {
    "api_lenient_items": "SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS BIGINT) AS customer FROM orders",
    "api_items_flatten": f"WITH {_ITEMS} {_FLAT}",
    "api_first_page": f"""
WITH {_ITEMS}, page AS (SELECT id FROM items ORDER BY id LIMIT {PAGE})
SELECT count(*) AS items, count(DISTINCT id) AS ids FROM page""",
    "api_items_entries": f"WITH {_ITEMS}, flat AS ({_FLAT})"
    + " UNION ALL ".join(
        f"SELECT id, '{p}' AS path, CAST({p} AS VARCHAR) AS value FROM flat WHERE {p} IS NOT NULL"
        for p in _PATHS
    ),
    "api_array_widths": f"""
WITH {_ITEMS}
SELECT 'marks' AS column_name, coalesce(max(k % 3), 0) AS width FROM items
UNION ALL SELECT 'tags', coalesce(max(k % 4), 0) FROM items""",
    "api_list_widths": f"""
WITH {_ITEMS}, lists AS (
  SELECT 'both' AS path, 2 AS width FROM items
  UNION ALL SELECT 'both_0_marks', k % 3 FROM items
  UNION ALL SELECT 'both_1_marks', least(k % 3, 1) FROM items
  UNION ALL SELECT 'both_0_who_tags', k % 4 FROM items
  UNION ALL SELECT 'both_1_who_tags', k % 4 FROM items
  UNION ALL SELECT 'in_tags', 1 FROM items WHERE id % 1000 > 0
  UNION ALL SELECT 'in_tags_0', k % 4 FROM items WHERE id % 1000 > 0)
SELECT path, CAST(max(width) AS INTEGER) AS width FROM lists WHERE width > 0 GROUP BY path""",
    "api_parent_child": """
SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN l_returnflag IS DISTINCT FROM 'R' THEN l_discount END AS l_discount,
       CAST(NULL AS VARCHAR) AS l_comment, l_shipdate
FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "user_child_union_strict": """
SELECT o_orderkey AS "Id", o_custkey AS "UserId",
       strftime(o_orderdate, '%Y%m') AS "DateCompleted",
       CAST(o_orderkey % 7 AS VARCHAR) AS "CourseCollectionId",
       CAST(NULL AS VARCHAR) AS "DateExpires", CAST(NULL AS VARCHAR) AS "AccessDate"
FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "schema_crawl_diff": """
SELECT DISTINCT 'events' AS table_name, 'amount' AS column_name, CAST(NULL AS VARCHAR) AS old_type,
       'double' AS new_type, 'added' AS change
FROM events WHERE event_type = 'purchase' AND value IS NOT NULL
UNION ALL
SELECT DISTINCT 'events', 'value', 'double', 'string', 'retyped'
FROM events WHERE event_type = 'error' AND value IS NOT NULL""",
}
