"""Landing zone: manifests, repacking, arrivals, table export."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import workspace
from quayside.config import required_files
from quayside.functions.names import base_name, plain_path
from quayside.operators.combine import union_outer, union_strict
from quayside.operators.manifest import (
    complete_at_least,
    complete_exactly,
    manifest_report,
    present_files,
)
from quayside.operators.profile import exists_by
from quayside.plans.tables import table
from quayside.sinks.delimited import write_csv
from quayside.sinks.repack import repack
from quayside.sinks.runlog import require_run, run_log
from quayside.sinks.tables import export_tables
from quayside.sources.delimited import read_header_csv, read_typed_csv
from quayside.sources.landing import stream_arrivals
from quayside.sources.tables import table_list
from quayside.streaming.arrivals import to_dated_parquet, to_gzip

DAY = dt.date(2024, 1, 31)
DELIVERIES = 50
MANIFEST = "src1.csv;src2.csv;src3.csv;src4.csv;src5.csv;src6.csv;src7.csv;src8.csv;src9.csv"
FULL_MANIFEST = ";".join(f"src{n}.csv" for n in range(20))


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing listing named after the documents, with a folder marker per tenth file."""
    doc = F.col("doc_id")
    delivery = F.pmod(doc, F.lit(DELIVERIES)).cast("int")
    folder = F.concat(F.lit("landing/"), delivery.cast("string"), F.lit("/"))
    name = (
        F.when(doc % 10 == 9, F.lit(""))
        .when(doc % 3 == 0, F.concat(F.upper("source"), F.lit(" - 01-31-2024.csv")))
        .otherwise(F.concat(F.initcap("source"), F.lit(".csv")))
    )
    return table(spark, sf_dir, "documents").select(
        delivery.alias("delivery"), F.concat(folder, name).alias("path")
    )


def _present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present_files(_listing(spark, sf_dir), by=["delivery"])


def landing_manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(_present(spark, sf_dir), required_files(FULL_MANIFEST), ["delivery"])


def landing_manifest_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = manifest_report(_present(spark, sf_dir), required_files(FULL_MANIFEST), ["delivery"])
    return complete_exactly(report, ["delivery"])


def landing_manifest_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = manifest_report(_present(spark, sf_dir), required_files(MANIFEST), ["delivery"])
    return complete_at_least(report, ["delivery"])


def landing_files_exist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per delivery: has any file arrived, folder markers aside."""
    return exists_by(_listing(spark, sf_dir), ["delivery"], F.length(base_name("path")) > 0)


ORDER_FILES = "ordersf.csv;orderso.csv;ordersp.csv"
FILE_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"


def _land_orders(spark: SparkSession, sf_dir: str, root: str) -> str:
    """A landed file each for finished, partial and all other orders, as a folder of parts under the file's name."""
    rows = table(spark, sf_dir, "orders")
    letter = F.when(F.col("o_orderstatus").isin("F", "P"), F.col("o_orderstatus")).otherwise("O")
    arrival = F.concat(F.lit("Orders"), letter, F.lit(" - 01-31-2024.csv"))
    rows = rows.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", arrival.alias("arrival")
    )
    staged = write_csv(rows, f"{root}/staged", partition_by="arrival")
    workspace.move_all(
        spark,
        {
            path: f"{root}/landing/{unquote(path.rsplit('arrival=', 1)[1])}"
            for path in workspace.children(spark, staged)
        },
    )
    return f"{root}/landing"


def landing_repack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate, gzip into the day's folder, record the run, delete what was moved, read back."""
    root = workspace.scratch(spark, "repack")
    landing = _land_orders(spark, sf_dir, root)
    done = repack(
        spark, landing, f"{root}/dated", required_files(ORDER_FILES), DAY, "orders", f"{root}/log",
        exact=False,
    )
    require_run(spark, f"{root}/log", "orders", DAY)
    frames = [
        read_typed_csv(spark, f"{done.folder}/{name}.gz", FILE_SCHEMA)
        .withColumn("file", F.lit(name))
        for name in sorted(done.files)
    ]
    return union_strict(frames)


def landing_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run log holds after a repack."""
    root = workspace.scratch(spark, "runlog")
    landing = _land_orders(spark, sf_dir, root)
    repack(
        spark, landing, f"{root}/dated", required_files(ORDER_FILES), DAY, "orders", f"{root}/log",
        exact=True,
    )
    return run_log(spark, f"{root}/log")


CUSTOMER_FILE = "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"


def _land_customers(spark: SparkSession, sf_dir: str, root: str) -> str:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return write_csv(rows, f"{root}/raw")


def file_arrival_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace.scratch(spark, "arrivals")
    files = stream_arrivals(spark, _land_customers(spark, sf_dir, root), CUSTOMER_FILE)
    to_dated_parquet(files, f"{root}/output", DAY, f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/output/{DAY:%Y-%m-%d}/*")


def file_arrival_to_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace.scratch(spark, "ingest")
    raw = _land_customers(spark, sf_dir, root)
    files = stream_arrivals(spark, raw, CUSTOMER_FILE, delete_after=True)
    to_gzip(files, f"{root}/dated", DAY, f"{root}/checkpoint")
    return read_typed_csv(spark, f"{root}/dated/{DAY:%Y%m%d}/*", CUSTOMER_FILE)


EXPORTED = ("region", "nation", "supplier", "customer", "part", "orders")


def table_export_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot every listed table, then read every column of all copies back."""
    root = workspace.scratch(spark, "export")
    listed = spark.createDataFrame([(name,) for name in EXPORTED], "tables string").coalesce(1)
    write_csv(listed, f"{root}/tables")
    names = table_list(spark, f"{root}/tables")
    copies = export_tables(spark, names, lambda n: table(spark, sf_dir, n), f"{root}/out")
    frames = [spark.read.parquet(path).withColumn("table_name", F.lit(name)) for name, path in copies.items()]
    return union_outer(frames)


def header_csv_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed order files read by header, with the file name each row came from."""
    root = workspace.scratch(spark, "names")
    landing = _land_orders(spark, sf_dir, root)
    below = F.element_at(F.split(plain_path("_metadata.file_path"), "/"), -2)
    rows = read_header_csv(spark, workspace.children(spark, landing))
    return rows.select("o_orderkey", below.alias("arrival"))


QUERIES = {
    "landing_manifest_files": landing_manifest_files,
    "landing_manifest_exact": landing_manifest_exact,
    "landing_manifest_contains": landing_manifest_contains,
    "landing_files_exist": landing_files_exist,
    "landing_repack": landing_repack,
    "landing_run_log": landing_run_log,
    "landing_file_names": header_csv_names,
    "file_arrival_to_parquet": file_arrival_to_parquet,
    "file_arrival_to_gzip": file_arrival_to_gzip,
    "table_export_all": table_export_all,
}

_CLEAN = r"""
listing AS (
  SELECT ((doc_id % 50) + 50) % 50 AS delivery,
         CASE WHEN doc_id % 10 = 9 THEN ''
              WHEN doc_id % 3 = 0 THEN upper(source) || ' - 01-31-2024.csv'
              ELSE upper(left(source, 1)) || lower(substr(source, 2)) || '.csv' END AS name
  FROM documents
),
present AS (
  SELECT CAST(delivery AS INTEGER) AS delivery,
         trim(regexp_replace(lower(trim(split_part(name, '-', 1))), '\.csv$', '')) || '.csv' AS file
  FROM listing
),
counted AS (
  SELECT delivery, file, count(*) AS present FROM present WHERE file <> '.csv' GROUP BY ALL
)"""


def _report(manifest: str) -> str:
    names = ", ".join(f"('{n}')" for n in manifest.split(";"))
    return f"""
WITH {_CLEAN},
wanted AS (
  SELECT delivery, file FROM (SELECT DISTINCT CAST(delivery AS INTEGER) AS delivery FROM listing), (VALUES {names}) AS v(file)
),
report AS (
  SELECT coalesce(c.delivery, w.delivery) AS delivery, coalesce(c.file, w.file) AS file,
         coalesce(c.present, 0) AS present, CAST(CASE WHEN w.file IS NULL THEN 0 ELSE 1 END AS BIGINT) AS required
  FROM counted c FULL OUTER JOIN wanted w ON c.delivery = w.delivery AND c.file = w.file
)"""


_LANDED = """
SELECT {cols} FROM (SELECT *, CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderstatus ELSE 'O' END AS letter FROM orders)"""
_CUSTOMERS = """
SELECT c_custkey, nullif(c_name, '') AS c_name, c_nationkey,
       nullif(c_mktsegment, '') AS c_mktsegment FROM customer"""

ORACLE = {
    "landing_manifest_files": _report(FULL_MANIFEST) + """
SELECT *, CASE WHEN present = required THEN 'ok' WHEN present < required THEN 'missing'
               WHEN required = 0 THEN 'extra' ELSE 'repeated' END AS state
FROM report""",
    "landing_manifest_exact": _report(FULL_MANIFEST) + """
SELECT delivery, count(*) FILTER (WHERE present < required) AS missing,
       count(*) FILTER (WHERE present > 0 AND required = 0) AS extra,
       count(*) FILTER (WHERE present > 1 AND required = 1) AS repeated,
       bool_and(present = required) AS complete
FROM report GROUP BY delivery""",
    "landing_manifest_contains": _report(MANIFEST) + """
SELECT delivery, count(*) FILTER (WHERE present < required) AS missing,
       bool_and(present >= required) AS complete
FROM report GROUP BY delivery""",
    "landing_files_exist": f"""
WITH {_CLEAN}
SELECT CAST(delivery AS INTEGER) AS delivery, bool_or(coalesce(name <> '', false)) AS found
FROM listing GROUP BY 1""",
    "landing_repack": _LANDED.format(
        cols="o_orderkey, o_custkey, nullif(o_orderstatus, '') AS o_orderstatus, "
        "nullif(o_orderpriority, '') AS o_orderpriority, 'orders' || lower(letter) || '.csv' AS file"
    ),
    "landing_run_log": _LANDED.format(
        cols="'orders' || lower(letter) || '.csv' AS file, count(*) AS rows, 'orders' AS source, '20240131' AS load_date"
    ) + " GROUP BY letter",
    "landing_file_names": _LANDED.format(
        cols="CAST(o_orderkey AS VARCHAR) AS o_orderkey, "
        "'Orders' || letter || ' - 01-31-2024.csv' AS arrival"
    ),
    "file_arrival_to_parquet": _CUSTOMERS,
    "file_arrival_to_gzip": _CUSTOMERS,
    "table_export_all": " UNION ALL BY NAME ".join(
        f"SELECT '{name}' AS table_name, * FROM {name}" for name in EXPORTED
    ),
}
