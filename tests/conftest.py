import os
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from quayside.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "tests",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def sf_check():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def sf_skewed(tmp_path_factory, sf_small):
    """The small tables with hot keys, copies, nulls, blanks, quotes and line breaks."""
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()

    def old(name):
        return f"read_parquet('{sf_small}/{name}.parquet')"

    changed = {
        "events": f"""
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS ts,
  CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN event_id % 3 = 0 THEN 'click' WHEN event_id % 53 = 0 THEN NULL
       WHEN event_id % 59 = 0 THEN 'a<b>&"c' ELSE event_type END AS event_type,
  CASE WHEN event_id % 47 = 0 THEN NULL WHEN event_id % 43 = 0 THEN -3.5 ELSE value END AS value,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 37 = 0 THEN '{{"z": 1}}' ELSE props END AS props
FROM {old('events')}""",
        "lineitem": f"""
SELECT * REPLACE (
  CASE WHEN l_partkey % 3 = 0 THEN 5 WHEN l_partkey % 50 = 1 THEN NULL ELSE l_orderkey END AS l_orderkey,
  CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag) FROM {old('lineitem')}
UNION ALL SELECT * FROM {old('lineitem')} WHERE l_orderkey % 5 = 0""",
        "orders": f"""
SELECT * REPLACE (
  CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 'a "q", b' || chr(10) || 'c  '
       WHEN o_orderkey % 37 = 0 THEN '' ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE o_custkey END AS o_custkey) FROM {old('orders')}""",
        "customer": f"""
SELECT * REPLACE (
  CASE WHEN c_custkey % 11 = 0 THEN 'x, "y"' WHEN c_custkey % 13 = 0 THEN NULL
       WHEN c_custkey % 17 = 0 THEN '  pad  ' ELSE c_name END AS c_name) FROM {old('customer')}""",
        "documents": f"""
SELECT * REPLACE (
  CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM {old('documents')} WHERE doc_id = 1)
       WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN ''
       WHEN doc_id % 23 = 0 THEN 'é€😀 ID: 4111 1111 1111 1111, 123-45-6789 x@y.co ' || text
       ELSE text END AS text,
  CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN 'a-b c' ELSE source END AS source)
FROM {old('documents')}""",
        "benchmark": f"""
SELECT item_id, CASE WHEN item_id % 5 = 0 THEN NULL WHEN item_id % 7 = 0 THEN 'qqqzzzxxx' ELSE text END AS text
FROM {old('benchmark')}""",
        "conversations": f"""
SELECT * REPLACE (CASE WHEN turn = 3 THEN NULL ELSE text END AS text) FROM {old('conversations')}""",
    }
    for name in ("region", "nation", "supplier", "part"):
        changed[name] = f"SELECT * FROM {old(name)}"
    for name, sql in changed.items():
        con.execute(f"COPY ({sql}) TO '{out}/{name}.parquet' (FORMAT parquet)")
    return str(out)
