"""Every registered query against its SQL, and the shape of its plan."""

import re

import pytest
from checking import compare

import __spark_entry__ as registry

#: The queries of the operators for training data have tests of their own.
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {name: query for name, query in registry.queries().items() if not OWN.match(name)}
ORACLE = {name: sql for name, sql in registry.oracle_sql().items() if not OWN.match(name)}
CHECKED = sorted(ORACLE)
UNCHECKED = set()


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == UNCHECKED
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, sf_check, name):
    assert compare(spark, sf_check, QUERIES[name], ORACLE[name]) > 0


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql_on_skewed_tables(spark, sf_skewed, name):
    compare(spark, sf_skewed, QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", ["api_parent_child", "user_child_union_strict", "staged_upsert", "doc_retrieve_topk"])
def test_matches_sql_without_automatic_broadcast(spark, sf_skewed, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        compare(spark, sf_skewed, QUERIES[name], ORACLE[name])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["scalar_times", "monitor_failed_daily", "bel_roundtrip_load", "clickstream_hour_range"])
def test_matches_sql_in_another_time_zone(spark, sf_small, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        compare(spark, sf_small, QUERIES[name], ORACLE[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_and_no_cross_join(spark, sf_small, name):
    plan = plan_of(QUERIES[name](spark, sf_small))
    assert not re.search(r"EvalPython|MapInPandas|MapInArrow|FlatMapGroups", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name", ["monitor_current_status", "monitor_late_weekly", "doc_retrieve_topk"])
def test_best_rows_are_cut_before_the_shuffle(spark, sf_small, name):
    plan = plan_of(QUERIES[name](spark, sf_small))
    assert re.search(r"WindowGroupLimit .*Partial", plan)
    assert re.search(r"WindowGroupLimit .*Final", plan)


def test_source_filter_reaches_below_the_window(spark, sf_small):
    plan = plan_of(QUERIES["monitor_failed_mta"](spark, sf_small))
    assert plan.index("Window [") < plan.rindex("Filter")
    scan = plan[plan.index("FileScan"):]
    assert "event_type" in scan.split("ReadSchema")[0].split("DataFilters")[1]


def test_column_report_is_one_aggregate(spark, sf_small):
    from quayside.operators import privacy

    lines = spark.read.parquet(f"{sf_small}/documents.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        plan = plan_of(privacy.column_report(lines, privacy.entities_of(), ["text", "lang"]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert plan.count("Exchange") == 1
    assert "ReadSchema: struct<text:string,lang:string>" in plan


def test_term_index_moves_nothing(spark, sf_small):
    from quayside.operators.retrieval import term_index

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        plan = plan_of(term_index(spark.read.parquet(f"{sf_small}/documents.parquet")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_entry(spark):
    assert registry.entry(spark).columns == ["customer", "source", "last refresh", "status", "info", "airflow"]
