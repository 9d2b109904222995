"""Status monitor: latest status, failures, lateness, HTML report, counters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from quayside import workspace
from quayside.config import STATUS_REPORT
from quayside.operators import monitor, profile
from quayside.plans.tables import STATUS_SQL, status_runs, table
from quayside.sinks.report import TABLE_END, TABLE_START, report_lines
from quayside.sinks.keyed import detached, open_table
from quayside.sources.tables import run_query
from quayside.streaming.counter import count_visits

AS_OF = {
    "etlmonitor-daily": dt.date(2024, 1, 31),
    "etlmonitor-weekly": dt.date(2024, 2, 5),
    "etlmonitor-monthly": dt.date(2024, 2, 25),
}
TITLES = list(STATUS_REPORT.values())


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.current_status(status_runs(spark, sf_dir))


def current_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(spark, sf_dir)


def failed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.report_columns(monitor.failed_daily(_status(spark, sf_dir)))


def failed_mta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.report_columns(monitor.failed_mta(_status(spark, sf_dir)))


def _late(schedule: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        status = _status(spark, sf_dir)
        return monitor.report_columns(monitor.late(status, schedule, AS_OF[schedule]))

    return run


def report_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = failed_daily(spark, sf_dir)
    return report_lines(report, ["customer", "source"], TITLES)


def status_view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status view read by a query with a bound value."""
    _status(spark, sf_dir).createOrReplaceTempView("etl_current_status")
    return run_query(
        spark,
        "SELECT customer, source, lrd, status, info, airflow FROM etl_current_status "
        "WHERE status <> :healthy AND source <> :other",
        healthy=monitor.SUCCESS,
        other=monitor.MTA_SOURCE,
    )


def visit_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.visit_counts(table(spark, sf_dir, "events"), "event_type")


def visit_counter_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # A pattern, since a stream takes a single file only by pattern.
    visits = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    root = workspace.scratch(spark, "visits")
    schema = profile.visit_counts(table(spark, sf_dir, "events"), "event_type").schema
    totals = open_table(spark, f"visits_{root.rsplit('-', 1)[1]}", schema, ["event_type"], f"{root}/totals", 8)
    count_visits(visits, "event_type", totals, f"{root}/checkpoint")
    return detached(spark, totals)


QUERIES = {
    "monitor_current_status": current_status,
    "monitor_failed_daily": failed_daily,
    "monitor_failed_mta": failed_mta,
    "monitor_late_daily": _late("etlmonitor-daily"),
    "monitor_late_weekly": _late("etlmonitor-weekly"),
    "monitor_late_monthly": _late("etlmonitor-monthly"),
    "monitor_report_html": report_html,
    "status_view_query": status_view_query,
    "visit_counter": visit_counter,
    "visit_counter_stream": visit_counter_stream,
}

_ROUNDED = "make_timestamp(CAST(round_even(CAST(epoch_us(lrd) AS DOUBLE) / 60000000, 0) AS BIGINT) * 60000000)"
_REPORT = f"""customer, source, {_ROUNDED} AS "last refresh", status, info, airflow"""
_FAILED = "(length(info) < 1 OR info IS NULL) AND source <> 'MTA Build' AND status <> 'success'"


def _late_sql(schedule: str, days: int) -> str:
    return (
        f"WITH {STATUS_SQL} SELECT {_REPORT} FROM status WHERE info = '{schedule}' "
        f"AND lrd <= CAST(DATE '{AS_OF[schedule]}' - INTERVAL {days} DAY AS TIMESTAMP)"
    )


def _escaped(column: str) -> str:
    return (
        f"replace(replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
        "'\"', '&quot;')"
    )


def _cells(names: list[str]) -> str:
    return "<thead><tr>" + "".join(f"<th>{n}</th>" for n in names) + "</tr></thead><tbody>"


_HEADERS = [t.lower() for t in TITLES]
_HTML_SQL = f"""
WITH {STATUS_SQL},
report AS (SELECT {_REPORT} FROM status WHERE {_FAILED})
SELECT 1 AS section, customer, source,
  '<tr><td>' || coalesce({_escaped('customer')}, 'None') || '</td><td>' || coalesce({_escaped('source')}, 'None')
  || '</td><td>' || coalesce(strftime("last refresh", '%Y-%m-%d %H:%M:%S'), 'None')
  || '</td><td>' || coalesce({_escaped('status')}, 'None') || '</td><td>' || coalesce({_escaped('info')}, 'None')
  || '</td><td>' || coalesce('<a target="_blank" href="' || {_escaped('airflow')} || '">LINK</a>', 'None')
  || '</td></tr>' AS html
FROM report
UNION ALL
SELECT 0, NULL, NULL, '{TABLE_START}' || CASE WHEN count(*) > 0 THEN '{_cells(_HEADERS)}'
  ELSE '{_cells(TITLES)}' END FROM report
UNION ALL
SELECT 2, NULL, NULL, '{TABLE_END}'
"""
_VISITS_SQL = "SELECT event_type, count(*) AS views FROM events GROUP BY event_type"

ORACLE = {
    "monitor_current_status": f"WITH {STATUS_SQL} SELECT * FROM status",
    "monitor_failed_daily": f"WITH {STATUS_SQL} SELECT {_REPORT} FROM status WHERE {_FAILED}",
    "monitor_failed_mta": (
        f"WITH {STATUS_SQL} SELECT {_REPORT} FROM status "
        "WHERE source = 'MTA Build' AND status <> 'success'"
    ),
    "monitor_late_daily": _late_sql("etlmonitor-daily", 1),
    "monitor_late_weekly": _late_sql("etlmonitor-weekly", 7),
    "monitor_late_monthly": _late_sql("etlmonitor-monthly", 30),
    "monitor_report_html": _HTML_SQL,
    "status_view_query": (
        f"WITH {STATUS_SQL} SELECT customer, source, lrd, status, info, airflow FROM status "
        "WHERE status <> 'success' AND source <> 'MTA Build'"
    ),
    "visit_counter": _VISITS_SQL,
    "visit_counter_stream": _VISITS_SQL,
}
