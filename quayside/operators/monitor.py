"""Status monitor: current status, failure and lateness filters, report columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.config import STATUS_REPORT
from quayside.functions.text import blank
from quayside.functions.times import days_before, round_to_minute
from quayside.operators.latest import latest_per_key

# The source with an alert of its own, the healthy status, and the
# allowed age in days for each monitored schedule.
MTA_SOURCE = "MTA Build"
SUCCESS = "success"
SCHEDULE_DAYS = {"etlmonitor-daily": 1, "etlmonitor-weekly": 7, "etlmonitor-monthly": 30}


def current_status(runs: DataFrame) -> DataFrame:
    """Latest refresh of each customer and source."""
    order = [F.col("lrd").desc_nulls_last(), F.col("run_id").desc_nulls_last()]
    return latest_per_key(runs, ["customer", "source"], order)


def failed_daily(status: DataFrame) -> DataFrame:
    """Unscheduled sources other than the MTA build that did not succeed.

    A null source or status drops out, as in SQL.
    """
    return status.where(
        blank("info") & (F.col("source") != MTA_SOURCE) & (F.col("status") != SUCCESS)
    )


def failed_mta(status: DataFrame) -> DataFrame:
    return status.where((F.col("source") == MTA_SOURCE) & (F.col("status") != SUCCESS))


def late(status: DataFrame, schedule: str, as_of: dt.date | str) -> DataFrame:
    """Sources of a schedule whose last refresh is as old as its limit or older."""
    cutoff = days_before(as_of, SCHEDULE_DAYS[schedule])
    return status.where((F.col("info") == schedule) & (F.col("lrd") <= cutoff))


def report_columns(status: DataFrame) -> DataFrame:
    """The six report columns with the refresh time rounded to the minute."""
    values = {name: F.col(name) for name in STATUS_REPORT}
    values["lrd"] = round_to_minute("lrd")
    return status.select(
        *[values[name].alias(title.lower()) for name, title in STATUS_REPORT.items()]
    )
