"""Timestamps, date folders and date arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import col

# Layouts used in folders and in load files.
DAY_FOLDER = "yyyyMMdd"
DASHED_DAY = "yyyy-MM-dd"
HOUR_FOLDER = "yyyy/MM/dd/HH"
TWELVE_HOUR = "MM/dd/yyyy hh:mm:ss a"


def day_folder(ts: Column | str) -> Column:
    return F.date_format(col(ts), DAY_FOLDER)


def dashed_day(ts: Column | str) -> Column:
    return F.date_format(col(ts), DASHED_DAY)


def hour_folder(ts: Column | str) -> Column:
    return F.date_format(col(ts), HOUR_FOLDER)


def parse_twelve_hour(c: Column | str) -> Column:
    """``01/31/2024 12:00:00 AM`` is midnight; text in another layout is null."""
    return F.try_to_timestamp(col(c), F.lit(TWELVE_HOUR)).cast("timestamp_ntz")


def days_before(as_of: dt.date | str, days: int) -> Column:
    return F.date_add(F.lit(as_of).cast("date"), -days)


def round_to_minute(ts: Column | str) -> Column:
    """Nearest whole minute; half a minute goes to the even minute.

    Works on the clock fields, so it is the same for timestamps with and without
    a zone and stays inside code generation.
    """
    moment = col(ts)
    seconds = F.extract(F.lit("SECOND"), moment)
    up = (seconds > 30) | ((seconds == 30) & (F.minute(moment) % 2 == 1))
    shift = F.when(up, F.lit(60) - seconds).otherwise(-seconds).cast("decimal(18,6)")
    return moment + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), shift)
