"""Fiscal years that begin in April, written like 2023-24."""

from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F


def _label(start: Column) -> Column:
    return F.concat(start.cast("string"), F.lit("-"), F.substring((start + 1).cast("string"), 3, 2))


def wall(ts: Column, zone: str | None) -> Column:
    """A time as the clocks of a zone show it, whatever the session's zone is; without a zone, as the session's do."""
    if zone is None:
        return ts
    seconds = (F.unix_micros(ts.cast("timestamp")).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def midnight(day: str, zone: str | None, after: int = 0) -> Column:
    """The moment in which a day (yyyy-MM-dd), or one so many days after, begins in a zone."""
    date = datetime.fromisoformat(day) + timedelta(days=after)
    return F.to_timestamp(F.lit(date.strftime("%Y-%m-%d"))) if zone is None else F.lit(date.replace(tzinfo=ZoneInfo(zone)))


def fiscal_year(ts: Column, start_month: int = 4, zone: str | None = None) -> Column:
    """The label of the fiscal year of a date or time: 1999-04-01 gives 1999-00."""
    ts = wall(ts, zone)
    return _label(F.year(ts) - (F.month(ts) < start_month).cast("int"))


def fiscal_start(label: Column) -> Column:
    """The first year of a label; fails on a label that doesn't start with a year."""
    return F.substring(label, 1, 4).cast("int")


def next_fiscal_label(start: Column) -> Column:
    """The label of the fiscal year after the one that begins in `start`."""
    return _label(start + 1)


def year_month(ts: Column, zone: str | None = None) -> Column:
    return F.date_format(wall(ts, zone), "yyyy-MM")


def month_number(ts: Column, zone: str | None = None) -> Column:
    """Like 202404."""
    return F.date_format(wall(ts, zone), "yyyyMM")


def day_of(ts: Column, zone: str | None = None) -> Column:
    return F.to_date(wall(ts, zone))
