"""Time arithmetic on timestamps without a zone.

Everything here ignores the session time zone: ``unix_timestamp`` counts a
zone-less timestamp as it stands, whereas ``date_trunc`` would make it zoned.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.contracts import FILE_MONTH_PATTERN



def ntz(moment: datetime) -> Column:
    """Literal without a zone; a plain literal would be read in the local zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def minute_number(ts: Column) -> Column:
    """Whole minutes since 1970."""
    return F.floor(F.unix_timestamp(ts) / 60)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end``; fractions are cut first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def date_key(day: Column) -> Column:
    """Date as the integer YYYYMMDD."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def iso_weekday(day: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(day) + 1


def file_month(file_name: Column) -> Column:
    """First day of the month named in a file, NULL when it names none."""
    month = F.regexp_extract(file_name, FILE_MONTH_PATTERN, 0)
    return F.concat(month, F.lit("-01")).try_cast("date")
