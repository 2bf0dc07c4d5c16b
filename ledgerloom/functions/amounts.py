"""Amounts and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SATOSHI_PER_COIN = 1e8


def to_coin(satoshi: str | Column) -> Column:
    """Satoshi as a double in whole coins."""
    return (F.col(satoshi) if isinstance(satoshi, str) else satoshi) / F.lit(SATOSHI_PER_COIN)


def utc_time(seconds: str | Column) -> Column:
    """Epoch seconds as a wall-clock UTC timestamp, whatever the session time zone."""
    column = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=column.cast("decimal(18,6)"))


def utc_day(seconds: str | Column) -> Column:
    """Epoch seconds as a UTC date."""
    column = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.date_from_unix_date(F.floor(column / 86400).cast("int"))


def epoch_seconds(timestamp: str | Column) -> Column:
    """Whole seconds since 1970 of a time zone free timestamp."""
    column = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    days = F.unix_date(column.cast("date")).cast("bigint")
    return days * 86400 + F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
