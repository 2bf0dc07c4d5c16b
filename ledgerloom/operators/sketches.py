"""Distinct addresses as sketches, which merge over days and runs without the rows they were made of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import utc_day

# Sketches of at most 2 ** 12 registers: a few kB a day, with a relative standard error below 2 %.
PRECISION = 12


def address_sketches(changes: DataFrame, *also: str, precision: int = PRECISION) -> DataFrame:
    """A sketch of the addresses of every UTC day; ``also`` names further columns to group by.

    Sketches leave out empty strings, so addresses get a prefix: the empty address
    counts like any other, as it does in an exact count.  Nulls do not count.
    """
    address = F.concat(F.lit("="), F.col("address"))
    return changes.groupBy(*also, utc_day("ts").alias("day")).agg(F.hll_sketch_agg(address, precision).alias("sketch"))


def merged_sketches(sketches: DataFrame, period: str = "day") -> DataFrame:
    """One sketch per ``period`` (day, week, month, quarter or year), named by its first day."""
    first = F.col("day") if period == "day" else F.trunc("day", period)
    return sketches.groupBy(first.alias("day")).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_addresses(sketches: DataFrame, period: str = "day") -> DataFrame:
    """Approximate distinct addresses per ``period``, from the sketches of any number of days and runs."""
    return merged_sketches(sketches, period).select("day", F.hll_sketch_estimate("sketch").alias("addresses"))
