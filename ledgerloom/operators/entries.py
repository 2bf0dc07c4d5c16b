"""Inputs and outputs of transactions as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTPOINT = ["tx_hash", "out_index"]


def drop_markers(entries: DataFrame) -> DataFrame:
    """Entries without the end-of-block rows."""
    return entries.where(~F.col("is_marker"))


def outpoints(entries: DataFrame) -> DataFrame:
    """The outpoint each input spends or each output creates."""
    return drop_markers(entries).select("height", "tx_pos", "is_input", *OUTPOINT)


def spent_outpoints(entries: DataFrame) -> DataFrame:
    """The outpoints that inputs name."""
    return drop_markers(entries).where("is_input").select(*OUTPOINT)


def tx_positions(legs: DataFrame) -> DataFrame:
    """Position of every transaction in its block, with its numbers of inputs and outputs."""
    return legs.groupBy("height", "tx_pos", "tx_hash").agg(
        F.count_if("is_input").alias("inputs"),
        F.count_if(~F.col("is_input")).alias("outputs"),
    )
