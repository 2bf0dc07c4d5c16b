"""Net balance changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import to_coin, utc_day, utc_time


def net_changes(matched: DataFrame) -> DataFrame:
    """Net change per address and transaction; changes of zero are dropped."""
    return (
        matched.groupBy("address", "height", "ts", "tx_pos")
        .agg(F.sum("value").alias("value"))
        .where(F.col("value") != 0)
        .select("ts", "height", "tx_pos", "value", "address")
    )


def net_changes_windowed(matched: DataFrame) -> DataFrame:
    """The same through one-millisecond event-time windows.

    Block times are unique, so a window holds exactly one block.
    """
    return (
        matched.withColumn("event_time", F.timestamp_seconds("ts"))
        .groupBy(F.window("event_time", "1 millisecond"), "address", "tx_pos")
        .agg(F.sum("value").alias("value"), F.min("height").alias("height"), F.min("ts").alias("ts"))
        .where(F.col("value") != 0)
        .select("ts", "height", "tx_pos", "value", "address")
    )


def in_address_order(net: DataFrame) -> DataFrame:
    """Rows of a block laid out by address and position, for sinks that keep file order."""
    order = ["address", "height", "tx_pos"]
    return net.repartitionByRange(*order).sortWithinPartitions(*order)


def account_changes(net: DataFrame) -> DataFrame:
    """Published form: direction flag and value in coins."""
    return net.select(
        (F.col("value") < 0).alias("in"),
        "ts",
        "height",
        F.col("tx_pos").alias("txPos"),
        to_coin("value").alias("value"),
        "address",
    )


def transfer_table(account_changes_df: DataFrame) -> DataFrame:
    """Table form of account changes: a time and an ``out`` flag."""
    return account_changes_df.select(
        utc_time("ts").alias("dt"),
        "height",
        "txPos",
        (~F.col("in")).cast("int").alias("out"),
        "value",
        "address",
    )


def net_by_account(legs: DataFrame, *also: str) -> DataFrame:
    """Net value per transaction, address and address kind; inputs count negative.

    Zero nets are kept here and dropped where transfers are reconstructed.
    ``also`` names further columns of the transaction to keep.
    """
    signed = F.when(F.col("is_input"), -F.col("value")).otherwise(F.col("value"))
    return legs.groupBy("height", "ts", "tx_pos", "tx_hash", *also, "address", "kind").agg(F.sum(signed).alias("value"))


def active_addresses(changes: DataFrame) -> DataFrame:
    """Distinct addresses per UTC day."""
    return changes.groupBy(utc_day("ts").alias("day")).agg(F.countDistinct("address").alias("addresses"))


def active_addresses_approx(changes: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Approximate distinct addresses per UTC day."""
    return changes.groupBy(utc_day("ts").alias("day")).agg(
        F.approx_count_distinct("address", rsd).alias("addresses")
    )
