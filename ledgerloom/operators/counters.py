"""Progress counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def run_counters(entries: DataFrame, blocks_per_interval: int) -> DataFrame:
    """Blocks, transactions and entries per interval of heights."""
    per_tx = entries.groupBy("height", "tx_pos").agg(F.count(F.lit(1)).alias("n"))
    return per_tx.groupBy(F.floor(F.col("height") / blocks_per_interval).alias("interval")).agg(
        F.countDistinct("height").alias("blocks"), F.count(F.lit(1)).alias("txs"), F.sum("n").alias("events")
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows and the highest block while another action runs."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("records"), F.max("height").alias("height")), observation
