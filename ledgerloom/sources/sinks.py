"""Publishing results: keyed JSON records, shards, monthly tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sharding import partition_of, string_hash, topic_of
from ..schemas import ACCOUNT_CHANGE
from ..session import stored

KAFKA_WRITE = {
    "kafka.compression.type": "lz4",
    "kafka.batch.size": "524288",
    "kafka.linger.ms": "5000",
    "kafka.request.timeout.ms": "60000",
}


def sharded(df: DataFrame, topics: int, partitions: int, address: str = "address") -> DataFrame:
    """Add the topic and partition numbers an address belongs to."""
    hashed = F.col("_hash")
    return (
        df.withColumn("_hash", string_hash(address))
        .withColumn("topic", topic_of(hashed, topics))
        .withColumn("partition", partition_of(hashed, topics, partitions))
        .drop("_hash")
    )


def _json(df: DataFrame, columns: list[str]):
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def account_change_records(changes: DataFrame, topics: int = 1, partitions: int = 1) -> DataFrame:
    """Account changes as records keyed by height, position and address."""
    return sharded(changes, topics, partitions).select(
        F.concat_ws("-", "height", "txPos", "address").alias("key"),
        _json(changes, ["in", "ts", "height", "txPos", "value", "address"]).alias("value"),
        "topic",
        "partition",
    )


def stack_change_records(changes: DataFrame, topics: int = 1, partitions: int = 1) -> DataFrame:
    """Published stack changes as records keyed by address, nonce and A(dded) or D(eleted)."""
    letter = F.when(F.col("sign") > 0, "A").otherwise("D")
    return sharded(changes, topics, partitions).select(
        F.concat_ws("-", "address", "nonce", letter).alias("key"),
        _json(changes, ["sign", "ts", "height", "txPos", "nonce", "ots", "address", "value"]).alias("value"),
        "topic",
        "partition",
    )


def transfer_records(edges: DataFrame) -> DataFrame:
    """Transfer edges as records without a key."""
    return edges.select(F.lit(None).cast("string").alias("key"), _json(edges, edges.columns).alias("value"))


def parse_account_changes(records: DataFrame) -> DataFrame:
    """Account changes back from the JSON in ``value``."""
    return records.select(F.from_json("value", ACCOUNT_CHANGE).alias("r")).select("r.*")


def read_account_changes(spark: SparkSession, path: str) -> DataFrame:
    """Account changes from files with one JSON object per line."""
    return spark.read.schema(ACCOUNT_CHANGE).json(path)


def latest_per_key(df: DataFrame, keys: list[str], offset: str) -> DataFrame:
    """The last record of every key, as a compacted log or a replacing table keeps it.

    An aggregation rather than a ranking window: a key written many times is
    reduced before the shuffle.  Records with equal offsets are told apart by
    their other columns.
    """
    rest = [c for c in df.columns if c not in keys and c != offset]
    latest = df.groupBy(*keys).agg(F.max(F.struct(offset, *rest)).alias("_r"))
    return latest.select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in df.columns])


MONTHLY_KEY = ["height", "txPos", "address"]


def last_version(spark: SparkSession, path: str) -> int:
    """The number of the last write to a monthly table, 0 before the first."""
    try:
        written = spark.read.schema("version bigint").parquet(path)
    except AnalysisException:
        return 0
    return written.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def _put_monthly(rows: DataFrame, path: str, **mode: str) -> None:
    """Rows with their version, by month, each month ordered by block and position.

    The range exchange splits a large month over several files.
    """
    by_month = rows.withColumn("month", F.date_format("dt", "yyyyMM"))
    _write_monthly_rows(by_month.repartitionByRange(*_MONTHLY_ORDER), path, **mode)


_MONTHLY_ORDER = ["month", "height", "txPos", "out"]


def _write_monthly_rows(laid: DataFrame, path: str, **mode: str) -> None:
    writer = laid.sortWithinPartitions(*_MONTHLY_ORDER).write
    writer = writer.options(**{k: v for k, v in mode.items() if k != "mode"}).mode(mode["mode"])
    writer.partitionBy("month").parquet(path)


def write_monthly(transfer_table: DataFrame, path: str, mode: str = "append") -> int:
    """Write the transfer table by month and return the number of this write.

    Of records written again the later write holds, also one with the same time, and
    one whose time puts it in another month.  One writer at a time.
    """
    version = 1 if mode == "overwrite" else last_version(transfer_table.sparkSession, path) + 1
    number = F.lit(version).cast("bigint")
    _put_monthly(transfer_table.withColumns({"version": number, "merged": number}), path, mode=mode)
    return version


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    """The transfer table with one record per key, that of the last write."""
    return _last_written(spark.read.parquet(path).drop("month", "merged")).drop("version")


def _last_written(table: DataFrame, also: list[str] | None = None) -> DataFrame:
    """Of each key the row with the greatest version; of several in one write the last by time."""
    keys = [*(also or []), *MONTHLY_KEY]
    rest = [c for c in table.columns if c not in (*keys, "version", "dt")]
    # Few records are written again: one sort after the shuffle, and not one before it as well.
    latest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in ("version", "dt", *rest)])
    later = F.lag("version").over(latest_first)
    return table.withColumn("_later", later).where(F.col("_later").isNull()).drop("_later")


def compact_monthly(spark: SparkSession, path: str) -> list[str]:
    """Drop the rows that later writes to the same month replaced; returns the months written again.

    Only months written to since they were last compacted (``merged`` has the last write that a row
    was compacted with) are read and written.  Rows keep the number of their write, so a row
    that another month's later write replaced still loses on reading.
    """
    table = spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))
    written = table.groupBy("month").agg(F.min("merged").alias("a"), F.max("version").alias("b")).where("a < b")
    months = {r["month"]: r["b"] for r in written.collect()}
    if months:
        number = F.create_map(*[F.lit(x) for pair in months.items() for x in pair])[F.col("month")].cast("bigint")
        touched = table.where(F.col("month").isin(list(months))).withColumn("merged", number)
        # Written to the shared folder first, as these months are read and then overwritten.  Ranges of
        # blocks hold whole keys, so the exchange that lays the rows out serves finding the last ones too.
        kept = _last_written(stored(touched).repartitionByRange("month", "height"), ["month"])
        _write_monthly_rows(kept, path, mode="overwrite", partitionOverwriteMode="dynamic")
    return sorted(months)


def monthly_totals(transfer_table: DataFrame) -> DataFrame:
    """Records and totals per month."""
    return transfer_table.groupBy(F.date_format("dt", "yyyyMM").alias("month")).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("out").alias("outs"),
        F.sum(F.round(F.col("value") * 1e8).cast("bigint")).alias("satoshi"),
    )


def monthly_table(transfer_table: DataFrame) -> DataFrame:
    """Records and totals per month of the collapsed table."""
    return monthly_totals(latest_per_key(transfer_table, MONTHLY_KEY, "dt"))
