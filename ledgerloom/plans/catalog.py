"""Every operator as a query over the sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.amounts import utc_day
from ..functions.scripts import decode_op_n, script_template, with_address
from ..operators import clock, counters, entries, lifo, matching, netting, sketches, transfers
from ..session import STREAM_SETTINGS, checkpointed, ensure_checkpoint_dir, stored
from ..sources import blocks, sinks, tables
from ..streaming import jobs
from . import pipeline

Query = Callable[[SparkSession, str], DataFrame]

TOPICS = 4
PARTITIONS = 6
BLOCKS_PER_INTERVAL = 1000


def _net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netting.net_changes(_matched(spark, sf_dir))


def _account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netting.account_changes(_net(spark, sf_dir))


def _stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifo.stack_changes(netting.net_changes(tables.changes(spark, sf_dir)))


def _net_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netting.net_changes_windowed(_matched(spark, sf_dir))


def _transfers_mv(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = netting.transfer_table(_account_changes(spark, sf_dir))
    return table.withColumn("dt", F.col("dt").cast("string"))


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.monthly_table(netting.transfer_table(_account_changes(spark, sf_dir)))


def _monthly_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per month of a table whose records were written again twice, the last time into later months."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/monthly-{uuid.uuid4().hex[:12]}"
    first = stored(netting.transfer_table(_account_changes(spark, sf_dir)))
    sinks.write_monthly(first, path)
    sinks.write_monthly(first.where("height % 5 = 0").withColumn("value", F.col("value") - 1), path)
    sinks.compact_monthly(spark, path)
    later = {"value": F.col("value") + 2, "dt": F.col("dt") + F.expr("interval 31 days")}
    sinks.write_monthly(first.where("height % 7 = 0").withColumns(later), path)
    sinks.compact_monthly(spark, path)
    return sinks.monthly_totals(sinks.read_monthly(spark, path))


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    legs = tables.numbered_legs(spark, sf_dir)
    txs = transfers.processed_txs(legs, sized_by=tables.all_legs(spark, sf_dir))
    return txs.withColumn("inputs", F.to_json("inputs")).withColumn("outputs", F.to_json("outputs"))


def _transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfers.leg_transfers(tables.all_legs(spark, sf_dir))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfers.transfer_edges(_transfers(spark, sf_dir))


def _edge_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "`from` string, `to` string, value double, blockNumber int, timestamp bigint, transactionHash string"
    records = sinks.transfer_records(_edges(spark, sf_dir))
    return records.select(F.from_json("value", schema).alias("r")).groupBy("r.from").agg(
        F.count("r.to").alias("edges"),
        F.max("r.value").alias("largest"),
        F.max("r.blockNumber").alias("last_block"),
    )


def _edge_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "`from` string, `to` string, value double, blockNumber int, timestamp bigint, transactionHash string"
    return sinks.transfer_records(_edges(spark, sf_dir)).select(F.from_json("value", schema).alias("r")).select("r.*")


def _stack_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "sign int, ts bigint, height int, txPos int, nonce int, ots bigint, address string, value double"
    records = sinks.stack_change_records(lifo.public_stack_changes(_stack(spark, sf_dir)), TOPICS, PARTITIONS)
    return records.select(F.from_json("value", schema).alias("r")).select("r.*")


def _stack_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sinks.stack_change_records(lifo.public_stack_changes(_stack(spark, sf_dir)), TOPICS, PARTITIONS)
    return records.select(
        "key",
        "topic",
        "partition",
        F.get_json_object("value", "$.ots").cast("bigint").alias("ots"),
        F.get_json_object("value", "$.value").cast("double").alias("value"),
    )


def _account_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.account_change_records(_account_changes(spark, sf_dir), TOPICS, PARTITIONS)


def _account_records_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _account_records(spark, sf_dir).select(
        "key",
        "topic",
        "partition",
        (F.get_json_object("value", "$.in") == "true").alias("in"),
        F.get_json_object("value", "$.value").cast("double").alias("value"),
    )


def _scripts_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scripts(spark, sf_dir).select("c_custkey", script_template("script").alias("template"))


def _op_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.conv(F.hex(F.substring("script", 1, 1)), 16, 10).cast("int")
    return (
        tables.scripts(spark, sf_dir)
        .select("c_custkey", first.alias("opcode"))
        .withColumn("number", decode_op_n("opcode"))
    )


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_address(tables.scripts(spark, sf_dir)).select("c_custkey", "address", "kind")


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_address(tables.hash_scripts(spark, sf_dir)).select("c_custkey", "address", "kind")


def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = tables.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("address"))
    return sinks.sharded(named, TOPICS, PARTITIONS)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = blocks.parse_blocks(tables.raw_blocks(spark, sf_dir)).withColumn("script", F.hex("script"))
    return _hash_as_text(parsed).withColumn("own_hash", F.lower(F.hex("own_hash")))


def _chain_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks to net changes, with the script in place of the address."""
    parsed = checkpointed(blocks.parse_blocks(tables.raw_blocks(spark, sf_dir)).withColumn("address", F.hex("script")))
    return netting.net_changes(clock.with_increasing_time_of(matching.match_spends_strict(parsed), parsed))


def _chain_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    txs = transfers.processed_txs(checkpointed(pipeline.block_legs(tables.raw_blocks(spark, sf_dir))))
    return txs.withColumn("inputs", F.to_json("inputs")).withColumn("outputs", F.to_json("outputs"))


def _streamed(spark: SparkSession, sf_dir: str, last: str) -> DataFrame:
    """The table ``last`` of the streaming queries over all blocks.

    The blocks come in two parts; all queries stop after the first and start again
    from their checkpoints for the second.
    """
    for key, value in STREAM_SETTINGS.items():
        spark.conf.set(key, value)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex[:12]}"
    chain = stored(tables.raw_blocks(spark, sf_dir))
    half = chain.agg(F.max("height")).first()[0] // 2
    for part in (chain.where(F.col("height") <= half), chain.where(F.col("height") > half)):
        part.write.mode("append").parquet(f"{base}/blocks")
        jobs.start_entries(blocks.stream_blocks(spark, path=f"{base}/blocks"), base).awaitTermination()
        jobs.start_matching(jobs.read_entries(spark, base), base).awaitTermination()
        jobs.await_whole(jobs.start_netting(spark, base))
        if last == "stacks":
            jobs.start_stacks(spark, base).awaitTermination()
    return spark.read.parquet(f"{base}/{last}")


def _stream_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "net").select("ts", "height", "tx_pos", "value", "address")


def _stream_stacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["sign", "ts", "height", "tx_pos", "nonce", "ots", "address", "value"]
    return _streamed(spark, sf_dir, "stacks").select(*columns)


def _in_runs(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of three runs, each over the blocks that came since the one before."""
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex[:12]}"
    chain = stored(tables.raw_blocks(spark, sf_dir))
    last = chain.agg(F.max("height")).first()[0]
    for tip, confirmations in ((last // 3, 3), (2 * last // 3, 3), (last, 0)):
        known = chain.where(F.col("height") <= tip)
        pipeline.run_next(spark, known, out, confirmations, stacks=name == "stacks", edges=name == "transfers", sketches=False)
    return pipeline.read_runs(spark, out, name)


def _address_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every net change among those of its address, in the order the laid out rows have."""
    laid = netting.in_address_order(_net(spark, sf_dir)).withColumn("at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy("address").orderBy("at"))
    return laid.select("address", "height", "tx_pos", "value", place.cast("bigint").alias("place"))


def _key_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_address(tables.key_scripts(spark, sf_dir)).select("c_custkey", "address", "kind")


def _block_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks written as records and read back."""
    read = blocks.from_records(blocks.to_records(tables.raw_blocks(spark, sf_dir)))
    size = F.octet_length("bytes").cast("bigint")
    return read.select("height", size.alias("bytes"), F.sha2("bytes", 256).alias("block_sha256"))


def _approx_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each day's approximate count is within a tenth of the exact one."""
    dated = tables.dated_changes(spark, sf_dir)
    approx = netting.active_addresses_approx(dated).withColumnRenamed("addresses", "approx")
    close = F.abs(F.col("approx") - F.col("addresses")) <= F.greatest(F.lit(1), 0.1 * F.col("addresses"))
    both = netting.active_addresses(dated).join(approx, "day")
    return _day_as_text(both.select("day", "addresses", close.alias("close")))


def _sketched_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each week's count from merged sketches is within a tenth of the exact one.

    Every change is in one of three runs, each of which leaves a sketch a day.
    """
    dated = tables.dated_changes(spark, sf_dir)
    in_runs = dated.withColumn("run", F.pmod(F.xxhash64("address", "ts"), F.lit(3)))
    kept = checkpointed(sketches.address_sketches(in_runs, "run"))
    approx = sketches.sketched_addresses(kept, "week").withColumnRenamed("addresses", "approx")
    week = F.trunc(utc_day("ts"), "week").alias("day")
    exact = dated.groupBy(week).agg(F.countDistinct("address").alias("addresses"))
    close = F.abs(F.col("approx") - F.col("addresses")) <= F.greatest(F.lit(1), 0.1 * F.col("addresses"))
    return _day_as_text(exact.join(approx, "day").select("day", "addresses", close.alias("close")))


def _day_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.col("day").cast("string"))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.latest_per_key(tables.changes(spark, sf_dir), ["address"], "ts")


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    outpoints = tables.line_outpoints(spark, sf_dir)
    return matching.match_spends(tables.entries(spark, sf_dir), sized_by=outpoints)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    outpoints = tables.line_outpoints(spark, sf_dir)
    return matching.join_parents(tables.entries(spark, sf_dir), sized_by=outpoints)


def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    outpoints = tables.line_outpoints(spark, sf_dir)
    return matching.missing_outputs(tables.entries(spark, sf_dir), sized_by=outpoints)


def _hash_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("tx_hash", F.lower(F.hex("tx_hash")))


QUERIES: dict[str, Query] = {
    "utxo_match": _matched,
    "utxo_match_join": lambda s, d: _hash_as_text(_joined(s, d)),
    "missing_utxo": lambda s, d: _hash_as_text(_missing(s, d)),
    "utxo_set": lambda s, d: _hash_as_text(matching.unspent_outputs(tables.entries(s, d))),
    "utxo_bootstrap": lambda s, d: _hash_as_text(matching.unspent_within(tables.entries(s, d), 1500, 400)),
    "outpoints": lambda s, d: _hash_as_text(entries.outpoints(tables.entries(s, d))),
    "net_changes": _net,
    "net_changes_windowed": _net_windowed,
    "address_layout": _address_layout,
    "account_changes": _account_changes,
    "transfers_mv": _transfers_mv,
    "monthly_table": _monthly,
    "monthly_rewritten": _monthly_rewritten,
    "tx_net_by_account": lambda s, d: netting.net_by_account(tables.legs(s, d)),
    "tx_fees": lambda s, d: transfers.tx_fees(tables.legs(s, d)),
    "block_minting": lambda s, d: transfers.block_minting(tables.all_legs(s, d)),
    "processed_txs": _processed,
    "unbalanced_txs": lambda s, d: transfers.unbalanced_txs(tables.legs(s, d, taxed=True)),
    "unmatched_sides": lambda s, d: transfers.unmatched_sides(netting.net_by_account(tables.all_legs(s, d))),
    "tx_positions": lambda s, d: entries.tx_positions(tables.all_legs(s, d)),
    "transfers": _transfers,
    "transfer_edges": _edges,
    "transfer_edge_records": _edge_records,
    "transfer_edge_fields": _edge_fields,
    "stack_changes": _stack,
    "spent_by_origin": lambda s, d: lifo.spent_by_origin(_stack(s, d)),
    "open_segments": lambda s, d: lifo.open_segments(_stack(s, d)),
    "stack_keyed_json": _stack_records,
    "stack_json_fields": _stack_fields,
    "monotone_block_time": lambda s, d: clock.monotone_block_time(tables.block_headers(s, d)),
    "time_regressions": lambda s, d: clock.time_regressions(tables.block_headers(s, d)),
    "confirmed_blocks": lambda s, d: blocks.confirmed_blocks(tables.block_headers(s, d), 100, 3),
    "resume_height": lambda s, d: blocks.resume_height(tables.block_headers(s, d)),
    "run_counters": lambda s, d: counters.run_counters(tables.entries(s, d), BLOCKS_PER_INTERVAL),
    "daa_exact": lambda s, d: _day_as_text(netting.active_addresses(tables.dated_changes(s, d))),
    "daa_approx": lambda s, d: _day_as_text(netting.active_addresses_approx(tables.dated_changes(s, d))),
    "daa_approx_close": _approx_close,
    "daa_sketches_close": _sketched_close,
    "classify_scripts": _scripts_classified,
    "decode_op_n": _op_n,
    "extract_addresses": _addresses,
    "encode_addresses": _encoded,
    "key_addresses": _key_addresses,
    "shard_assignment": _shards,
    "latest_per_key": _compacted,
    "transfers_keyed_json": _account_records_shown,
    "transfers_json_roundtrip": lambda s, d: sinks.parse_account_changes(_account_records(s, d)),
    "raw_block_records": _block_records,
    "parse_blocks": _parsed,
    "stream_net_changes": _stream_net,
    "stream_stack_changes": _stream_stacks,
    "runs_net_changes": lambda s, d: _in_runs(s, d, "net"),
    "runs_stack_changes": lambda s, d: _in_runs(s, d, "stacks"),
    "runs_transfers": lambda s, d: _in_runs(s, d, "transfers"),
    "chain_net_changes": _chain_net,
    "chain_transfers": lambda s, d: pipeline.block_transfers(tables.raw_blocks(s, d)),
    "chain_processed_txs": _chain_processed,
    "chain_account_changes": lambda s, d: pipeline.block_account_changes(tables.raw_blocks(s, d)),
}
