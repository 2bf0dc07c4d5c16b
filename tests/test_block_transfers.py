"""Transfers of whole blocks in one pass."""

import random

from ledgerloom.operators import ordered, transfers
from ledgerloom.sources import tables

SF = "/root/testdata/sf0.001"


def test_legs_are_netted_once(spark):
    # Nets were made three times from the same shuffle: for themselves, for the fees and for the minted coins.
    plan = transfers.leg_transfers(tables.all_legs(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and plan.count("lineitem.parquet") == 1 and plan.count("Exchange") == 1


def test_transfers_by_block_equal_those_by_transaction(spark):
    # Blocks without a coinbase, with two, with two times; fees that are negative or none; equal amounts.
    draw = random.Random(5)
    rows = []
    for height in range(40):
        for tx_pos in range(draw.randrange(4)):
            for _ in range(draw.randrange(1, 6)):
                coinbase = tx_pos < height % 3
                rows.append(
                    (height, 100 * height + height % 7 // 5 * (tx_pos % 2), tx_pos, f"t{height}-{tx_pos}", coinbase)
                    + (not coinbase and draw.random() < 0.5, draw.choice("abcd"), draw.choice("xy"), draw.randrange(1, 5))
                )
    schema = (
        "height int, ts bigint, tx_pos int, tx_hash string, is_coinbase boolean, "
        "is_input boolean, address string, kind string, value bigint"
    )
    legs = spark.createDataFrame(rows, schema).coalesce(3)
    by_block = sorted(transfers.leg_transfers(legs).collect())
    assert by_block and by_block == sorted(transfers.model_transfers(transfers.net_accounts(legs)).collect())


def test_keys_are_sized_in_one_pass_unless_a_bucket_is_large(spark):
    rows = spark.range(0, 3000, 1, 4).selectExpr("if(id % 3 = 0, -1, id) as k")
    assert ordered.heavy_keys(rows.limit(0), ["k"], 500) == (500, {})
    assert ordered.heavy_keys(rows, ["k"], 1000) == (1000, {})
    size, heavy = ordered.heavy_keys(rows, ["k"], 900)
    assert size == 900 and list(heavy.values()) == [1000]


def test_processed_transactions_shuffle_the_legs_once(spark):
    # Lists of legs were shuffled by transaction, and their sums once more by transaction and by block.
    legs = tables.numbered_legs(spark, SF)
    txs = transfers.processed_txs(legs)
    plan = txs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(height") >= 1 and "hashpartitioning(ts" not in plan
    whole = sorted(map(str, txs.collect()))
    assert whole and whole == sorted(map(str, transfers.processed_txs(legs, rows_per_chunk=200).collect()))
