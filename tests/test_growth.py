"""Plans and row sizes that decide how jobs grow with their input."""

from pyspark.sql import functions as F

from ledgerloom.operators import clock, matching, transfers
from ledgerloom.plans import pipeline
from ledgerloom.session import checkpointed
from ledgerloom.sources import sinks, tables
from ledgerloom.sources.tables import raw_blocks

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entries_are_not_broadcast_to_get_their_times(spark):
    # Without statistics of the checkpointed entries Spark took them for the smaller side of the join.
    entries = checkpointed(pipeline.block_entries(raw_blocks(spark, SF).where("height < 30")))
    buckets = 1  # of heights, which has a fixed bound
    for timed in (clock.with_increasing_time(entries), pipeline.block_account_changes(raw_blocks(spark, SF))):
        plan = plan_of(timed)
        assert plan.count("BroadcastHashJoin") == buckets and "SortMergeJoin" in plan


def test_matched_rows_go_through_the_shuffle_once(spark):
    # A struct of the output's columns was made below the shuffle and written beside those columns.
    plan = plan_of(matching.match_spends(checkpointed(tables.entries(spark, SF))))
    assert "hashpartitioning(tx_hash" in plan and "struct" not in plan


def test_digests_are_made_after_the_join(spark):
    # Their random bytes went through the join's shuffle.
    plan = plan_of(tables.entries(spark, SF))
    assert plan.index("sha2") < plan.index("Join")


def test_transfers_shuffle_the_legs_once(spark):
    # Nets were dealt by account, then by transaction for the fees, and once more for the windows.
    legs = tables.all_legs(spark, SF)
    plan = plan_of(transfers.leg_transfers(legs))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # The legs (for nets, fees and minted coins, one shuffle used again), and blocks' totals and coinbases.
    assert exchanges and not any("address" in line for line in exchanges)
    assert sum("ENSURE_REQUIREMENTS" in line for line in exchanges) == 1
    whole = sorted(transfers.leg_transfers(legs).collect())
    assert whole and whole == sorted(transfers.leg_transfers(legs, rows_per_chunk=200).collect())
    assert whole == sorted(transfers.model_transfers(transfers.net_accounts(legs)).collect())


def test_last_versions_are_found_in_the_ranges_they_are_laid_out_in(spark):
    # Compacting shuffled by key and then by range, with a sort before and after the first.
    rows = [(2, "202401", 1, 0, "a", 1.0), (1, "202401", 1, 0, "a", 2.0), (1, "202401", 1, 0, "b", 3.0)]
    table = spark.createDataFrame(rows, "version bigint, month string, height int, txPos int, address string, value double")
    table = checkpointed(table.withColumn("dt", F.timestamp_seconds(F.col("version"))))
    last = sinks._last_written(table.repartitionByRange("month", "height"), ["month"])
    assert sorted(last.select("address", "version", "value").collect()) == [("a", 2, 1.0), ("b", 1, 3.0)]
    plan = plan_of(last)
    assert plan.count("Exchange") == 1 and plan.count("Sort") == 1
