"""From raw blocks to published changes, in batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.scripts import with_address
from ..operators.clock import marker_times, monotone_block_time, with_block_time, with_increasing_time_of
from ..operators.entries import OUTPOINT, spent_outpoints
from ..operators.lifo import changes_of, public_stack_changes, stack_changes
from ..operators.matching import match_spends_strict, tx_legs, unspent_changes
from ..operators.netting import account_changes, net_changes
from ..operators.sketches import address_sketches, sketched_addresses
from ..operators.stack_pages import StackTables, run_segments
from ..operators.transfers import leg_transfers, transfer_edges
from ..session import CODEC, checkpointed
from ..sources.blocks import confirmed_blocks, from_records, parse_blocks, resume_height, to_records
from ..sources.levels import ROWS_PER_BUCKET, LevelTable
from ..sources.sinks import account_change_records, stack_change_records, transfer_records


def block_entries(blocks: DataFrame) -> DataFrame:
    """Entries with the blocks' own times and the addresses of outputs."""
    return with_address(parse_blocks(blocks))


def block_account_changes(blocks: DataFrame) -> DataFrame:
    """Published account changes of a range of blocks that starts with the first."""
    entries = checkpointed(block_entries(blocks))
    return account_changes(net_changes(with_increasing_time_of(match_spends_strict(entries), entries)))


def block_legs(blocks: DataFrame) -> DataFrame:
    """Both sides of every transaction of a range of blocks; times are the blocks' own."""
    return tx_legs(checkpointed(block_entries(blocks)))


def block_transfers(blocks: DataFrame) -> DataFrame:
    """Sender-to-receiver transfers of a range of blocks that starts with the first."""
    return leg_transfers(block_legs(blocks))


def export_blocks(spark: SparkSession, source: DataFrame, sink: str, confirmations: int = 3) -> None:
    """Append the confirmed blocks that ``sink`` does not have yet, as key/value records."""
    try:
        last = resume_height(from_records(spark.read.schema("key string, value binary").parquet(sink))).first()[0]
    except AnalysisException:
        last = 0
    to_records(confirmed_blocks(source, last, confirmations)).write.mode("append").parquet(sink)


def run(
    spark: SparkSession,
    blocks: DataFrame,
    out: str,
    transfers: bool = True,
    stacks: bool = False,
    edges: bool = False,
    topics: int = 1,
    partitions: int = 1,
) -> None:
    """Write net changes and the record sets that are switched on under ``out``.

    Entries and net changes are written and read back: blocks are parsed once, both
    record sets share the net changes, and a lost executor repeats one stage and
    not the whole job.  A spend without an output to consume fails
    the job, and so does a transaction that pays out more than it takes in.
    """
    block_entries(blocks).write.mode("overwrite").parquet(f"{out}/entries")
    entries = spark.read.parquet(f"{out}/entries")
    matched = with_increasing_time_of(match_spends_strict(entries), entries)
    net_changes(matched).write.mode("overwrite").parquet(f"{out}/net")
    net = spark.read.parquet(f"{out}/net")
    if transfers:
        records = account_change_records(account_changes(net), topics, partitions)
        records.write.mode("overwrite").partitionBy("topic").parquet(f"{out}/transfers")
    if edges:
        legs = checkpointed(tx_legs(entries))
        found = transfer_edges(leg_transfers(legs, strict=True))
        transfer_records(found).write.mode("overwrite").parquet(f"{out}/edges")
    if stacks:
        records = stack_change_records(public_stack_changes(stack_changes(net)), topics, partitions)
        records.write.mode("overwrite").partitionBy("topic").parquet(f"{out}/stacks")


_DONE = "height int, ts bigint, run int, unspent string, pages string, fences string"


def finished_runs(spark: SparkSession, out: str) -> DataFrame | None:
    """``run``, last ``height`` and ``ts``, and listed tables of the finished runs of :func:`run_next`; ``None`` before the first."""
    try:
        return spark.read.schema(_DONE).parquet(f"{out}/done")
    except AnalysisException:
        return None


def _last_run(spark: SparkSession, out: str) -> Row | None:
    done = finished_runs(spark, out)
    return None if done is None else done.orderBy(F.col("run").desc()).first()


def read_runs(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The table ``name`` of all finished runs; what a broken run left behind is not read."""
    before = _last_run(spark, out)
    last = -1 if before is None else before["run"]
    return spark.read.parquet(f"{out}/{name}").where(F.col("run") <= last).drop("run")


def _unspent_table(out: str, before: Row | None, **settings) -> LevelTable:
    return LevelTable.of(f"{out}/unspent", OUTPOINT, before and before["unspent"], **settings)


def _stack_tables(out: str, before: Row | None, **settings) -> StackTables:
    return StackTables.of(out, before and before["pages"], before and before["fences"], **settings)


def unspent_after_runs(spark: SparkSession, out: str) -> DataFrame | None:
    """The unspent outputs that the finished runs leave."""
    return _unspent_table(out, _last_run(spark, out)).rows(spark)


def open_segments_after_runs(spark: SparkSession, out: str) -> DataFrame:
    """The open stack segments that the finished runs leave."""
    return _stack_tables(out, _last_run(spark, out)).open_segments(spark)


def active_addresses_after_runs(spark: SparkSession, out: str, period: str = "day") -> DataFrame:
    """Approximate distinct addresses per ``period`` over the finished runs, from what each run kept of its days."""
    return sketched_addresses(read_runs(spark, out, "sketches"), period)


def run_next(
    spark: SparkSession,
    blocks: DataFrame,
    out: str,
    confirmations: int = 3,
    stacks: bool = True,
    edges: bool = True,
    sketches: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> bool:
    """Process the confirmed blocks after those of the runs before, and say whether there were any.

    Each run writes its rows of ``net``, ``stacks`` and ``transfers``, a sketch of each day's addresses
    (``sketches``), and what it changes in the tables that the next one starts from: the ``unspent`` outputs with addresses and
    kinds, and the ``pages`` of the stacks.  Of these a run reads what its outpoints and the
    depth of its spends call for, and writes what they change.  ``done`` has the last
    height and time and lists the tables' segments; it is
    written last, so a run that broke off is written again under the same number and
    leaves no row twice.  Switches and ``rows_per_bucket`` must stay the same from run to run.

    Inputs are matched once; net changes, transfers and the changes of the unspent outputs come from the same matched rows.
    """
    before = _last_run(spark, out)
    number = 0 if before is None else before["run"] + 1
    new = confirmed_blocks(blocks, -1 if before is None else before["height"], confirmations)

    def put(df: DataFrame, name: str) -> DataFrame:
        path = f"{out}/{name}/run={number}"
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    # Nothing reads the scripts once their addresses are known.
    entries = put(block_entries(new).drop("script"), "entries")
    times = put(monotone_block_time(marker_times(entries), after=None if before is None else before["ts"]), "times")
    end = times.agg(F.max("height").alias("height"), F.max("ts").alias("ts")).first()
    if end["height"] is None:
        return False
    unspent = _unspent_table(out, before, rows_per_bucket=rows_per_bucket)
    # An outpoint that is only created needs nothing of before: the new output holds.
    parents = unspent.lookup(spent_outpoints(entries))
    if parents is not None:
        parents = put(parents, "parents")
    legs = put(tx_legs(entries, unspent=parents, with_ends=True), "legs")
    signed = legs.withColumn("value", F.when(F.col("is_input"), -F.col("value")).otherwise(F.col("value")))
    net = put(net_changes(with_block_time(signed, times)), "net")
    if sketches:
        put(address_sketches(net), "sketches")
    if edges:
        put(leg_transfers(legs, strict=True), "transfers")
    unspent = unspent.with_run(unspent_changes(entries, parents, legs), number)
    tables = _stack_tables(out, before, rows_per_bucket=rows_per_bucket)
    if stacks:
        found, pages, fences = run_segments(net, tables)
        put(changes_of(found), "stacks")
        tables = tables.with_run(put(pages, "page-changes"), put(fences, "fence-changes"), number)
    listed = [unspent.listing(), tables.pages.listing(), tables.fences.listing()]
    put(spark.createDataFrame([(end["height"], end["ts"], *listed)], _DONE.replace(" run int,", "")), "done")
    return True
