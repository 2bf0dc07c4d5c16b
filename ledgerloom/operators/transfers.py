"""Fees, minted coins and sender-to-receiver transfers of transactions."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import to_coin
from .netting import net_by_account
from .ordered import ROWS_PER_CHUNK, heavy_keys, last_value, running, running_sum, windowed

TX = ["height", "ts", "tx_pos", "tx_hash"]
# A transaction is known by its place in the chain.
_TX_KEY = ["height", "tx_pos"]


def tx_totals(legs: DataFrame) -> DataFrame:
    """Sums of both sides per transaction; a coinbase has no inputs and so no fee."""
    value = F.col("value")
    return (
        legs.groupBy(*TX, "is_coinbase")
        .agg(
            F.coalesce(F.sum(F.when(F.col("is_input"), value)), F.lit(0)).alias("input_value"),
            F.coalesce(F.sum(F.when(~F.col("is_input"), value)), F.lit(0)).alias("output_value"),
        )
        .withColumn(
            "fee", F.when(F.col("is_coinbase"), F.lit(0)).otherwise(F.col("input_value") - F.col("output_value"))
        )
    )


def tx_fees(legs: DataFrame) -> DataFrame:
    """Inputs, outputs and fee of every transaction that is not a coinbase."""
    return tx_totals(legs.where(~F.col("is_coinbase"))).drop("is_coinbase")


def block_minting(legs: DataFrame) -> DataFrame:
    """Fees, miner reward and newly minted coins per block."""
    reward = F.when(F.col("is_coinbase"), F.col("output_value")).otherwise(0)
    return (
        tx_totals(legs)
        .groupBy("height", "ts")
        .agg(
            F.sum("fee").alias("fees"),
            F.sum(reward).alias("reward"),
            F.max(F.when(F.col("is_coinbase"), F.col("tx_hash"))).alias("coinbase_hash"),
            F.count(F.lit(1)).alias("txs"),
        )
        .withColumn("minted", F.col("reward") - F.col("fees"))
    )


def unbalanced_txs(legs: DataFrame) -> DataFrame:
    """Transactions whose outputs exceed their inputs."""
    return tx_fees(legs).where(F.col("fee") < 0)


def leg_transfers(legs: DataFrame, strict: bool = False, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Transfers of the transactions whose ``legs`` are given.

    One shuffle by block serves fees, minted coins, netting and the reconstruction, unless a
    block is too large for one task.
    """
    _, heavy = heavy_keys(legs, ["height"], rows_per_chunk)
    if heavy:
        return model_transfers(net_accounts(legs, strict), rows_per_chunk, sized_by=legs)
    return _laid_out(_accounts_by_block(legs, strict), windowed)


def _accounts_by_block(legs: DataFrame, strict: bool) -> DataFrame:
    """As :func:`net_accounts`, in one pass over legs that lie by block.

    The first leg of a transaction brings its virtual accounts along.
    """
    tx = [*TX, "is_coinbase"]
    value, coinbase = F.col("value"), F.col("is_coinbase")
    excess, fees, reward = F.col("_excess"), F.col("_fees"), F.col("_reward")
    in_order = Window.partitionBy("height").orderBy(*tx[1:])
    of_tx, of_block = Window.partitionBy(*tx), Window.partitionBy("height", "ts")
    signed = F.when(F.col("is_input"), -value).otherwise(value)
    # All three windows use the order of the first.
    placed = legs.select(*tx, "address", "kind", signed.alias("value")).withColumn("_at", F.row_number().over(in_order))
    summed = placed.withColumns({"_excess": F.sum("value").over(of_tx), "_first": F.min("_at").over(of_tx)}).withColumns(
        {
            "_fees": F.sum(F.when(~coinbase, -value)).over(of_block),
            "_reward": F.sum(F.when(coinbase, value)).over(of_block),
            "_last": F.max(F.when(coinbase, F.struct("tx_pos", "tx_hash"))).over(of_block),
        }
    )
    fee = -excess
    if strict:
        fee = F.when(excess > 0, _exceeds().cast("bigint")).otherwise(fee)

    def account(address: Column, kind: Column, value: Column, virtual: bool) -> Column:
        return F.struct(
            F.lit(virtual).alias("virtual"), address.alias("address"), kind.alias("kind"), value.alias("value")
        )

    def payer(name: str, value: Column) -> Column:
        return account(F.lit(name), F.lit("virtual"), value, True)

    own = account(F.col("address"), F.col("kind"), value, False)
    no_fees = F.coalesce(fees, F.lit(0))
    minting = coinbase & (F.struct("tx_pos", "tx_hash") == F.col("_last"))
    accounts = (
        F.when(F.col("_at") != F.col("_first"), F.array(own))
        .when(~coinbase, F.array(own, payer("fee", fee)))
        .when(minting, F.array(own, payer("fee", -no_fees), payer("mint", no_fees - F.coalesce(reward, F.lit(0)))))
        .otherwise(F.array(own))
    )
    return (
        summed.select(*tx, F.inline(accounts))
        .groupBy(*tx, "virtual", "address", "kind")
        .agg(F.sum("value").alias("value"))
        .where(F.col("value") != 0)
        .select(*TX, "address", "kind", "value")
    )


def _exceeds() -> Column:
    return F.raise_error(F.concat_ws(", ", F.lit("outputs exceed inputs"), "height", "tx_pos", "tx_hash"))


def net_accounts(legs: DataFrame, strict: bool = False) -> DataFrame:
    """Non-zero net value per transaction and account, completed with virtual accounts.

    Ordinary transactions pay their fee to ``fee``; a coinbase is paid by ``fee``
    and ``mint``.  A transaction's excess of outputs over inputs is the sum of its
    nets, so fees and minted coins come from the netted rows and share their
    shuffle.  With ``strict`` a transaction that pays out more than it takes in
    fails the job; ``unbalanced_txs`` lists those.
    """
    nets = net_by_account(legs, "is_coinbase")
    excess, coinbase = F.col("excess"), F.col("is_coinbase")
    per_tx = nets.groupBy(*TX, "is_coinbase").agg(F.sum("value").alias("excess"))
    virtual = F.lit("virtual").alias("kind")
    fee = F.when(coinbase, F.lit(0)).otherwise(-excess)
    if strict:
        fee = F.when(fee < 0, _exceeds().cast("bigint")).otherwise(fee)
    fees = per_tx.select(*TX, F.lit("fee").alias("address"), virtual, fee.alias("value"))
    payers = F.array(
        F.struct(F.lit("fee").alias("address"), (-F.col("fees")).alias("value")),
        F.struct(F.lit("mint").alias("address"), (F.col("fees") - F.col("reward")).alias("value")),
    )
    minted = (
        per_tx.groupBy("height", "ts")
        .agg(
            F.sum(F.when(coinbase, F.lit(0)).otherwise(-excess)).alias("fees"),
            F.sum(F.when(coinbase, excess).otherwise(F.lit(0))).alias("reward"),
            F.max(F.when(coinbase, F.struct("tx_pos", "tx_hash"))).alias("coinbase"),
        )
        .where(F.col("coinbase").isNotNull())
        .select("height", "ts", "coinbase.tx_pos", "coinbase.tx_hash", F.inline(payers))
        .select(*TX, "address", virtual, "value")
    )
    real = nets.select(*TX, "address", "kind", "value")
    return real.unionByName(fees).unionByName(minted).where(F.col("value") != 0)


def model_transfers(
    net: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK, sized_by: DataFrame | None = None
) -> DataFrame:
    """Transfers inside each transaction: largest payer pays largest receiver first.

    Lay payers and receivers of a transaction end to end, largest first, as two
    rows of intervals over the same length.  Every point where an interval starts
    begins a transfer between the payer and the receiver covering it, which ends
    where the first of the two intervals ends.  The work is linear in the number
    of accounts: two running computations, no pairs.

    ``sized_by`` may name the legs ``net`` comes from; it is then searched for very
    large transactions in place of ``net``.
    """
    _, heavy = heavy_keys(net if sized_by is None else sized_by, _TX_KEY, rows_per_chunk)
    if heavy:
        return _laid_out(net, partial(running, rows_per_chunk=rows_per_chunk))
    # Both windows can use one shuffle by transaction.
    return _laid_out(net.repartition(*_TX_KEY), windowed)


def _laid_out(net: DataFrame, scan: Callable[..., DataFrame]) -> DataFrame:
    sized = net.withColumn("side", F.when(F.col("value") < 0, 0).otherwise(1)).withColumn(
        "rank", -F.abs("value")
    )
    laid = scan(
        sized, [*_TX_KEY, "side"], ["rank", "address", "kind"], {"until": running_sum(-F.col("rank"))}
    ).withColumn("start", F.col("until") + F.col("rank"))
    account = F.struct("address", "kind", "until")
    owned = scan(
        laid,
        _TX_KEY,
        ["start", "side"],
        {
            "payer": last_value(F.when(F.col("side") == 0, account)),
            "receiver": last_value(F.when(F.col("side") == 1, account)),
        },
    )
    amount = F.least("payer.until", "receiver.until") - F.col("start")
    return (
        owned.where(F.col("payer").isNotNull() & F.col("receiver").isNotNull())
        .select(
            *TX,
            F.col("payer.address").alias("from"),
            F.col("payer.kind").alias("from_kind"),
            F.col("receiver.address").alias("to"),
            F.col("receiver.kind").alias("to_kind"),
            amount.alias("amount"),
        )
        .where(F.col("amount") > 0)
    )


def transfer_edges(transfers: DataFrame) -> DataFrame:
    """Published form of transfers, an edge list."""
    return transfers.select(
        "from",
        "to",
        to_coin("amount").alias("value"),
        F.col("height").alias("blockNumber"),
        F.col("ts").alias("timestamp"),
        F.col("tx_hash").alias("transactionHash"),
    )


def unmatched_sides(net: DataFrame) -> DataFrame:
    """Transactions whose payers and receivers do not cover each other."""
    return net.groupBy(*TX).agg(F.sum("value").alias("excess")).where(F.col("excess") != 0)


def processed_txs(
    legs: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK, sized_by: DataFrame | None = None
) -> DataFrame:
    """Transactions as rows with ordered input and output arrays.

    ``legs`` carry ``entry_idx``, the position on their side.  A transaction is one
    row; it is part of a block, which is one value already, and so bounded.  The
    coins minted by a block follow its last transaction as a payment by ``mint``.
    One shuffle by block serves both, unless a block is too large for one task.  ``sized_by`` may
    name a frame with the same blocks that is cheaper to read.
    """
    _, heavy = heavy_keys(legs if sized_by is None else sized_by, ["height"], rows_per_chunk)
    if not heavy:
        columns = [*TX, "is_coinbase", "is_input", "entry_idx", "address", "value"]
        legs = legs.select(*columns).repartition("height")
    entry = F.struct("entry_idx", "address", "value")

    def side(is_input: bool):
        listed = F.collect_list(F.when(F.col("is_input") == is_input, entry))
        return F.transform(F.array_sort(listed), lambda e: F.struct(e["address"], e["value"]))

    txs = legs.groupBy("ts", "height", "tx_pos").agg(
        side(True).alias("inputs"), side(False).alias("outputs")
    )
    minted = block_minting(legs).select(
        "ts",
        "height",
        F.col("txs").cast("int").alias("tx_pos"),
        F.array(F.struct(F.lit("mint").alias("address"), F.col("minted").alias("value"))).alias("inputs"),
        F.expr("cast(array() as array<struct<address:string,value:bigint>>)").alias("outputs"),
    )
    return txs.unionByName(minted)
