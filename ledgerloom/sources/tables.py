"""Ledger-shaped views of the sample tables.

The sample tables hold no chain data, so these adapters read their rows as
ledger records.  All amounts are integers after the first rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.amounts import epoch_seconds
from ..operators.ordered import row_number, running

TXS_PER_BLOCK = 100
EPOCH_1995 = 9131  # days from 1970-01-01 to 1995-01-01
FIRST_BLOCK_TIME = 1_500_000_000
BLOCK_INTERVAL = 600
SUBSIDY = 5_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def _name(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as balance changes of users; purchases and errors spend."""
    value = _cents("value")
    return (
        table(spark, sf_dir, "events")
        .select(
            (F.col("event_id") + 1).alias("ts"),
            (F.col("event_id") + 1).cast("int").alias("height"),
            F.lit(0).alias("tx_pos"),
            F.when(F.col("event_type").isin("purchase", "error"), -value).otherwise(value).alias("value"),
            _name("u", "user_id").alias("address"),
        )
        .where(F.col("value") != 0)
    )


def dated_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`changes`, with the event's own time in ``ts``."""
    return (
        table(spark, sf_dir, "events")
        .where(_cents("value") != 0)
        .select(epoch_seconds("ts").alias("ts"), _name("u", "user_id").alias("address"))
    )


def _line_hash() -> Column:
    digest = F.sha2(
        F.concat_ws(
            "|",
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            _cents("l_extendedprice"),
            _cents("l_discount"),
            F.unix_date(F.col("l_shipdate").cast("date")),
        ),
        256,
    )
    return F.unhex(digest).alias("tx_hash")


def line_outpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outpoints of :func:`entries`, once each."""
    index = F.col("l_linenumber").cast("bigint").alias("out_index")
    return table(spark, sf_dir, "lineitem").select(_line_hash(), index)


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` and ``orders`` as outputs (at the order date) and their spends (at shipping).

    An outpoint's hash covers the whole line, so copies of a line create the same
    outpoint again, and a large order does not become one large group.
    """
    outputs = [
        _line_hash(),
        F.col("l_linenumber").cast("bigint").alias("out_index"),
        _name("s", "l_suppkey").alias("address"),
        _cents("l_extendedprice").alias("sat"),
        (F.unix_date(F.col("l_shipdate").cast("date")) - EPOCH_1995).alias("spent"),
        (F.lit(100_000) + F.col("l_partkey") % 50).cast("int").alias("spend_pos"),
    ]
    dates = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        (F.unix_date(F.col("o_orderdate").cast("date")) - EPOCH_1995).alias("created"),
    )
    sides = F.array(
        F.struct(
            F.col("created").alias("height"),
            F.lit(1).alias("tx_pos"),
            F.lit(False).alias("is_input"),
            F.col("address"),
            F.col("sat").alias("value"),
        ),
        F.struct(
            F.col("spent").alias("height"),
            F.col("spend_pos").alias("tx_pos"),
            F.lit(True).alias("is_input"),
            F.lit(None).cast("string").alias("address"),
            F.lit(None).cast("bigint").alias("value"),
        ),
    )
    # Digests are made after the join, so that their random bytes do not go through its shuffle.
    return (
        table(spark, sf_dir, "lineitem")
        .join(dates, "l_orderkey")
        .select("created", *outputs)
        .select("tx_hash", "out_index", F.inline(sides))
        .select(
            (F.col("height").cast("bigint") * 86400).alias("ts"),
            "height",
            "tx_pos",
            "tx_hash",
            "out_index",
            F.lit(0).alias("entry_idx"),
            "is_input",
            F.lit(False).alias("is_marker"),
            "address",
            "value",
        )
    )


def _block_time(height: Column) -> Column:
    return F.lit(FIRST_BLOCK_TIME) + height.cast("bigint") * BLOCK_INTERVAL


def legs(spark: SparkSession, sf_dir: str, taxed: bool = False) -> DataFrame:
    """``lineitem`` as payments: parts pay suppliers, the discount is the fee.

    One row per input or output with a positive ``value``; ``kind`` is the
    address kind.  Transactions are orders, 100 to a block, and every block has
    a coinbase paying the customers of its orders.  With ``taxed`` the tax is paid
    out on top, so that some transactions pay out more than they take in.
    """
    sat = _cents("l_extendedprice")
    percent = _cents("l_discount") - _cents("l_tax") if taxed else _cents("l_discount")
    height = F.floor(F.col("l_orderkey") / TXS_PER_BLOCK).cast("int")
    supplier_kind = F.when(F.col("l_suppkey") % 2 == 0, "P2PKH").otherwise("P2SH")
    sides = F.array(
        F.struct(
            F.lit(True).alias("is_input"),
            _name("p", "l_partkey").alias("address"),
            F.lit("P2PKH").alias("kind"),
            F.col("sat").alias("value"),
        ),
        F.struct(
            F.lit(False).alias("is_input"),
            _name("s", "l_suppkey").alias("address"),
            supplier_kind.alias("kind"),
            F.expr("(sat * (100 - percent)) div 100").alias("value"),
        ),
    )
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("sat", sat)
        .withColumn("percent", percent)
        .select(
            height.alias("height"),
            _block_time(height).alias("ts"),
            (F.col("l_orderkey") % TXS_PER_BLOCK + 1).cast("int").alias("tx_pos"),
            F.concat(F.lit("t"), F.col("l_orderkey").cast("string")).alias("tx_hash"),
            F.lit(False).alias("is_coinbase"),
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "sat",
            "percent",
            F.inline(sides),
        )
    )


def coinbase_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as the outputs of each block's coinbase transaction."""
    height = F.floor(F.col("o_orderkey") / TXS_PER_BLOCK).cast("int")
    return table(spark, sf_dir, "orders").select(
        height.alias("height"),
        _block_time(height).alias("ts"),
        F.lit(0).alias("tx_pos"),
        F.concat(F.lit("b"), height.cast("string")).alias("tx_hash"),
        F.lit(True).alias("is_coinbase"),
        F.lit(False).alias("is_input"),
        _name("c", "o_custkey").alias("address"),
        F.lit("P2WPKH").alias("kind"),
        (F.lit(SUBSIDY) + _cents("o_totalprice")).alias("value"),
        (F.col("o_orderkey") % TXS_PER_BLOCK).alias("entry_idx"),
    )


LEG = ["height", "ts", "tx_pos", "tx_hash", "is_coinbase", "is_input", "address", "kind", "value"]


def all_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments and coinbases."""
    return legs(spark, sf_dir).select(*LEG).unionByName(coinbase_legs(spark, sf_dir).select(*LEG))


def numbered_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`all_legs`, with each entry's position among the inputs or outputs of its transaction."""
    by_line = ["l_linenumber", "l_partkey", "l_suppkey", "sat", "percent"]
    payments = running(
        legs(spark, sf_dir), ["height", "tx_pos", "tx_hash", "is_input"], by_line, {"n": row_number()}
    ).select(*LEG, (F.col("n") - 1).alias("entry_idx"))
    return payments.unionByName(coinbase_legs(spark, sf_dir).select(*LEG, "entry_idx"))


def block_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as block headers whose times sometimes run backwards."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("int").alias("height"),
        (epoch_seconds("ts") - (F.col("event_id") % 7) * 600).alias("raw_ts"),
    )


def scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as locking scripts of eight shapes, built around a digest of the name."""
    digest = F.upper(F.sha2("c_name", 256))
    short = F.substring(digest, 1, 40)
    hexed = (
        F.when(F.col("shape") == 0, F.concat(F.lit("76A914"), short, F.lit("88AC")))
        .when(F.col("shape") == 1, F.concat(F.lit("2102"), digest, F.lit("AC")))
        .when(F.col("shape") == 2, F.concat(F.lit("A914"), short, F.lit("87")))
        .when(F.col("shape") == 3, F.concat(F.lit("0014"), short))
        .when(F.col("shape") == 4, F.concat(F.lit("0020"), digest))
        .when(F.col("shape") == 5, F.concat(F.lit("6A20"), digest))
        .when(F.col("shape") == 6, F.concat(F.lit("512102"), digest, F.lit("2103"), digest, F.lit("52AE")))
        .otherwise(F.concat(F.lit("76A914"), short, F.lit("88ACAC")))
    )
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", (F.col("c_custkey") % 8).alias("shape"))
        .select("c_custkey", F.unhex(hexed).alias("script"))
    )


def hash_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as locking scripts whose addresses need no curve arithmetic."""
    digest = F.upper(F.sha2("c_name", 256))
    short = F.substring(digest, 1, 40)
    hexed = (
        F.when(F.col("shape") == 0, F.concat(F.lit("76A914"), short, F.lit("88AC")))
        .when(F.col("shape") == 1, F.concat(F.lit("A914"), short, F.lit("87")))
        .when(F.col("shape") == 2, F.concat(F.lit("0014"), short))
        .when(F.col("shape") == 3, F.concat(F.lit("0020"), digest))
        .when(F.col("shape") == 4, F.concat(F.lit("76A914"), short, F.lit("88ACAC")))
        .otherwise(F.concat(F.lit("6A20"), digest))
    )
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", (F.col("c_custkey") % 6).alias("shape"))
        .select("c_custkey", F.unhex(hexed).alias("script"))
    )


# The curve's generator, twice the generator, the generator in plain form, and no point of the curve.
KEYS = [
    "0279BE667EF9DCBBAC55A06295CE870B07029BFCDB2DCE28D959F2815B16F81798",
    "02C6047F9441ED7D6D3045406E95C07CD85C778E4B8CEF3CA7ABAC09B95C709EE5",
    "0479BE667EF9DCBBAC55A06295CE870B07029BFCDB2DCE28D959F2815B16F81798"
    "483ADA7726A3C4655DA4FBFC0E1108A8FD17B448A68554199C47D08FFB10D4B8",
]
NO_KEY = "02" + "00" * 31 + "05"


def key_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as scripts of well-known keys: paid to keys, to several keys, and cut off."""
    pushes = F.array(*[F.lit(f"{len(key) // 2:02X}{key}") for key in KEYS])
    at = (F.floor(F.col("c_custkey") / 8) % 3).cast("int")
    one, two, bad = pushes[at], pushes[(at + 1) % 3], F.lit(f"21{NO_KEY}")
    digest = F.upper(F.sha2("c_name", 256))
    shapes = [
        F.concat(one, F.lit("AC")),
        F.concat(F.lit("4C"), one, F.lit("AC")),
        F.concat(bad, F.lit("AC")),
        F.concat(F.lit("51"), one, two, F.lit("52AE")),
        F.concat(F.lit("51"), one, bad, F.lit("52AE")),
        F.concat(F.lit("52"), one, bad, two, F.lit("53AE")),
        F.concat(F.lit("4DFFFF"), digest),
        F.concat(F.lit("51"), one, F.lit("52AE")),
    ]
    hexed = F.array(*shapes)[(F.col("c_custkey") % 8).cast("int")]
    return table(spark, sf_dir, "customer").select("c_custkey", F.unhex(hexed).alias("script"))


_COINBASE_KEYS = 97  # distinct miners


def _reversed(digits: Column, size: int) -> Column:
    return F.concat(*[F.substring(digits, 2 * i - 1, 2) for i in range(size, 0, -1)])


def _le(value: Column, size: int) -> Column:
    return _reversed(F.lpad(F.hex(value), 2 * size, "0"), size)


def _short_digest(text: Column) -> Column:
    return F.upper(F.substring(F.sha2(text, 256), 1, 40))


def _sha256d(digits: Column) -> Column:
    return F.upper(F.sha2(F.unhex(F.sha2(F.unhex(digits), 256)), 256))


def _coinbase_tx(height: Column) -> Column:
    miner = _short_digest((height % _COINBASE_KEYS).cast("string"))
    return F.concat(
        F.lit("0100000001" + "00" * 32 + "FFFFFFFF04"),
        _le(height, 4),
        F.lit("FFFFFFFF01"),
        _le(height + SUBSIDY, 8),
        F.lit("1976A914"),
        miner,
        F.lit("88AC00000000"),
    )


def raw_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as serialized blocks.

    A height given twice is one block.  Each block has a coinbase and, but for the first, one transaction that spends
    the coinbase of the block before; in odd blocks it carries witness data.
    """
    height = F.col("event_id")
    header = F.concat(
        F.lit("01000000" + "00" * 64),
        _le(epoch_seconds("ts") - (height % 7) * 600, 4),
        F.lit("00" * 8),
    )
    cents = F.round(F.col("value") * 100).cast("bigint")
    odd = height % 2 == 1
    user = F.col("user_id").cast("string")
    spend = F.concat(
        F.lit("01000000"),
        F.when(odd, "0001").otherwise(""),
        F.lit("01"),
        _sha256d(_coinbase_tx(height - 1)),
        F.lit("0000000000FFFFFFFF02"),
        _le(height + 4_000_000_000, 8),
        F.lit("160014"),
        _short_digest(user),
        _le(F.lit(999_999_999) - cents, 8),
        F.lit("17A914"),
        _short_digest(F.concat(F.lit("s"), user)),
        F.lit("87"),
        F.when(odd, "0102ABCD").otherwise(""),
        F.lit("00000000"),
    )
    body = F.when(height == 0, F.concat(F.lit("01"), _coinbase_tx(height))).otherwise(
        F.concat(F.lit("02"), _coinbase_tx(height), spend)
    )
    latest = F.max(F.struct("ts", "user_id", "value")).alias("e")
    unique = table(spark, sf_dir, "events").groupBy("event_id").agg(latest).select("event_id", "e.*")
    return unique.select(height.cast("int").alias("height"), F.unhex(F.concat(header, body)).alias("bytes"))
