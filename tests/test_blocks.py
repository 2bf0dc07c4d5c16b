"""Raw blocks, block times, resuming, publishing."""

import datetime as dt
import random
import struct

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.encoding import sha256d
from ledgerloom.functions.sharding import partition_of, string_hash, topic_of
from ledgerloom.operators import clock, matching, transfers
from ledgerloom.operators.lifo import public_stack_changes, stack_changes
from ledgerloom.operators.netting import account_changes, transfer_table
from ledgerloom.plans import pipeline
from ledgerloom.sources import blocks, sinks
from ledgerloom.sources.tables import raw_blocks

SF = "/root/testdata/sf0.001"
GENESIS_TX = (
    "01000000010000000000000000000000000000000000000000000000000000000000000000ffffffff4d04ffff001d0104455468652054"
    "696d65732030332f4a616e2f32303039204368616e63656c6c6f72206f6e206272696e6b206f66207365636f6e64206261696c6f757420"
    "666f722062616e6b73ffffffff0100f2052a01000000434104678afdb0fe5548271967f1a67130b7105cd6a828e03909a67962e0ea1f61"
    "deb649f6bc3f4cef38c4f35504e51ec112de5c384df7ba0b8d578a4c702b6bf11d5fac00000000"
)
GENESIS = (
    "0100000000000000000000000000000000000000000000000000000000000000000000003ba3edfd7a7b12b27ac72c3e67768f617fc81bc3"
    "888a51323a9fb8aa4b1e5e4a29ab5f49ffff001d1dac2b7c01" + GENESIS_TX
)


def test_first_block_of_the_chain(spark):
    df = spark.createDataFrame([(0, bytes.fromhex(GENESIS))], blocks.RAW_BLOCK)
    got = blocks.parse_blocks(df).orderBy("is_marker").collect()
    assert len(got) == 2
    output, marker = got
    assert output.ts == 1231006505 and output.value == 5_000_000_000 and not output.is_input
    assert output.tx_hash.hex() == "4a5e1e4baab89f3a32518a88c31bc87f618f76673e2cc77ab2127b7afdeda33b"
    assert marker.is_marker and marker.tx_pos == 1 and marker.tx_hash is None
    assert clock.raw_block_times(df).first().raw_ts == 1231006505


def test_long_counts_and_witness(spark):
    outputs = 300  # needs a three-byte count
    body = b"\1" + b"\7" * 32 + struct.pack("<I", 5) + b"\0" + b"\xff" * 4
    body += b"\xfd" + struct.pack("<H", outputs) + (struct.pack("<q", 9) + b"\1\x51") * outputs
    tx = b"\1\0\0\0" + b"\0\1" + body + b"\2\3abc\0" + b"\0" * 4
    block = bytes(80) + b"\1" + tx
    got = blocks.parse_blocks(spark.createDataFrame([(1, block)], blocks.RAW_BLOCK)).collect()
    assert len(got) == 1 + outputs + 1
    assert got[0].is_input and got[0].tx_hash == b"\7" * 32 and got[0].out_index == 5
    plain = b"\1\0\0\0" + body + b"\0" * 4
    assert {r.tx_hash for r in got if not r.is_input and not r.is_marker} == {sha256d(plain)[::-1]}
    assert [r.entry_idx for r in got[1:-1]] == list(range(outputs))


def test_truncated_block_fails(spark):
    df = spark.createDataFrame([(0, bytes.fromhex(GENESIS)[:-3])], blocks.RAW_BLOCK)
    with pytest.raises(Exception, match="block ends early"):
        blocks.parse_blocks(df).collect()


@pytest.mark.parametrize("width", [3, 50, 1 << 14])
@pytest.mark.parametrize("after", [None, 1060])
def test_block_times_equal_the_loop(spark, width, after):
    rng = random.Random(width)
    raw = {h: 1000 + h * 3 + rng.randrange(-40, 40) for h in range(7, 400) if h % 11}
    headers = spark.createDataFrame(list(raw.items()), "height int, raw_ts bigint").repartition(4)
    got = {r.height: r.ts for r in clock.monotone_block_time(headers, width, after).collect()}
    last, want, back, previous = after, {}, [], None
    for h in sorted(raw):
        last = raw[h] if last is None or raw[h] > last else last + 1
        want[h] = last
        if previous is not None and raw[h] < previous:
            back.append((h, raw[h], previous))
        previous = raw[h]
    assert got == want
    assert sorted(map(tuple, clock.time_regressions(headers, width).collect())) == back


def test_block_times_joined_equal_the_loop(spark):
    source = raw_blocks(spark, SF).where("height < 40")
    entries = blocks.parse_blocks(source)
    times = clock.monotone_block_time(clock.marker_times(entries))
    headers = {r.height: r.raw_ts for r in clock.raw_block_times(source).collect()}
    last, want = None, {}
    for h in sorted(headers):
        last = headers[h] if last is None or headers[h] > last else last + 1
        want[h] = last
    joined = clock.with_block_time(entries, times).collect()
    columns = [c for c in entries.columns if c != "ts"]
    plain = [(want[r.height], *(r[c] for c in columns)) for r in entries.collect()]
    assert sorted(map(str, ((r.ts, *(r[c] for c in columns)) for r in joined))) == sorted(map(str, plain))
    raw = clock.monotone_block_time(clock.raw_block_times(source))
    assert sorted(map(tuple, raw.collect())) == sorted(map(tuple, times.collect()))


def test_equal_and_reversed_times(spark):
    headers = spark.createDataFrame(list(enumerate([10, 9, 9, 20])), "height int, raw_ts bigint")
    got = clock.monotone_block_time(headers).orderBy("height").collect()
    assert [r.ts for r in got] == [10, 11, 12, 20]


def test_resume_height(spark):
    df = spark.createDataFrame([], blocks.RAW_BLOCK)
    assert blocks.resume_height(df).first().height == 0
    records = spark.createDataFrame([(b"1", b"\1\2\3"), (b"2", b"\1\2\4")], "key binary, value binary")
    read = blocks.from_records(records)
    assert blocks.resume_height(read).first().height == 2
    assert [tuple(r) for r in blocks.to_records(read).collect()] == [("1", b"\1\2\3"), ("2", b"\1\2\4")]


def test_confirmed_blocks(spark):
    df = spark.range(1, 21).select(F.col("id").cast("int").alias("height"))
    got = blocks.confirmed_blocks(df, 5, 3)
    assert sorted(r.height for r in got.collect()) == list(range(6, 18))


def java_hash(text):
    h = 0
    data = text.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    return h - 2**32 if h >= 2**31 else h


def test_shards(spark):
    texts = ["", "a", "hello", "1DbhmesUsNZ1hgX7KQtASNU9YRoqk8SiFZ", "multisig:1:2:x:y", "ñandú", "a\U0001f600b", "mint"]
    hashed = string_hash("t")
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", hashed.alias("h"), topic_of(hashed, 4).alias("topic"), partition_of(hashed, 4, 6).alias("part")
    )
    for r in got.collect():
        assert r.h == java_hash(r.t), r.t
        assert (r.topic, r.part) == (r.h % 4, r.h // 4 % 6)


def small_net(spark):
    rows = [(86400 * 40 * i, i, i % 3, v, f"a{i % 4}") for i, v in enumerate([5, -3, 10**15, -7, 2, -9, 4])]
    return spark.createDataFrame(rows, "ts bigint, height int, tx_pos int, value bigint, address string")


def test_records_and_back(spark, tmp_path):
    changes = account_changes(small_net(spark))
    records = sinks.account_change_records(changes, 2, 3)
    keys = {r.key for r in records.collect()}
    assert "0-0-a0" in keys and len(keys) == 7
    records.select("value").write.text(str(tmp_path / "lines"))
    want = {tuple(r) for r in changes.collect()}
    assert {tuple(r) for r in sinks.read_account_changes(spark, str(tmp_path / "lines")).collect()} == want
    assert {tuple(r) for r in sinks.parse_account_changes(records).collect()} == want
    stacks = sinks.stack_change_records(public_stack_changes(stack_changes(small_net(spark))))
    assert {"a0-1-A", "a1-1-A", "a1-1-D"} <= {r.key for r in stacks.collect()}


def test_monthly_table_collapses_rewrites(spark, tmp_path):
    table = transfer_table(account_changes(small_net(spark)))
    for _ in range(2):
        sinks.write_monthly(table, str(tmp_path / "m"))
    assert sorted(p.name for p in (tmp_path / "m").glob("month=*")) == [
        "month=197001", "month=197002", "month=197003", "month=197005", "month=197006", "month=197007", "month=197008",
    ]
    back = sinks.read_monthly(spark, str(tmp_path / "m")).select(*table.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))


def test_the_later_write_of_a_monthly_record_holds(spark, tmp_path):
    path, schema = str(tmp_path / "m"), "dt timestamp, height int, txPos int, out int, value double, address string"
    month = [dt.datetime(1970, m, 3) for m in range(1, 6)]
    one = [(month[k], k, 0, 1, 5.0, f"a{k}") for k in range(4)]
    assert sinks.write_monthly(spark.createDataFrame(one, schema), path) == 1
    assert sinks.compact_monthly(spark, path) == []
    # A smaller value at the same time, and a record that moves to another month and back.
    two = [(month[1], 1, 0, 1, 2.0, "a1"), (month[4], 2, 0, 1, 9.0, "a2")]
    assert sinks.write_monthly(spark.createDataFrame(two, schema), path) == 2
    want = {one[0], two[0], two[1], one[3]}
    columns = schema.replace(",", "").split()[::2]

    def held():
        return {tuple(r) for r in sinks.read_monthly(spark, path).select(*columns).collect()}

    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "m" / "month=197001").glob("*.parquet")}
    assert held() == want
    assert sinks.compact_monthly(spark, path) == ["197002"]
    assert sinks.compact_monthly(spark, path) == []
    assert held() == want
    assert spark.read.parquet(path).where("month = 197002").count() == 1
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "m" / "month=197001").glob("*.parquet")}
    assert sinks.write_monthly(spark.createDataFrame([one[2]], schema), path) == 3
    assert held() == {one[0], two[0], one[2], one[3]}
    assert sinks.write_monthly(spark.createDataFrame(one, schema), path, "overwrite") == 1
    assert held() == set(one)


def test_strict_match_names_the_missing_output(spark):
    entry = (
        "ts bigint, height int, tx_pos int, tx_hash binary, out_index bigint, entry_idx int, "
        "is_input boolean, is_marker boolean, value bigint, address string"
    )
    df = spark.createDataFrame([(5, 6, 7, b"x", 8, 0, True, False, None, None)], entry)
    with pytest.raises(Exception, match="output not found, 6, 5, 7, 8"):
        matching.match_spends_strict(df).collect()


def test_spend_in_the_same_block_and_created_again(spark):
    entry = (
        "ts bigint, height int, tx_pos int, tx_hash string, out_index bigint, entry_idx int, "
        "is_input boolean, is_marker boolean, value bigint, address string"
    )
    rows = [
        (1, 1, 1, "t", 0, 0, False, False, 5, "a"),
        (1, 1, 2, "t", 0, 0, True, False, None, None),  # same block
        (2, 2, 0, "t", 0, 0, False, False, 6, "b"),
        (3, 3, 0, "t", 0, 0, False, False, 7, "c"),  # replaces the one above
        (4, 4, 0, "t", 0, 0, True, False, None, None),
        (5, 5, 0, "t", 0, 0, True, False, None, None),  # nothing left
        (5, 5, 1, None, None, 0, False, True, None, None),
    ]
    df = spark.createDataFrame(rows, entry)
    got = {tuple(r) for r in matching.match_spends(df).select("height", "tx_pos", "value", "address").collect()}
    assert got == {(1, 1, 5, "a"), (1, 2, -5, "a"), (2, 0, 6, "b"), (3, 0, 7, "c"), (4, 0, -7, "c")}
    assert [r.height for r in matching.missing_outputs(df).collect()] == [5]
    assert matching.unspent_outputs(df, 3).first().value == 7
    assert matching.unspent_outputs(df).count() == 0
    assert matching.unspent_within(df, 3, 1).first().value == 7


LEG = "height int, ts bigint, tx_pos int, tx_hash string, is_coinbase boolean, is_input boolean, address string, kind string, value bigint"


def test_fees_minting_and_transfers_of_a_block(spark):
    legs = [
        (1, 9, 0, "cb", True, False, "miner", "P2PKH", 60),
        (1, 9, 1, "t1", False, True, "a", "P2PKH", 100),
        (1, 9, 1, "t1", False, False, "b", "P2PKH", 70),
        (1, 9, 1, "t1", False, False, "a", "P2PKH", 20),  # change back to the sender
        (1, 9, 2, "t2", False, True, "c", "P2SH", 5),
        (1, 9, 2, "t2", False, False, "c", "P2SH", 5),  # nets to nothing, no fee
    ]
    df = spark.createDataFrame(legs, LEG)
    minting = transfers.block_minting(df).first()
    assert (minting.fees, minting.reward, minting.minted, minting.txs) == (10, 60, 50, 3)
    net = transfers.net_accounts(df)
    assert transfers.unmatched_sides(net).count() == 0
    edges = transfers.model_transfers(net).select("tx_hash", "from", "to", "amount")
    assert {tuple(r) for r in edges.collect()} == {
        ("t1", "a", "b", 70), ("t1", "a", "fee", 10), ("cb", "mint", "miner", 50), ("cb", "fee", "miner", 10),
    }


def test_miner_claims_less_than_the_fees(spark):
    legs = [
        (1, 9, 0, "cb", True, False, "miner", "P2PKH", 4),
        (1, 9, 1, "t1", False, True, "a", "P2PKH", 10),
    ]
    net = transfers.net_accounts(spark.createDataFrame(legs, LEG))
    edges = transfers.model_transfers(net).select("tx_hash", "from", "to", "amount")
    # ``mint`` receives what the miner did not claim.
    assert {tuple(r) for r in edges.collect()} == {
        ("t1", "a", "fee", 10), ("cb", "fee", "mint", 6), ("cb", "fee", "miner", 4),
    }


def test_matching_continues_from_an_unspent_set(spark):
    entries = clock.with_increasing_time(pipeline.block_entries(raw_blocks(spark, SF).where("height < 30"))).cache()
    whole = {tuple(r) for r in matching.match_spends_strict(entries).collect()}
    early, late = entries.where("height < 12"), entries.where("height >= 12")
    unspent = matching.unspent_outputs(early)
    parts = matching.match_spends_strict(early).union(matching.match_spends_strict(late, unspent=unspent))
    assert {tuple(r) for r in parts.collect()} == whole
    assert matching.missing_outputs(late, unspent=unspent).count() == 0
    assert matching.missing_outputs(late).count() == 1


def test_blocks_are_exported_once(spark, tmp_path):
    sink = str(tmp_path / "records")
    chain = raw_blocks(spark, SF).where("height < 20").cache()
    pipeline.export_blocks(spark, chain.where("height < 10"), sink)
    pipeline.export_blocks(spark, chain, sink)
    pipeline.export_blocks(spark, chain, sink)
    got = blocks.from_records(spark.read.parquet(sink))
    # Height 0 counts as already there, as an empty sink resumes after 0.
    assert sorted(r.height for r in got.collect()) == list(range(1, 17))


def test_batch_pipeline_writes_what_is_switched_on(spark, tmp_path):
    chain = raw_blocks(spark, SF).where("height < 40")
    pipeline.run(spark, chain, str(tmp_path / "out"), transfers=True, stacks=True, edges=True, topics=2, partitions=3)
    net = spark.read.parquet(str(tmp_path / "out" / "net"))
    transfers_out = spark.read.parquet(str(tmp_path / "out" / "transfers"))
    assert transfers_out.count() == net.count() > 0
    assert {r.topic for r in transfers_out.select("topic").distinct().collect()} == {0, 1}
    edges = spark.read.parquet(str(tmp_path / "out" / "edges"))
    assert edges.count() == pipeline.block_transfers(chain).count() > 0
    stacks = spark.read.parquet(str(tmp_path / "out" / "stacks"))
    assert stacks.count() == stack_changes(net).count()
