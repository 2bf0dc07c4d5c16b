"""Layout, counters and windows of net changes."""

import random

from pyspark.sql import functions as F

from ledgerloom.operators import sketches
from ledgerloom.operators.counters import observed
from ledgerloom.operators.netting import in_address_order, net_changes, net_changes_windowed
from ledgerloom.streaming import jobs

CHANGE = "ts bigint, height int, tx_pos int, value bigint, address string"


def changes(spark):
    rng = random.Random(4)
    rows = [(1000 + h, h, rng.randrange(3), rng.randrange(-3, 4), f"a{rng.randrange(5)}") for h in range(40) for _ in range(6)]
    return spark.createDataFrame(rows, CHANGE), rows


def test_net_changes_and_windows(spark):
    df, rows = changes(spark)
    want = {}
    for ts, height, tx_pos, value, address in rows:
        want[ts, height, tx_pos, address] = want.get((ts, height, tx_pos, address), 0) + value
    want = sorted((ts, h, p, v, a) for (ts, h, p, a), v in want.items() if v)
    assert sorted(map(tuple, net_changes(df).collect())) == want
    assert sorted(map(tuple, net_changes_windowed(df).collect())) == want


def test_layout_by_address(spark, tmp_path):
    df, _ = changes(spark)
    net = net_changes(df)
    in_address_order(net).write.parquet(str(tmp_path / "net"))
    back = spark.read.parquet(str(tmp_path / "net"))
    assert back.count() == net.count()
    parts = back.select("address", "height", "tx_pos", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"))
    by_file = {}
    for r in sorted(parts.collect(), key=lambda r: r.n):
        by_file.setdefault(r.f, []).append((r.address, r.height, r.tx_pos))
    assert all(rows == sorted(rows) for rows in by_file.values())


def test_observed_counts(spark):
    df, rows = changes(spark)
    counted, observation = observed(df, "progress")
    counted.write.format("noop").mode("overwrite").save()
    assert observation.get == {"records": len(rows), "height": 39}


def test_published_stream_has_keys_and_shards(spark, tmp_path):
    df, _ = changes(spark)
    net_changes(df).write.parquet(str(tmp_path / "net"))
    stream = spark.readStream.schema(CHANGE).parquet(str(tmp_path / "net"))
    query = jobs.publish_transfers(stream, "json", str(tmp_path / "cp"), 2, 3, path=str(tmp_path / "out"))
    query.awaitTermination()
    got = spark.read.json(str(tmp_path / "out")).select("key", "topic", "partition").collect()
    assert len({r.key for r in got}) == len(got) == net_changes(df).count()
    assert {r.topic for r in got} <= {0, 1} and {r.partition for r in got} <= {0, 1, 2}


def test_sketches_merge_like_sets(spark):
    rows = [(86400 * (k % 20) + k, None if k % 50 == 0 else "" if k % 7 == 0 else f"a{k % 400}", k % 3) for k in range(6000)]
    changes = spark.createDataFrame(rows, "ts bigint, address string, run int")
    kept = sketches.address_sketches(changes, "run")
    for period, days in (("day", 1), ("year", 365)):
        sets = {}
        for ts, address, _ in rows:
            if address is not None:
                sets.setdefault(ts // 86400 // days, set()).add(address)
        got = {r.day: r.addresses for r in sketches.sketched_addresses(kept, period).collect()}
        assert sorted(d.toordinal() - 719163 for d in got) == sorted(d * days for d in sets)
        assert all(abs(got[d] - len(sets[(d.toordinal() - 719163) // days])) <= 0.1 * len(sets[(d.toordinal() - 719163) // days]) for d in got)
    only = spark.createDataFrame([(5, ""), (6, None)], "ts bigint, address string")
    assert [r.addresses for r in sketches.sketched_addresses(sketches.address_sketches(only)).collect()] == [1]
    assert sketches.sketched_addresses(sketches.address_sketches(only.limit(0))).count() == 0
