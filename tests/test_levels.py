"""Tables in levels against a dict, over a hundred runs, with what they read; stacks in pages against whole stacks."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import lifo
from ledgerloom.operators.stack_pages import StackTables, depths, lowest_balances, run_segments
from ledgerloom.sources.levels import LevelTable

CHANGE = "k binary, n bigint, v bigint, live boolean"
NET = "ts bigint, height int, tx_pos int, value bigint, address string"
SETTINGS = {"rows_per_bucket": 64, "fan": 4}


def written(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def as_dict(df):
    return {(bytes(r.k), r.n): r.v for r in df.collect()}


def files_below(spark, folders):
    read = spark.read.option("recursiveFileLookup", "true").parquet(*folders)
    return sum(1 for _ in read.inputFiles())


@pytest.fixture
def one_task(spark):
    """Tables this small need no more."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", usual)


def test_a_hundred_small_runs(spark, tmp_path, one_task):
    rng, held, root = random.Random(1), {}, str(tmp_path)
    listed, written_rows = None, 0
    for run in range(100):
        changes = {}
        for _ in range(14):
            key = (b"%d" % rng.randrange(600), rng.randrange(3))
            changes[key] = None if key in held and rng.random() < 0.5 else run * 1000 + rng.randrange(1000)
        rows = [(*key, v, v is not None) for key, v in changes.items()]
        table = LevelTable.of(root, ["k", "n"], listed, **SETTINGS)
        before = {s.path for s in table.segments}
        table = table.with_run(written(spark, f"{root}/changes", rows, CHANGE), run)
        written_rows += sum(s.rows for s in table.segments if s.path not in before)
        listed = table.listing()
        for key, v in changes.items():
            held.pop(key, None)
            if v is not None:
                held[key] = v
        if run % 20 == 7:
            asked = [*rng.sample(sorted(held), 3), (b"none", 1), (b"0", 9)]
            got = table.lookup(spark.createDataFrame(asked, "k binary, n bigint"))
            assert as_dict(got) == {key: held[key] for key in asked if key in held}
    assert as_dict(table.rows(spark)) == held
    # Few segments, and every row written again a few times only.
    assert len(table.segments) <= 3 * SETTINGS["fan"]
    assert written_rows <= 100 * 14 * 5
    # A look-up opens the buckets its keys are in, and those for which a filter errs.
    asked = spark.createDataFrame(rng.sample(sorted(held), 2) + [(b"new%d" % k, 0) for k in range(4)], "k binary, n bigint")
    hit = table.buckets_hit(asked)
    everything = files_below(spark, [f"{s.path}/rows" for s in table.segments])
    opened = len({f for f in table.lookup(asked).inputFiles() if "/rows/" in f})
    assert 0 < opened <= len(hit) < everything / 2


def test_a_broken_run_is_not_in_the_table(spark, tmp_path):
    root = str(tmp_path)
    one = LevelTable.of(root, ["k", "n"], None, **SETTINGS)
    one = one.with_run(written(spark, f"{root}/a", [(b"a", 1, 5, True)], CHANGE), 0)
    one.with_run(written(spark, f"{root}/b", [(b"a", 1, None, False), (b"b", 1, 6, True)], CHANGE), 1)
    again = LevelTable.of(root, ["k", "n"], one.listing(), **SETTINGS)
    assert as_dict(again.rows(spark)) == {(b"a", 1): 5}
    again = again.with_run(written(spark, f"{root}/b", [(b"c", 1, 7, True)], CHANGE), 1)
    assert as_dict(again.rows(spark)) == {(b"a", 1): 5, (b"c", 1): 7}
    assert again.with_run(spark.createDataFrame([], CHANGE), 2) == again
    nothing = again.lookup(spark.createDataFrame([(b"zz", 4)], "k binary, n bigint"))
    assert nothing.collect() == []
    assert LevelTable.of(root, ["k"], None).lookup(nothing) is None


def test_levels_follow_sizes(spark, tmp_path):
    root = str(tmp_path)
    rows = [(b"%d" % k, 0, k, True) for k in range(1500)]
    table = LevelTable.of(root, ["k", "n"], None, **SETTINGS).with_run(written(spark, f"{root}/a", rows, CHANGE), 0)
    assert [s.level for s in table.segments] == [3]
    # A large run behind a small one takes that in; what it takes away is gone for good.
    small = table.with_run(written(spark, f"{root}/b", [(b"5", 0, None, False)], CHANGE), 1)
    assert [s.level for s in small.segments] == [3, 0]
    more = [(b"x%d" % k, 0, k, True) for k in range(5000)]
    large = small.with_run(written(spark, f"{root}/c", more, CHANGE), 2)
    assert len(large.segments) == 1
    assert large.rows(spark).count() == 1500 - 1 + 5000


def histories(rng, addresses, heights):
    """Net changes that go up, down, below zero, and back."""
    out = []
    for address in addresses:
        for height in heights:
            for tx_pos in range(rng.randrange(0, 3)):
                value = rng.choice([rng.randrange(1, 9), rng.randrange(1, 30), -rng.randrange(1, 12), -rng.randrange(1, 60)])
                out.append((1000 + height, height, tx_pos, value, address))
    return out


@pytest.mark.parametrize("rows_per_chunk", [4_000_000, 30])
def test_stacks_in_pages(spark, tmp_path, rows_per_chunk):
    rng, root = random.Random(rows_per_chunk), str(tmp_path)
    addresses = [f"a{k}" for k in range(13)] + [""]
    every, tables, changes = [], StackTables.of(root, None, None, **SETTINGS), None
    for run in range(4):
        # Some addresses have no change in a run.
        net_rows = histories(rng, rng.sample(addresses, 9), range(run * 20, run * 20 + 20))
        every += net_rows
        net = written(spark, f"{root}/net{run}", net_rows, NET)
        found, pages, fences = run_segments(net, tables, page=3, rows_per_chunk=rows_per_chunk)
        new = lifo.changes_of(found).collect()
        changes = new if changes is None else changes + new
        for name, df in (("pages", pages), ("fences", fences)):
            df.write.parquet(f"{root}/{name}{run}")
        read = [spark.read.parquet(f"{root}/{name}{run}") for name in ("pages", "fences")]
        tables = tables.with_run(*read, run)
    whole = lifo.segments(spark.createDataFrame(every, NET))
    assert sorted(map(repr, map(tuple, changes))) == sorted(repr(tuple(r)) for r in lifo.changes_of(whole).collect())
    left = whole.where("closed_ts is null").select("address", "nonce", "ots", "value")
    assert sorted(map(repr, tables.open_segments(spark).collect())) == sorted(map(repr, left.collect()))


def test_a_shallow_run_leaves_deep_pages_alone(spark, tmp_path):
    root = str(tmp_path)
    net = written(spark, f"{root}/net0", [(k, k, 0, 10, "deep") for k in range(100)], NET)
    tables = StackTables.of(root, None, None, **SETTINGS)
    _, pages, fences = run_segments(net, tables, page=8)
    tables = tables.with_run(pages, fences, 0)
    assert pages.count() == 13 and fences.count() == 14
    shallow = written(spark, f"{root}/net1", [(200, 200, 0, -65, "deep"), (201, 201, 0, 40, "deep")], NET)
    lows = lowest_balances(shallow)
    depth, touched = depths(tables.fences.lookup(lows.select("address")), lows, page=8)
    # A balance of 935 is left: the pages that end at 960 and 1000 lie above it.
    assert [tuple(r) for r in depth.collect()] == [("deep", 880, 11, 100)]
    assert sorted(r.page for r in touched.collect()) == [11, 12]
    found, pages, fences = run_segments(shallow, tables, page=8)
    assert found.where("height = -1").count() == 100 - 88
    assert sorted((r.page, r.live) for r in pages.collect()) == [(11, True), (12, False)]
    assert fences.where("page = 11").select(F.max("top")).first()[0] == 975
