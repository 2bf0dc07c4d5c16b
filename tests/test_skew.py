"""Hot keys: the chunked plans give what a plain pass over the whole key gives."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import lifo, matching, ordered, transfers
from ledgerloom.operators.ordered import hot_key_bounds, last_value, previous, row_number, running, running_sum


def skewed(n, seed):
    """Rows of which about a third belong to key ``hot``."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.35 else f"k{rng.randrange(40)}", i, rng.randrange(-50, 50)) for i in range(n)]


@pytest.mark.parametrize("rows_per_chunk", [100, 700, 10**6])
def test_running_columns_equal_a_plain_loop(spark, rows_per_chunk):
    rows = skewed(4000, 1)
    df = spark.createDataFrame(rows, "k string, at int, v int")
    marked = F.when(F.col("v") > 20, F.col("v"))
    got = running(
        df.repartition(5),
        ["k"],
        ["at"],
        {"total": running_sum("v"), "n": row_number(), "last": last_value(marked), "prev": previous("v")},
        rows_per_chunk,
    )
    assert set(got.columns) == {"k", "at", "v", "total", "n", "last", "prev"}
    state, want = {}, set()
    for k, at, v in rows:
        total, n, last, prev = state.get(k, (0, 0, None, None))
        total, n, last = total + v, n + 1, v if v > 20 else last
        want.add((k, at, v, total, n, last, prev))
        state[k] = (total, n, last, v)
    assert {tuple(r) for r in got.select("k", "at", "v", "total", "n", "last", "prev").collect()} == want


def test_copies_at_one_position_are_cut_too(spark):
    """A third of the rows are copies of one row: same key, same position."""
    rows = [("hot", 5, 1)] * 2000 + [("hot", i, i) for i in range(10, 500)] + [(f"k{i % 9}", i, 2) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, at int, v int").repartition(6)
    scans = {"n": row_number(), "total": running_sum("v"), "prev": previous("v")}
    got = running(df, ["k"], ["at"], scans, 300)
    want = running(df, ["k"], ["at"], scans)
    assert sorted(map(tuple, got.fillna(-1).collect())) == sorted(map(tuple, want.fillna(-1).collect()))


def test_hot_key_is_cut_into_bounded_chunks(spark):
    df = spark.createDataFrame(skewed(20_000, 2), "k string, at int, v int")
    bounds = hot_key_bounds(df, ["k"], ["at"], 1000)
    assert bounds.count() == 1
    chunks = ordered.with_chunks(df, ["k"], ["at"], bounds).groupBy("k", ordered.CHUNK).count()
    hot = chunks.where("k = 'hot'").collect()
    assert len(hot) >= 7 and max(r["count"] for r in hot) < 2000
    assert chunks.where("k <> 'hot' and _chunk <> 0").count() == 0


def test_no_hot_key_keeps_the_plain_window(spark):
    df = spark.createDataFrame(skewed(500, 3), "k string, at int, v int")
    assert hot_key_bounds(df, ["k"], ["at"]) is None
    plan = running(df, ["k"], ["at"], {"n": row_number()})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def fold(changes):
    """Stack rows by the textbook loop."""
    stacks, nonces, out = {}, {}, []
    for ts, height, tx_pos, value, address in sorted(changes, key=lambda c: (c[4], c[1], c[2])):
        stack = stacks.setdefault(address, [])

        def push(ots, amount, ts=ts, height=height, tx_pos=tx_pos, address=address, stack=stack):
            nonces[address] = nonces.get(address, 0) + 1
            stack.append((nonces[address], ots, amount))
            out.append((1, ts, height, tx_pos, nonces[address], ots, address, amount))

        if value >= 0:
            push(ts, value)
            continue
        rest, last = -value, None
        while rest > 0 and stack:
            last = stack.pop()
            rest -= last[2]
            out.append((-1, ts, height, tx_pos, *last[:2], address, last[2]))
        if rest > 0:
            push(0, -rest)
        elif rest < 0:
            push(last[1], -rest)
    return out


CHANGE = "ts bigint, height int, tx_pos int, value bigint, address string"
STACK = ["sign", "ts", "height", "tx_pos", "nonce", "ots", "address", "value"]


def history(n, seed, step):
    """Changes with a hot address; ``step`` gives the value at a position."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        address = "hot" if rng.random() < 0.4 else f"a{rng.randrange(30)}"
        value = step(rng, i)
        if value:
            out.append((100 + i, 1 + i // 3, i % 3, value, address))
    return out


HISTORIES = {
    "mixed": lambda rng, i: rng.randrange(-9, 10),
    "mostly receives": lambda rng, i: rng.randrange(-4, 12),
    "mostly spends": lambda rng, i: rng.randrange(-12, 4),
    "decline": lambda rng, i: 5000 if i < 10 else -rng.randrange(1, 5),
    "rise and fall": lambda rng, i: rng.randrange(1, 9) if i % 1000 < 500 else -rng.randrange(1, 9),
    "unit steps": lambda rng, i: rng.choice([-1, 1]),
}


@pytest.mark.parametrize("kind", HISTORIES)
@pytest.mark.parametrize("rows_per_chunk", [60, 10**6])
def test_stack_changes_equal_the_loop(spark, kind, rows_per_chunk):
    changes = history(2000, 7, HISTORIES[kind])
    df = spark.createDataFrame(changes, CHANGE).repartition(7)
    got = lifo.stack_changes(df, rows_per_chunk).select(*STACK)
    assert sorted(map(tuple, got.collect())) == sorted(fold(changes))


@pytest.mark.parametrize("kind, rows_per_chunk", [("mostly spends", 150), ("mixed", 10**6)])
def test_stack_continues_from_an_earlier_state(spark, kind, rows_per_chunk):
    changes = history(1200, 9, HISTORIES[kind])
    df = spark.createDataFrame(changes, CHANGE).cache()
    got, state = [], None
    for low, high in ((0, 150), (150, 260), (260, 1000)):
        part = df.where((F.col("height") >= low) & (F.col("height") < high))
        found = lifo.segments(part, rows_per_chunk, state).cache()
        got += map(tuple, lifo.changes_of(found).select(*STACK).collect())
        state = lifo.stack_state(found, state).cache()
    assert sorted(got) == sorted(fold(changes))


def test_stack_with_liabilities_worked_example(spark):
    values = [-5, -3, 4, -6]
    df = spark.createDataFrame([(i + 1, i + 1, 0, v, "x") for i, v in enumerate(values)], CHANGE)
    got = {(r.sign, r.ts, r.nonce, r.ots, r.value) for r in lifo.stack_changes(df).collect()}
    assert got == {
        (1, 1, 1, 0, -5), (-1, 2, 1, 0, -5), (1, 2, 2, 0, -8), (1, 3, 3, 3, 4),
        (-1, 4, 3, 3, 4), (-1, 4, 2, 0, -8), (1, 4, 4, 0, -10),
    }


def test_hot_outpoint_matches_like_the_plain_window(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        outpoint = "h" if rng.random() < 0.4 else f"t{i // 2}"
        is_input = rng.random() < 0.5
        rows.append((i, i, 0, outpoint, 0, 0, is_input, False, None if is_input else f"a{i}", None if is_input else i))
    schema = (
        "ts bigint, height int, tx_pos int, tx_hash string, out_index bigint, entry_idx int, "
        "is_input boolean, is_marker boolean, address string, value bigint"
    )
    df = spark.createDataFrame(rows, schema)
    for operator in (matching.match_spends, matching.missing_outputs):
        assert sorted(map(tuple, operator(df, 100).collect())) == sorted(map(tuple, operator(df).collect()))


def test_hot_key_joins_like_the_others(spark):
    rng = random.Random(8)
    left = spark.createDataFrame([("h" if rng.random() < 0.4 else f"k{i % 50}", i) for i in range(3000)], "k string, i int")
    right = spark.createDataFrame([(k, k + "!") for k in ["h", *[f"k{i}" for i in range(0, 50, 2)]]], "k string, v string")
    got = ordered.join_unique(left, right, ["k"], 300)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, ["k"]).collect()))


def greedy(accounts):
    """Largest payer pays largest receiver until all is matched."""
    payers = sorted(((-v, a, k) for a, k, v in accounts if v < 0), key=lambda e: (-e[0], e[1], e[2]))
    receivers = sorted(((v, a, k) for a, k, v in accounts if v > 0), key=lambda e: (-e[0], e[1], e[2]))
    out, p, r = [], 0, 0
    payer_left, receiver_left = payers[0][0], receivers[0][0]
    while True:
        amount = min(payer_left, receiver_left)
        out.append((payers[p][1], receivers[r][1], amount))
        payer_left, receiver_left = payer_left - amount, receiver_left - amount
        if not payer_left:
            p += 1
            if p == len(payers):
                return out
            payer_left = payers[p][0]
        if not receiver_left:
            r += 1
            if r == len(receivers):
                return out
            receiver_left = receivers[r][0]


@pytest.mark.parametrize("rows_per_chunk", [50, 10**6])
def test_transfers_equal_greedy_matching(spark, rows_per_chunk):
    rng = random.Random(11)
    txs = {}
    for t in range(60):
        size = 300 if t == 0 else rng.randrange(1, 6)
        amounts = [rng.randrange(1, 8 if t % 2 else 1000) for _ in range(size)]
        total = sum(amounts)
        accounts = [(f"p{i}", "K", -v) for i, v in enumerate(amounts)]
        i = 0
        while total:
            v = min(total, rng.randrange(1, 8 if t % 2 else 1000))
            accounts.append((f"r{i}", "K", v))
            total, i = total - v, i + 1
        txs[f"t{t}"] = accounts
    rows = [(1, 1, i, t, a, k, v) for i, (t, accounts) in enumerate(txs.items()) for a, k, v in accounts]
    df = spark.createDataFrame(rows, "height int, ts bigint, tx_pos int, tx_hash string, address string, kind string, value bigint")
    got = transfers.model_transfers(df, rows_per_chunk).select("tx_hash", "from", "to", "amount")
    want = [(t, *edge) for t, accounts in txs.items() for edge in greedy(accounts)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_parents_of_a_hot_outpoint(spark):
    rng = random.Random(8)
    schema = (
        "ts bigint, height int, tx_pos int, tx_hash binary, out_index bigint, entry_idx int, "
        "is_input boolean, is_marker boolean, value bigint, address string"
    )
    rows = []
    for h in range(1500):
        key = b"hot" if rng.random() < 0.6 else b"%d" % rng.randrange(200)
        spends = rng.random() < 0.7
        rows.append((h, h, 0, key, 0, 0, spends, False, None if spends else h + 1, None if spends else f"a{h}"))
    last = {r[3]: r for r in rows if not r[6]}
    want = sorted((r[1], last[r[3]][1], last[r[3]][9], -last[r[3]][8]) for r in rows if r[6] and r[3] in last)
    found = matching.join_parents(spark.createDataFrame(rows, schema), rows_per_chunk=100)
    assert sorted(map(tuple, found.select("height", "created", "address", "value").collect())) == want


def test_changes_of_the_unspent_outputs_come_from_matching(spark):
    """Also with outpoints cut into chunks, made again, spent in later blocks, and known from before."""
    rng, rows, unspent, schema = random.Random(4), [], [], (
        "ts bigint, height int, tx_pos int, tx_hash binary, out_index bigint, entry_idx int, is_input boolean, "
        "is_marker boolean, value bigint, own_hash binary, address string, kind string"
    )
    for k in range(30):
        live = rng.random() < 0.5
        if live:
            unspent.append((bytes([k]), 0, 1, "old", "P2SH", 7))
        for height in range(2, 400 if k == 3 else rng.choice([3, 4, 6])):
            if live:
                rows.append((height, height, 1, bytes([k]), 0, k, True, False, None, b"i", None, None))
            live = rng.random() < 0.7
            if live:
                rows.append((height, height, 2, bytes([k]), 0, k, False, False, height * 100 + k, b"o", f"a{k}", "P2PKH"))
    entries = spark.createDataFrame(rows, schema).repartition(5)
    known = spark.createDataFrame(unspent, "tx_hash binary, out_index bigint, height int, address string, kind string, value bigint")
    want = sorted(map(tuple, matching.unspent_changes(entries, known).where("live").collect()))
    gone = {bytes(r.tx_hash) for r in matching.unspent_changes(entries, known).where("not live").collect()}
    for chunk in (40, 100_000):
        legs = matching.tx_legs(entries, chunk, unspent=known, with_ends=True)
        found = matching.unspent_changes(entries, known, legs)
        columns = ["tx_hash", "out_index", "height", "address", "kind", "value", "live"]
        assert sorted(map(tuple, found.where("live").select(*columns).collect())) == sorted(
            map(tuple, matching.unspent_changes(entries, known).where("live").select(*columns).collect())
        )
        assert {bytes(r.tx_hash) for r in found.where("not live").collect()} == gone and len(want) > 3
        assert "Exchange" not in spark.createDataFrame(legs.collect(), legs.schema).transform(
            lambda t: matching.unspent_changes(entries, known, t)
        )._jdf.queryExecution().executedPlan().toString()
