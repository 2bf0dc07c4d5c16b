"""Coin age: a last-in-first-out stack of balance segments per address.

A receive pushes a segment dated with its block time.  A spend takes segments
from the top; what is left of the last one goes back with its date, and a spend
beyond the whole stack leaves one negative segment, a liability, dated 0.

In terms of the running balance of the address the stack needs no history other
than the balance itself.  A segment pushed by an event at balance ``b`` stays
until the first later event with a balance below ``b``.  A spend to ``b`` looks
back to the latest event with a balance of at most ``b``: if the balances are
equal nothing is left over, otherwise the remainder reaches down to that balance
and dates from the receive that followed.  So a history can be cut anywhere as
long as the balance at the cut is known, which is how hot addresses are split.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import to_coin
from ..session import checkpointed
from .ordered import (
    CHUNK,
    ROWS_PER_CHUNK,
    cold_rows,
    hot_key_bounds,
    hot_rows,
    last_value,
    row_number,
    running,
    running_sum,
    running_within,
    with_chunks,
)

_ORDER = ["height", "tx_pos"]
_FLUSH_ROWS = 50_000

# One row per segment, with the events that opened and closed it.
_SEGMENT = (
    "address string, nonce int, ots bigint, value bigint, "
    "height int, tx_pos int, ts bigint, closed_height int, closed_tx_pos int, closed_ts bigint"
)
# As above for one chunk.  ``level`` is the balance at opening.  An ``unmet`` spend
# went below everything its chunk knows; a ``floor`` row is a balance an earlier
# chunk offers to later ones (``ots`` being the time of the event after it).
_PIECE = (
    "address string, _chunk int, level bigint, ots bigint, value bigint, unmet boolean, floor boolean, "
    "height int, tx_pos int, ts bigint, closed_height int, closed_tx_pos int, closed_ts bigint"
)


def segments(net: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK, state: DataFrame | None = None) -> DataFrame:
    """Every stack segment ever opened, with its opening and (if any) closing event.

    ``net`` holds at most one change per address, height and position.  ``state``,
    as :func:`stack_state` gives it, holds the stacks left by earlier blocks; their
    segments are in the result with height -1.
    """
    changes = net.select("address", "height", "tx_pos", "ts", "value")
    if state is not None:
        return _continued(changes, state, rows_per_chunk)
    bounds = hot_key_bounds(changes, ["address"], _ORDER, rows_per_chunk)
    if bounds is None:
        return _fold_addresses(changes)
    cold = _fold_addresses(cold_rows(changes, ["address"], bounds))
    hot = _fold_chunks(hot_rows(changes, ["address"], bounds), bounds, rows_per_chunk)
    return cold.unionByName(hot)


def stack_state(found: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """What the blocks after those of the segments ``found`` need to know.

    The open segments, and for each address a row without value whose nonce is the
    last one used.  ``earlier`` is the state ``found`` started from, if any.
    """
    null = F.lit(None).cast("bigint")
    open_now = found.where("closed_ts is null").select("address", "nonce", "ots", "value")
    used = found.select("address", "nonce")
    if earlier is not None:
        used = used.unionByName(earlier.select("address", "nonce"))
    last = used.groupBy("address").agg(F.max("nonce").alias("nonce"))
    return open_now.unionByName(last.select("address", "nonce", null.alias("ots"), null.alias("value")))


def _continued(changes: DataFrame, state: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Segments after an earlier state: its open segments are replayed as first changes.

    Replaying a segment gives it its place on the stack as nonce; the nonces of the
    earlier run are put back afterwards, and later ones moved behind them.
    """
    held = state.where("value is not null")
    placed = running(held, ["address"], ["nonce"], {"place": row_number()}, rows_per_chunk)
    replayed = placed.select(
        "address",
        F.lit(-1).alias("height"),
        F.col("place").cast("int").alias("tx_pos"),
        F.col("ots").alias("ts"),
        "value",
    )
    found = segments(changes.unionByName(replayed), rows_per_chunk)
    given = placed.select(
        "address",
        F.lit(-1).alias("height"),
        F.col("place").cast("int").alias("tx_pos"),
        F.col("nonce").alias("_given"),
    )
    # Shuffled by itself, so that Spark can split a hot address of the other side.
    moved = (
        state.groupBy("address")
        .agg((F.max("nonce") - F.count("value")).cast("int").alias("_moved"))
        .repartition("address")
    )
    nonce = F.coalesce("_given", F.col("nonce") + F.coalesce("_moved", F.lit(0)))
    return (
        found.join(given, ["address", "height", "tx_pos"], "left")
        .join(moved, "address", "left")
        .withColumn("nonce", nonce)
        .select(*found.columns)
    )


def stack_changes(
    net: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK, state: DataFrame | None = None
) -> DataFrame:
    """Signed stack rows: +1 when a segment is pushed, -1 when it is taken off."""
    return changes_of(segments(net, rows_per_chunk, state))


def changes_of(found: DataFrame) -> DataFrame:
    """Signed stack rows of segments."""
    pushed = F.struct(F.lit(1).alias("sign"), F.col("ts").alias("at_ts"), "height", "tx_pos")
    taken = F.struct(
        F.lit(-1).alias("sign"),
        F.col("closed_ts").alias("at_ts"),
        F.col("closed_height").alias("height"),
        F.col("closed_tx_pos").alias("tx_pos"),
    )
    events = F.array_compact(
        F.array(F.when(F.col("height") >= 0, pushed), F.when(F.col("closed_ts").isNotNull(), taken))
    )
    return (
        found.select("address", "nonce", "ots", "value", F.inline(events))
        .select("sign", F.col("at_ts").alias("ts"), "height", "tx_pos", "nonce", "ots", "address", "value")
    )


def public_stack_changes(changes: DataFrame) -> DataFrame:
    """Published form of stack rows: value in coins."""
    tx_pos, value = F.col("tx_pos").alias("txPos"), to_coin("value").alias("value")
    return changes.select("sign", "ts", "height", tx_pos, "nonce", "ots", "address", value)


def spent_by_origin(changes: DataFrame) -> DataFrame:
    """Change of an address's coins per origin time at each of its events."""
    return (
        changes.groupBy("address", "ts", "ots")
        .agg(F.sum(F.col("sign") * F.col("value")).alias("value"))
        .where(F.col("value") != 0)
    )


def open_segments(changes: DataFrame) -> DataFrame:
    """Segments still on the stack: those whose signs add up to one."""
    return (
        changes.groupBy("address", "nonce")
        .agg(F.sum("sign").alias("signs"), F.max("ots").alias("ots"), F.max("value").alias("value"))
        .where(F.col("signs") == 1)
        .drop("signs")
    )


def _fold_addresses(changes: DataFrame) -> DataFrame:
    """One shuffle by address, a sort that can spill, and a pass holding one stack at a time."""
    # A fixed number of partitions: the pass is Python work, not to be merged by byte size.
    partitions = int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = changes.repartition(partitions, "address").sortWithinPartitions("address", *_ORDER)
    return ordered.mapInArrow(_fold_whole, _SEGMENT)


def _rows(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(name).to_pylist() for name in columns], strict=True)


class _Output:
    """Collects rows and hands them out as Arrow batches."""

    def __init__(self, types: list[tuple[str, pa.DataType]]):
        self._schema = pa.schema(types)
        self._rows: list[tuple] = []

    def add(self, row: tuple) -> None:
        self._rows.append(row)

    def full(self) -> bool:
        return len(self._rows) >= _FLUSH_ROWS

    def take(self) -> pa.RecordBatch:
        columns = zip(*self._rows, strict=True) if self._rows else [[] for _ in self._schema]
        arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, self._schema, strict=True)]
        self._rows = []
        return pa.RecordBatch.from_arrays(arrays, schema=self._schema)


_EVENT = [("height", pa.int32()), ("tx_pos", pa.int32()), ("ts", pa.int64())]
_CLOSING = [("closed_height", pa.int32()), ("closed_tx_pos", pa.int32()), ("closed_ts", pa.int64())]
_OPEN = (None, None, None)


def _fold_whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of whole histories; rows arrive sorted by address and event."""
    out = _Output(
        [
            ("address", pa.string()),
            ("nonce", pa.int32()),
            ("ots", pa.int64()),
            ("value", pa.int64()),
            *_EVENT,
            *_CLOSING,
        ]
    )
    owner, started = None, False
    balance, nonce, stack = 0, 0, []
    for address, height, tx_pos, ts, value in _rows(batches, ["address", "height", "tx_pos", "ts", "value"]):
        if not started or address != owner:
            for _, row in stack:
                out.add((*row, *_OPEN))
            owner, started = address, True
            balance, nonce, stack = 0, 0, []
        event = (height, tx_pos, ts)
        before, balance = balance, balance + value
        left = None  # (ots, value) of the segment this event leaves behind
        if value >= 0:
            left = (ts, value)
        else:
            taken = None
            while stack and stack[-1][0] > balance:
                taken = stack.pop()[1]
                out.add((*taken, *event))
            below = stack[-1][0] if stack else 0
            if below < balance:
                left = (taken[2], balance - below)
            elif below > balance:
                left = (0, balance)
        if left is not None:
            nonce += 1
            stack.append((balance, (address, nonce, *left, *event)))
        if out.full():
            yield out.take()
    for _, row in stack:
        out.add((*row, *_OPEN))
    yield out.take()


def _fold_chunks(hot: DataFrame, bounds: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Segments of hot addresses: chunks are folded apart, then joined by balance."""
    key = ["address"]
    balanced = running_within(hot, key, _ORDER, {"balance": running_sum("value")}, bounds)
    chunked = with_chunks(balanced, key, _ORDER, bounds)
    # Read several times below.
    pieces = checkpointed(
        chunked.repartition("address", CHUNK)
        .sortWithinPartitions("address", CHUNK, *_ORDER)
        .mapInArrow(_fold_chunk, _PIECE)
    )
    floors = pieces.where("floor").select("address", CHUNK, "level", "ots")
    pushes = pieces.where("not floor")
    unmet = pushes.where("unmet").select("address", CHUNK, "level", "height", "tx_pos", "ts")

    # Lowest floor and lowest unmet spend of each chunk: at most a few thousand rows.
    lows = (
        pieces.groupBy("address", CHUNK)
        .agg(
            F.min(F.when(F.col("floor"), F.col("level"))).alias("floor"),
            F.min(F.when(F.col("unmet"), F.col("level"))).alias("low"),
        )
        .groupBy("address")
        .agg(F.sort_array(F.collect_list(F.struct(F.col(CHUNK).alias("at"), "floor", "low"))).alias("lows"))
    )
    settled = _left_behind(unmet, floors, lows, rows_per_chunk)
    known = pushes.where("not unmet").drop("floor", "unmet")
    closable = pushes.where("unmet").drop("floor", "unmet", "ots", "value").join(
        settled, ["address", "height", "tx_pos"]
    )
    opened = known.unionByName(closable)
    still = opened.where("closed_ts is null")
    closed = _close_later(still, unmet, lows, rows_per_chunk)
    done = opened.where("closed_ts is not null").drop(CHUNK, "level").unionByName(closed)
    numbered = running_within(done, key, _ORDER, {"nonce": row_number()}, bounds)
    return numbered.withColumn("nonce", F.col("nonce").cast("int")).select(
        "address", "nonce", "ots", "value", "height", "tx_pos", "ts", "closed_height", "closed_tx_pos", "closed_ts"
    )


def _left_behind(unmet: DataFrame, floors: DataFrame, lows: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Date and size of what unmet spends leave, from the latest floor not above them.

    Spends that end exactly on a floor leave nothing and are not returned.
    """
    candidates = F.filter("lows", lambda c: (c["at"] < F.col(CHUNK)) & (c["floor"] <= F.col("level")))
    aimed = unmet.join(F.broadcast(lows), "address").withColumn("at", F.try_element_at(candidates, F.lit(-1))["at"])
    asking = aimed.where("at is not null").select(
        "address", "at", "level", F.lit(1).alias("tag"), "height", "tx_pos", F.lit(None).cast("bigint").alias("ots")
    )
    offered = floors.select(
        "address",
        F.col(CHUNK).alias("at"),
        "level",
        F.lit(0).alias("tag"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("int").alias("tx_pos"),
        "ots",
    )
    floor = last_value(F.when(F.col("tag") == 0, F.struct("level", "ots")))
    met = running(
        asking.unionByName(offered), ["address", "at"], ["level", "tag", *_ORDER], {"below": floor}, rows_per_chunk
    ).where("tag = 1 and below.level < level")
    remainders = met.select(
        "address", *_ORDER, F.col("below.ots").alias("ots"), (F.col("level") - F.col("below.level")).alias("value")
    )
    liabilities = aimed.where("at is null").select(
        "address", *_ORDER, F.lit(0).cast("bigint").alias("ots"), F.col("level").alias("value")
    )
    return remainders.unionByName(liabilities)


def _close_later(still: DataFrame, unmet: DataFrame, lows: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Close segments left open by their chunk with the first later spend below them."""
    candidates = F.filter("lows", lambda c: (c["at"] > F.col(CHUNK)) & (c["low"] < F.col("level")))
    columns = ["address", "ots", "value", "height", "tx_pos", "ts"]
    aimed = still.join(F.broadcast(lows), "address").withColumn("at", F.try_element_at(candidates, F.lit(1))["at"])
    closing = {"closed_height": "int", "closed_tx_pos": "int", "closed_ts": "bigint"}
    none = [F.lit(None).cast(kind).alias(name) for name, kind in closing.items()]
    never = aimed.where("at is null").select(*columns, *none)
    asking = aimed.where("at is not null").select("at", "level", F.lit(0).alias("tag"), *columns)
    spends = unmet.select(
        F.col(CHUNK).alias("at"),
        "level",
        F.lit(1).alias("tag"),
        "address",
        F.lit(None).cast("bigint").alias("ots"),
        F.lit(None).cast("bigint").alias("value"),
        "height",
        "tx_pos",
        "ts",
    )
    spend = last_value(F.when(F.col("tag") == 1, F.struct("height", "tx_pos", "ts")))
    met = running(
        asking.unionByName(spends), ["address", "at"], ["level", "tag", *_ORDER], {"by": spend}, rows_per_chunk
    ).where("tag = 0")
    return met.select(
        *columns,
        F.col("by.height").alias("closed_height"),
        F.col("by.tx_pos").alias("closed_tx_pos"),
        F.col("by.ts").alias("closed_ts"),
    ).unionByName(never)


def _fold_chunk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of chunks whose balances are known; rows arrive sorted by address, chunk and event."""
    out = _Output(
        [
            ("address", pa.string()),
            (CHUNK, pa.int32()),
            ("level", pa.int64()),
            ("ots", pa.int64()),
            ("value", pa.int64()),
            ("unmet", pa.bool_()),
            ("floor", pa.bool_()),
            *_EVENT,
            *_CLOSING,
        ]
    )

    def finish(current, stack, floors):
        for _, row in stack:
            out.add((*row, *_OPEN))
        for level, next_ts in floors:
            out.add((*current, level, next_ts, None, False, True, *_OPEN, *_OPEN))

    current, base, stack, floors = None, None, [], []
    for address, chunk, height, tx_pos, ts, value, balance in _rows(
        batches, ["address", CHUNK, "height", "tx_pos", "ts", "value", "balance"]
    ):
        before = balance - value
        if current != (address, chunk):
            if current is not None:
                finish(current, stack, floors)
            current, base, stack, floors = (address, chunk), before, [], []
        # Balances before this event that nothing later in the chunk undercuts.
        while floors and floors[-1][0] >= before:
            floors.pop()
        floors.append((before, ts))
        event = (height, tx_pos, ts)
        if value >= 0:
            stack.append((balance, (*current, balance, ts, value, False, False, *event)))
        else:
            taken = None
            while stack and stack[-1][0] > balance:
                taken = stack.pop()[1]
                out.add((*taken, *event))
            below = stack[-1][0] if stack else base
            if below is None or below > balance:
                base = None  # from here on nothing in this chunk lies below the stack
                stack.append((balance, (*current, balance, None, None, True, False, *event)))
            elif below < balance:
                stack.append((balance, (*current, balance, taken[3], balance - below, False, False, *event)))
        if out.full():
            yield out.take()
    if current is not None:
        finish(current, stack, floors)
    yield out.take()
