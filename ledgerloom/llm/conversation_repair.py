"""Repair of conversations by weighted CYK parsing of spans of rows.

A repaired conversation's role initials read ``(s?(ua)+)?``.  The repair grammar is in
Chomsky normal form: a nonterminal ``(p, q)`` stands for a span that takes the reading
from state ``p`` to state ``q`` (nothing yet, after the system, a user, an assistant
turn), with the rules ``(p, q) -> (p, r) (r, q)``.  Of a single row ``(p, q)`` is one of
the edits Keep, Rerole or Delete, closed under Inserts before and after it.  A cell of
the chart is the smallest ``(cost, audit)`` of a span and nonterminal, the audit being
the edits' initials.  Of two audits of one span and cost neither begins the other (what
it had beyond it would be Inserts, which cost), so the smaller part always makes the
smaller whole and cells may be combined.

The chart of ``BLOCK`` consecutive rows is filled for all spans by length and all splits.
Since nonterminals say how a span begins and ends, longer spans need one split
each: blocks are joined two by two, ``FAN`` blocks in a task, spans of ``FAN`` blocks in
the next step, and so on until a conversation is one span.  So no task parses
a long conversation alone, and the number of steps is a logarithm of its length.
Equal rows of a turn are one row with a count.  Texts are kept out of all of this; they
are sorted by conversation once, at the end, and stream through the digest behind their
audit, without being held.

Defined results: null roles and texts are one space; a role without a first character
can't be kept; null turns come first and count as no turn in ``gaps``; rows of one
turn are ordered by role, then by the MD5 of their text; null ``conv_id`` is a
conversation; gaps beyond a long are the largest long.  An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import previous, row_number, running
from .store import stored

BLOCK = 8
FAN = 64
_REMEMBERED = 1 << 14
_SPACE = " \t\n\x0b\x0c\r"

# States of the reading, and what follows a role initial.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {
    (_START, "s"): _SYSTEM,
    (_START, "u"): _USER,
    (_SYSTEM, "u"): _USER,
    (_USER, "a"): _ASSISTANT,
    (_ASSISTANT, "u"): _USER,
}
_DONE = (_START, _ASSISTANT)
KEEP, REROLE, DELETE, INSERT = "KRDI"
_REROLE, _DELETE, _INSERT, _TRUNCATED = 2, 3, 2, 1

Cell = tuple[int, str]
Cells = list  # Cell or None for each pair of states

_STATES = range(4)
# No span takes the reading back to the start, or behind the system turn again.
_PAIRS = {(p, q) for p in _STATES for q in _STATES if p == q or q > max(p, _SYSTEM) or (p, q) == (_ASSISTANT, _USER)}
_PAIRS.add((_START, _SYSTEM))
_RULES = [(4 * p + q, 4 * p + r, 4 * r + q) for p, q in sorted(_PAIRS) for r in _STATES if {(p, r), (r, q)} <= _PAIRS]


def _least(cells: Cells, at: int, cell: Cell) -> None:
    if cells[at] is None or cell < cells[at]:
        cells[at] = cell


def combined(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of the two spans it is split into."""
    out: Cells = [None] * 16
    for whole, first, second in _RULES:
        a, b = left[first], right[second]
        if a is not None and b is not None:
            _least(out, whole, (a[0] + b[0], a[1] + b[1]))
    return out


def _insertions() -> Cells:
    """Cells of the empty span: the closure of single Inserts."""
    step: Cells = [None] * 16
    for p in _STATES:
        step[5 * p] = (0, "")
        for role in "ua":
            if (p, role) in _NEXT:
                _least(step, 4 * p + _NEXT[p, role], (_INSERT, INSERT))
    while (more := combined(step, step)) != step:
        step = more
    return step


_EMPTY = _insertions()


@lru_cache(maxsize=_REMEMBERED)
def row_cells(initial: str, delete: bool, truncated: bool, copies: int) -> Cells:
    """Cells of a row; of several copies all but the first are deleted, and the first too if it must be."""
    deleted = copies if delete else copies - 1
    gone: Cells = [None] * 16
    for p in _STATES:
        gone[5 * p] = (_DELETE * deleted, DELETE * deleted)
    gone = combined(_EMPTY, combined(gone, _EMPTY))
    if delete:
        return gone
    own: Cells = [None] * 16
    extra = _TRUNCATED if truncated else 0
    for p in _STATES:
        _least(own, 5 * p, (_DELETE, DELETE))
        if (p, initial) in _NEXT:
            _least(own, 4 * p + _NEXT[p, initial], (extra, KEEP))
        for role in "ua":
            if (p, role) in _NEXT:
                _least(own, 4 * p + _NEXT[p, role], (_REROLE + extra, REROLE))
    own = combined(_EMPTY, combined(own, _EMPTY))
    return own if copies == 1 else combined(own, gone)


def parsed(rows: list[Cells]) -> Cells:
    """Cells of all rows together: every span by length, from every split of it."""
    spans = {(i, i + 1): cells for i, cells in enumerate(rows)}
    for length in range(2, len(rows) + 1):
        for i in range(len(rows) - length + 1):
            best: Cells = [None] * 16
            for k in range(i + 1, i + length):
                for at, cell in enumerate(combined(spans[i, k], spans[k, i + length])):
                    if cell is not None:
                        _least(best, at, cell)
            spans[i, i + length] = best
    return spans[0, len(rows)]


def joined(spans: list[Cells]) -> Cells:
    """Cells of neighbouring spans together, two by two from the short to the long."""
    while len(spans) > 1:
        pairs = [combined(a, b) for a, b in zip(spans[::2], spans[1::2], strict=False)]
        spans = pairs + spans[len(spans) - len(spans) % 2 :]
    return spans[0]


@lru_cache(maxsize=_REMEMBERED)
def block_cells(rows: tuple[tuple[str, bool, bool, int], ...]) -> Cells:
    """Cells of a block; many blocks are alike in all that matters here, so the latest are remembered."""
    return parsed([row_cells(*row) for row in rows])


_CELLS = "array<struct<cost: bigint, audit: string>>"
_CELL_TYPE = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))


def _cell_batch(batch: pa.RecordBatch, charts: list[Cells]) -> pa.RecordBatch:
    cells = [[None if c is None else {"cost": c[0], "audit": c[1]} for c in chart] for chart in charts]
    rest = [batch.column(name) for name in ("conv_id", "block")]
    return pa.RecordBatch.from_arrays([*rest, pa.array(cells, _CELL_TYPE)], ["conv_id", "block", "cells"])


def _parse_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks = batch.column("parts").to_pylist()
        rows = [tuple((r["initial"], r["delete"], r["truncated"], r["copies"]) for r in block) for block in blocks]
        yield _cell_batch(batch, [block_cells(block) for block in rows])


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        groups = batch.column("parts").to_pylist()
        yield _cell_batch(
            batch,
            [joined([[c and (c["cost"], c["audit"]) for c in part["cells"]] for part in parts]) for parts in groups],
        )


def _dealt(df: DataFrame, number: Column, *columns: str) -> DataFrame:
    """At most a block's or a fan's neighbouring parts of a conversation, in order, in one row."""
    parts = F.array_sort(F.collect_list(F.struct("place", *columns))).alias("parts")
    # A fixed number of partitions: the pass is Python work, not to be merged by byte size.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = df.withColumn("block", number).repartition(partitions, "conv_id", "block")
    return numbered.groupBy("conv_id", "block").agg(parts)


def _whole_cells(rows: DataFrame) -> DataFrame:
    """``conv_id`` and the ``cells`` of each conversation, from rows with their ``place`` in it."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv}, block bigint, cells {_CELLS}"
    number = F.expr(f"(place - 1) div {BLOCK}")
    spans = _dealt(rows, number, "initial", "delete", "truncated", "copies").mapInArrow(_parse_blocks, schema)
    longest = rows.agg(F.max("place")).first()[0] or 0
    blocks = -(-longest // BLOCK)
    while blocks > 1:
        placed = spans.select("conv_id", F.col("block").alias("place"), "cells")
        spans = _dealt(placed, F.expr(f"place div {FAN}"), "cells").mapInArrow(_join_blocks, schema)
        blocks = -(-blocks // FAN)
    return spans.select("conv_id", "cells")


def damage(rows: DataFrame) -> DataFrame:
    """Rows with the faults that the checksum of their conversation and turn calls for."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    kind = F.crc32(key) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _digest() -> Column:
    return F.unhex(F.md5("text"))


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of ``copies``, faults, and ``place`` in their conversation."""
    trimmed = F.rtrim(F.col("text"), F.lit(_SPACE))
    distinct = (
        rows.select(
            "conv_id",
            "turn",
            "role",
            _digest().alias("digest"),
            (trimmed == "").alias("blank"),
            F.substring(trimmed, -1, 1).isin(".", "!", "?").alias("ended"),
            "copies",
        )
        .groupBy("conv_id", "turn", "role", "digest", "blank", "ended")
        .agg(F.sum("copies").alias("copies"))
    )
    same = ["conv_id", "role", "digest"]
    first = (
        distinct.groupBy(*same)
        .agg(F.min("turn").alias("_turn"), F.bool_or(F.col("turn").isNull()).alias("_unknown"))
        .select(*[F.col(c).alias(f"_{c}") for c in same], F.when(~F.col("_unknown"), F.col("_turn")).alias("_turn"))
    )
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same]
    seen = distinct.join(first, on[0] & on[1] & on[2]).select(
        "conv_id",
        "turn",
        "role",
        "digest",
        "copies",
        "blank",
        F.substring("role", 1, 1).alias("initial"),
        (~F.col("turn").eqNullSafe(F.col("_turn"))).alias("again"),
        "ended",
    )
    placed = running(
        seen, ["conv_id"], ["turn", "role", "digest"], {"place": row_number(), "before": previous("initial")}, sized_by=rows
    )
    delete = F.col("blank") | F.col("again")
    pair = F.concat("before", "initial")
    return placed.select(
        "conv_id",
        "turn",
        "place",
        "initial",
        "copies",
        "blank",
        delete.alias("delete"),
        (~delete & ~F.col("ended")).alias("truncated"),
        (F.col("before").isNotNull() & ~F.coalesce(pair.isin("su", "ua", "au"), F.lit(False))).alias("illegal"),
    )


def _counts(seen: DataFrame) -> DataFrame:
    """Numbers of gaps and faults per conversation."""
    wide = "decimal(20,0)"
    span = F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.countDistinct("turn")
    longest = F.lit(2**63 - 1).cast("decimal(22,0)")
    repeats = F.when(F.col("blank"), 0).when(F.col("delete"), F.col("copies")).otherwise(F.col("copies") - 1)
    return seen.groupBy("conv_id").agg(
        F.coalesce(F.least(span, longest), F.lit(0)).cast("bigint").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(repeats).alias("duplicate"),
        F.sum(F.col("truncated").cast("bigint")).alias("truncated"),
        F.sum(F.col("illegal").cast("bigint") + F.col("copies") - 1).alias("illegal"),
    )


class _Repairing:
    """One conversation under repair: reads its rows in order and digests what its audit leaves of them."""

    def __init__(self, audit: str):
        self._edits, self._at, self._state = audit, 0, _START
        self._digest, self._some = hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self._digest.update(("\n" if self._some else "").encode() + f"{role}:{text}".encode())
        self._some = True

    def _put_next(self, text: str) -> None:
        """The role that must come next, user or assistant."""
        role = "assistant" if self._state == _USER else "user"
        self._state = _NEXT[self._state, role[0]]
        self._put(role, text)

    def _insert(self) -> None:
        while self._edits[self._at : self._at + 1] == INSERT:
            self._at += 1
            self._put_next("")

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self._edits[self._at]
        self._at += 1
        if edit == KEEP:
            self._state = _NEXT[self._state, role[0]]
            self._put(role, text)
        elif edit == REROLE:
            self._put_next(text)

    def finish(self) -> str:
        self._insert()
        if self._at != len(self._edits):
            raise ValueError("an audit has more edits than its conversation has rows")
        return self._digest.hexdigest()


_REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations; each comes as its report, then its rows in order."""
    report, repairing = None, None
    schema = None
    for batch in batches:
        schema = pa.schema([*[batch.schema.field(name) for name in _REPORT], ("repaired_sha256", pa.string())])
        done = []
        columns = [batch.column(name).to_pylist() for name in ("is_row", "role", "text", "copies")]
        for k, (is_row, role, text, copies) in enumerate(zip(*columns, strict=True)):
            if is_row:
                for _ in range(copies):
                    repairing.row(role, text)
                continue
            if report is not None:
                done.append((*report, repairing.finish()))
            report = [batch.column(name)[k].as_py() for name in _REPORT]
            repairing = _Repairing(report[-1])
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
    if report is not None:
        last = [*report, repairing.finish()]
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(last, schema, strict=True)], schema=schema)


def repair(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired rows of each conversation.

    ``conversations`` names the conversations to report on by ``conv_id``; ``damaged`` has
    their rows: ``conv_id``, ``turn``, ``role``, ``text`` and the number of ``copies``.
    """
    seen = stored(faults(damaged), "conversation-rows")
    # Ending as the grammar asks; of nothing but deleted rows nothing is left.
    ends = F.array(*[F.get("cells", F.lit(4 * _START + q)) for q in _DONE])
    best = _whole_cells(seen).select("conv_id", F.array_min(F.array_compact(ends)).alias("best"))
    found = _counts(seen).withColumnRenamed("conv_id", "_conv")
    best = best.withColumnRenamed("conv_id", "_chart")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")]
    reports = (
        conversations.select("conv_id")
        .distinct()
        .join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
        .join(best, F.col("conv_id").eqNullSafe(F.col("_chart")), "left")
        .select(
            "conv_id",
            *zero,
            F.coalesce("best.cost", F.lit(0)).cast("bigint").alias("cost"),
            F.coalesce("best.audit", F.lit("")).alias("audit"),
        )
    )
    order = ["conv_id", "is_row", "turn", "role", "digest"]
    rows = damaged.withColumns({"is_row": F.lit(True), "digest": _digest()})
    both = rows.unionByName(reports.withColumn("is_row", F.lit(False)), allowMissingColumns=True)
    schema = reports.schema.add("repaired_sha256", "string")
    return both.repartition("conv_id").sortWithinPartitions(*order).drop("digest").mapInArrow(_repaired, schema)
