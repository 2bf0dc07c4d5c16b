"""Packing token pieces into sequences of bounded length.

Only lengths matter for the plan, and there are at most ``capacity`` of them, so
the plan is made from a table of counts per length, whatever the number of
documents.  Exact complements come first: a length is completed by one, two or
three available lengths that fill its gap exactly, as often as the counts allow.
What is left is packed best-fit, longest first.  The plan says, for the pieces
of a length in a fixed order, from which to which rank they go where; pieces
find their place by rank.

Defined results: a null or empty text is one piece with the end id alone; rows
with the same ``doc_id`` are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import stored
from .tokens import default_tokenizer, encoder

CAPACITY = 2048
_ROWS_PER_BUCKET = 4096
_MAX_BUCKETS = 4096
_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``capacity`` ids; a longer document's first piece takes what does not fill one."""
    path = tokenizer or default_tokenizer()

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                pieces = -(-len(ids) // capacity)
                bounds = [0, *range(len(ids) - capacity * (pieces - 1), len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    raw = ids[a:b].astype("<u4").tobytes()
                    for column, value in zip(rows, (doc, k, a, b - a, zlib.crc32(raw), raw if with_ids else None), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(v, t) for v, t in zip(rows, kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            kept = len(columns) if with_ids else 5
            yield pa.RecordBatch.from_arrays(columns[:kept], names[:kept])

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return chosen.mapInArrow(process, _PIECE + (", ids binary" if with_ids else ""))


Group = tuple[int, list[int]]  # how many sequences, and the lengths each holds


def _exact(counts: np.ndarray, capacity: int) -> list[Group]:
    """Sequences filled exactly by a length and at most three that complete it; takes them from ``counts``."""
    groups: list[Group] = []
    if counts[capacity]:
        groups.append((int(counts[capacity]), [capacity]))
        counts[capacity] = 0
    there = counts > 0

    def take(lengths: list[int]) -> None:
        need: dict[int, int] = {}
        for v in lengths:
            need[v] = need.get(v, 0) + 1
        times = min(int(counts[v]) // k for v, k in need.items())
        if times:
            groups.append((times, lengths))
            for v, k in need.items():
                counts[v] -= times * k
        for v in need:
            there[v] = counts[v] > 0

    def pairs(gap: int, length: int) -> Iterator[tuple[int, int]]:
        a = np.arange(gap - 1, (gap - 1) // 2, -1)
        for x in a[there[a] & there[gap - a]]:
            yield int(x), int(gap - x)

    for length in range(capacity - 1, 0, -1):
        gap = capacity - length
        if counts[length] and there[gap]:
            take([length, gap])
        for a, b in pairs(gap, length):
            if not counts[length]:
                break
            if counts[a] and counts[b]:
                take([length, a, b])
        if not counts[length]:
            continue
        low = there[: gap + 1].astype(np.int64)
        sums = np.rint(np.fft.irfft(np.fft.rfft(low, 2 * gap + 2) ** 2))[: gap + 1] > 0
        third = np.arange(gap - 2, 0, -1)
        for a in third[there[third] & sums[gap - third]]:
            if not counts[length]:
                break
            for b, c in pairs(gap - int(a), length):
                if counts[length] and counts[a] and counts[b] and counts[c]:
                    take([length, int(a), b, c])
                if not counts[length] or not counts[a]:
                    break
    return groups


def _best_fit(counts: np.ndarray, capacity: int) -> list[Group]:
    """Best-fit, longest first, for all sequences with equal gaps at once."""
    open_by_gap: dict[int, list[Group]] = {}
    gaps = np.zeros(capacity + 1, bool)
    done: list[Group] = []

    def put(gap: int, group: Group) -> None:
        if gap:
            open_by_gap.setdefault(gap, []).append(group)
            gaps[gap] = True
        else:
            done.append(group)

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            fits = np.flatnonzero(gaps[length:])
            if len(fits):
                gap = int(fits[0]) + length
                n, lengths = open_by_gap[gap].pop()
                if not open_by_gap[gap]:
                    gaps[gap] = False
            else:
                gap, n, lengths = capacity, left, []
            each = min(gap // length, left)
            many = min(n, left // each)
            if n > many and lengths:
                put(gap, (n - many, lengths))
            put(gap - each * length, (many, lengths + [length] * each))
            left -= many * each
    return done + [g for groups in open_by_gap.values() for g in groups]


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """How many sequences hold which lengths, for so many pieces of each length."""
    table = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit a sequence of {capacity}")
        table[length] = n
    return _exact(table, capacity) + _best_fit(table, capacity)


def _runs(groups: list[Group], capacity: int) -> dict[str, np.ndarray]:
    """For ranks of each length: where a run of ranks begins, its first sequence, and its offset."""
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for times, lengths in groups:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``length`` is a column, ``order`` tells pieces apart.

    ``pieces`` is read several times and should be a stored table.  Ranks are
    counted in buckets of each length, so that a length that many pieces have is
    not numbered by one task.
    """
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = min(_MAX_BUCKETS, 1 + sum(counts.values()) // _ROWS_PER_BUCKET)
    runs = _runs(pack_lengths(counts, capacity), capacity)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        dealt.groupBy("length", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    )
    within = Window.partitionBy("length", "_bucket").orderBy(*order)
    ranked = (
        dealt.withColumn("_row", F.row_number().over(within) - 1)
        .join(base, ["length", "_bucket"])
        .withColumn("_rank", F.col("_base") + F.col("_row"))
        .select(*pieces.columns, "_rank")
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Runs are sorted by length and rank, so one number finds a piece's run.
        span = np.int64(1 << 44)
        keys = runs["length"] * span + runs["rank"]
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length.astype(np.int64) * span + rank, "right") - 1
            added = [pa.array(runs["sequence"][at] + rank - runs["rank"][at]), pa.array(runs["offset"][at])]
            names = [*batch.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names)

    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces with their places in the packed sequences."""
    pieces = stored(token_pieces(docs, tokenizer, capacity), "pieces")
    return pack(pieces, ["doc_id", "piece", "start", "ids_crc32"], capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces that carry their ``ids``; each is bounded by the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.expr("cast(x'' as binary)"), lambda whole, p: F.concat(whole, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))
