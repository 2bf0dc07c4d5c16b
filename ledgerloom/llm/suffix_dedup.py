"""Removal of byte strings that occur more than once, by suffix sorting.

A byte goes if a string of ``LENGTH`` bytes around it starts at another place too, in
this text or another one.  Texts are UTF-8 bytes; strings do not cross texts.

Each string of ``LENGTH`` bytes is known by its anchor, the leftmost of its grams with
the least hash.  Neighbouring strings with the same anchor are one place, so a text is
a row of places, each some ``LENGTH / 2`` strings long, and equal strings lie at the same
distance from equal anchors, wherever they are.  So

1. digests of places are counted: a place found more than once is repeated whole;
2. what is left are places found once whose anchor has other surroundings elsewhere.  Only
   these, and one of each of those others, are cut from the texts and brought
   together by anchor;
3. there the suffixes at one distance from one anchor are sorted by a merge sort in which
   a comparison finds the common extension of two suffixes by binary search over
   prefix polynomial hashes, a logarithmic number of steps.  Neighbours in the order
   that agree in ``LENGTH`` bytes are repeated strings.  Every neighbour's extension
   is compared byte by byte before it counts; if a hash was wrong, the sort is
   done again with other hashes.

Anchors with more than ``GROUP`` different surroundings are not sorted in one task: their
strings are counted by digest, which Spark can add up before it shuffles them.

Defined results: a null text is empty; texts shorter than ``LENGTH`` bytes keep all;
repeated rows are texts each, so of equal texts of that length all bytes go; a text
is known by its MD5 and its place by a 128-bit digest; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored
from .text import mixed, slices, utf8

LENGTH = 200
GRAM = 24
GROUP = 4096
_SEGMENT = 1 << 18
_SORT_BYTES = 1 << 18
_POSITION_BITS = 24
_ROWS = 512
_BASE = 0x9E3779B97F4A7C15


class PrefixHashes:
    """Hashes of any byte ranges of one buffer, from prefix sums of a polynomial modulo 2**64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 0):
        value, power, self._inverse = self._tables(seed, len(data))
        self._all: tuple[int, np.ndarray | None] = (0, None)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value[data] * power[: len(data)], out=self._sums[1:])

    @classmethod
    def _tables(cls, seed: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = cls._powers.get(seed)
        if found is None or len(found[1]) < size:
            rng = np.random.default_rng(seed + 31)
            value = rng.integers(0, 2**64, 256, dtype=np.uint64)
            base = (_BASE + 8 * seed) | 1
            tables = []
            for step in (base, pow(base, -1, 1 << 64)):
                steps = np.full(max(size, _SEGMENT), step, np.uint64)
                steps[0] = 1
                tables.append(np.cumprod(steps, dtype=np.uint64))
            found = cls._powers[seed] = (value, *tables)
        return found

    def all(self, length: int) -> np.ndarray:
        """Of every range of ``length`` bytes; those of the last length asked for are kept."""
        if self._all[0] != length:
            self._all = (length, (self._sums[length:] - self._sums[:-length]) * self._inverse[: len(self._sums) - length])
        return self._all[1]

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self._sums[start + length] - self._sums[start]) * self._inverse[start]


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring keys, from running minima to the left and right inside blocks."""
    count = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[:count], upto[width - 1 : width - 1 + count])


def places(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The places of texts: first string, number of strings, anchor position and anchor hash of each."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    grams = mixed(PrefixHashes(data).all(gram))
    low = np.uint64((1 << _POSITION_BITS) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_least(keys, length - gram + 1) & low).astype(np.int64)
    # Strings that end in the text they start in, and of those each that changes the anchor.
    inside = np.arange(length, length + len(anchor)) <= np.repeat(offsets[1:], np.diff(offsets))[: len(anchor)]
    first = inside.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    at = np.flatnonzero(first)
    number = np.add.reduceat(inside, at, dtype=np.int64) if len(at) else none
    return at, number, anchor[at], grams[anchor[at]].view(np.int64)


def _digest(before: int, body: bytes) -> bytes:
    return hashlib.blake2b(before.to_bytes(4, "little") + body, digest_size=16).digest()


def _segments(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Texts together up to some size; a longer one by itself in parts that overlap by a string but one."""
    data, offsets = utf8(column)
    for a, b in slices(offsets, _SEGMENT):
        part = data[offsets[a] : offsets[b]]
        if b - a > 1 or len(part) <= _SEGMENT:
            yield a, part, offsets[a : b + 1] - offsets[a], 0
            continue
        for at in range(0, max(len(part) - length + 1, 1), _SEGMENT):
            piece = part[at : at + _SEGMENT + length - 1]
            yield a, piece, np.array([0, len(piece)]), at


def _found_places(length: int, gram: int, located: bool) -> Callable:
    """Anchor and digest of every place; where it is, if ``located``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("key") if located else None
            for first, data, offsets, skipped in _segments(batch.column("text"), length):
                at, number, anchor, grams = places(data, offsets, length, gram)
                whole, before = data.tobytes(), anchor - at
                ends = at + number + length - 1
                digests = [_digest(d, whole[a:b]) for d, a, b in zip(before.tolist(), at.tolist(), ends.tolist(), strict=True)]
                columns = {"place": pa.array(digests, pa.binary())}
                if located:
                    text = np.searchsorted(offsets, at, "right") - 1
                    columns["key"] = names.take(pa.array(first + text))
                    columns["start"] = pa.array(at - offsets[text] + skipped)
                    columns["strings"] = pa.array(number.astype(np.int32))
                    columns["before"] = pa.array(before.astype(np.int32))
                else:
                    columns["anchor"] = pa.array(grams)
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bounded number of rows at a time, as Python objects of lists of places take many times the bytes."""
    for batch in batches:
        for a in range(0, max(batch.num_rows, 1), _ROWS):
            yield batch.slice(a, _ROWS)


def _cut_out(length: int) -> Callable:
    """The bytes of the places that are to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            out = []
            for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist(), strict=True):
                whole = text.as_buffer()
                for w in wanted:
                    body = whole[w["start"] : w["start"] + w["strings"] + length - 1].to_pybytes()
                    out.append((w["anchor"], w["others"], w["place"], w["before"], w["once"], body))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.binary()]
            names = ["anchor", "others", "place", "before", "once", "body"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return run


def common_extension(hashes: PrefixHashes, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """In how many bytes, ``length`` at most, the suffixes at ``a`` and ``b`` agree."""
    whole = hashes.all(length)
    agreed = np.where(whole[a] == whole[b], length, 0)
    open_ = np.flatnonzero(agreed < length)
    low, high = np.zeros(len(open_), np.int64), np.full(len(open_), length)
    x, y = a[open_], b[open_]
    for _ in range(int(length).bit_length()):
        middle = (low + high) // 2
        same = hashes.of(x, middle) == hashes.of(y, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle)
    agreed[open_] = low
    return agreed


def _heads(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as a number in their order; zeros follow the last byte."""
    padded = np.append(data, np.zeros(16, np.uint8))
    return np.ndarray(len(padded) - 7, ">u8", padded, strides=(1,)).astype(np.uint64)


# Of a head, its first 0 to 8 bytes.
_FIRST = np.array([(1 << 64) - (1 << 64 - 8 * n) for n in range(9)], np.uint64)


def _before(
    data: np.ndarray, heads: np.ndarray, hashes: PrefixHashes, a: np.ndarray, b: np.ndarray, length: int, ties: np.ndarray
) -> np.ndarray:
    """Whether the suffixes at ``a`` come before those at ``b``; of equal ones, what ``ties`` says.

    Their heads tell most apart; of the others the common extension is found.
    """
    first = _FIRST[min(length, 8)]
    x, y = heads[a] & first, heads[b] & first
    before = x < y
    open_ = np.flatnonzero(x == y)
    x, y = a[open_], b[open_]
    agreed = common_extension(hashes, x, y, length)
    equal = agreed >= length
    last = np.where(equal, 0, agreed)
    before[open_] = np.where(equal, ties[open_], data[x + last] < data[y + last])
    return before


def sorted_suffixes(data: np.ndarray, hashes: PrefixHashes, at: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """Order of the suffixes at ``at`` by bucket and their first ``length`` bytes.

    ``bucket`` is ascending.  A merge sort of all buckets at once: runs of a bucket are
    merged in pairs, each suffix finding its rank in the neighbouring run by binary search.
    """
    order, heads = np.arange(len(at)), _heads(data)
    edge = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1)) if len(at) else order
    sizes = np.diff(np.append(edge, len(at)))
    begin, size = np.repeat(edge, sizes), np.repeat(sizes, sizes)
    width, largest = 1, int(sizes.max(initial=0))
    while width < largest:
        open_ = np.flatnonzero(size > width)
        start, own = begin[open_], at[order[open_]]
        place = open_ - start
        run = place // width
        right = run % 2 == 1
        sibling = start + (run ^ 1) * width
        low, high = np.zeros(len(open_), np.int64), np.clip(start + size[open_] - sibling, 0, width)
        for _ in range(width.bit_length()):
            active = np.flatnonzero(low < high)
            if not len(active):
                break
            middle = (low[active] + high[active]) // 2
            other = at[order[sibling[active] + middle]]
            # A right one goes behind its equals on the left, a left one before those on the right.
            passed = _before(data, heads, hashes, other, own[active], length, right[active])
            low[active] = np.where(passed, middle + 1, low[active])
            high[active] = np.where(passed, high[active], middle)
        order[start + (run - right) * width + place - run * width + low] = order[open_]
        width *= 2
    return order


def _verified(data: np.ndarray, a: np.ndarray, b: np.ndarray, agreed: np.ndarray, length: int) -> bool:
    """Whether suffixes agree in as many bytes as their hashes say, and the next byte is in order."""
    heads = _heads(data)
    order = np.argsort(-agreed, kind="stable")
    x, y, n = a[order], b[order], agreed[order]
    # Eight bytes at a time, of those that agree in so many; then what is left of each.
    for k in range(8, length + 1, 8):
        longer = np.searchsorted(-n, -k, "right")
        if not longer:
            break
        if (heads[x[:longer] + (k - 8)] != heads[y[:longer] + (k - 8)]).any():
            return False
    done = n - n % 8
    if ((heads[x + done] ^ heads[y + done]) & _FIRST[n % 8]).any():
        return False
    open_ = n < length
    last = n[open_]
    return bool((data[x[open_] + last] < data[y[open_] + last]).all())


def repeated_suffixes(data: np.ndarray, at: np.ndarray, bucket: np.ndarray, length: int, seed: int = 1) -> np.ndarray:
    """Whether each suffix shares its first ``length`` bytes with another one of its bucket."""
    while True:
        hashes = PrefixHashes(data, seed)
        order = sorted_suffixes(data, hashes, at, bucket, length)
        suffix, home = at[order], bucket[order]
        near = np.flatnonzero(home[1:] == home[:-1])
        agreed = common_extension(hashes, suffix[near], suffix[near + 1], length)
        if _verified(data, suffix[near], suffix[near + 1], agreed, length):
            break
        seed += 1
    hit = near[agreed >= length]
    found = np.zeros(len(at), bool)
    found[order[hit]] = True
    found[order[hit + 1]] = True
    return found


def _repeated_in(groups: list[list[tuple[bytes, int, bytes, bool]]], length: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Of groups of places with one anchor each: the place and the numbers from and to of its repeated strings."""
    rows = [(k, *row) for k, group in enumerate(groups) for row in group]
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    sizes = np.array([len(r[3]) for r in rows])
    strings = sizes - length + 1
    base = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(rows)), strings)
    number = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
    ahead = np.array([r[2] for r in rows])[row] - number
    bucket = np.array([r[0] for r in rows])[row] * length + ahead
    # Only where strings meet, and one of them is in a place found once.
    met = np.bincount(bucket) > 1
    open_ = met & (np.bincount(bucket, np.array([r[4] for r in rows])[row]) > 0)
    taken = np.flatnonzero(open_[bucket])
    taken = taken[np.argsort(bucket[taken], kind="stable")]
    found = np.zeros(len(row), bool)
    found[taken] = repeated_suffixes(data, (base[row] + number)[taken], bucket[taken], length)
    begins = found.copy()
    begins[1:] &= ~found[:-1] | (row[1:] != row[:-1])
    ends = found.copy()
    ends[:-1] &= ~found[1:] | (row[1:] != row[:-1])
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    return [rows[k][1] for k in row[first]], number[first], number[last]


def _compare(length: int) -> Callable:
    """Repeated strings of places that come together by anchor."""

    def batch_of(groups: list) -> pa.RecordBatch:
        place, first, last = _repeated_in(groups, length) if groups else ([], [], [])
        columns = [pa.array(place, pa.binary()), pa.array(first, pa.int32()), pa.array(last, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["place", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, anchor, held = [], None, 0
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("anchor", "place", "before", "body", "once")]
            for own, place, before, body, once in zip(*columns, strict=True):
                if not groups or own != anchor:
                    if held > _SORT_BYTES:
                        yield batch_of(groups)
                        groups, held = [], 0
                    groups.append([])
                    anchor = own
                groups[-1].append((place, before, body, once))
                held += len(body)
        yield batch_of(groups)

    return run


def _string_digests(length: int) -> Callable:
    """The digest of every string of the places that are to be compared, cut out by the same worker."""
    cut_out = _cut_out(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_out(batches):
            for place, body in zip(batch.column("place").to_pylist(), batch.column("body").to_pylist(), strict=True):
                digests = [_digest(0, body[k : k + length]) for k in range(len(body) - length + 1)]
                columns = [pa.array([place] * len(digests), pa.binary()), pa.array(digests, pa.binary())]
                columns.append(pa.array(range(len(digests)), pa.int32()))
                yield pa.RecordBatch.from_arrays(columns, ["place", "string", "number"])

    return run


def _without_repeats(length: int) -> Callable:
    """Counts and digest of what the repeated strings leave of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            out = []
            for text, found in zip(batch.column("text"), batch.column("found").to_pylist(), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                edges = np.zeros(len(data) + 1, np.int64)
                if found:
                    np.add.at(edges, [f["start"] for f in found], 1)
                    np.add.at(edges, [f["end"] for f in found], -1)
                gone = np.cumsum(edges)[:-1] > 0
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                kept = hashlib.sha256(data[~gone].tobytes()).hexdigest()
                out.append((len(data), int(gone.sum()), spans, kept))
            counts = list(zip(*out, strict=True)) if out else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(counts, types, strict=True)]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def _repeated_strings(texts: DataFrame, length: int, group: int) -> DataFrame:
    """``place`` and the numbers from ``first`` to ``last`` of its strings that occur again; of texts and ``wanted`` places."""

    def of(chosen: Callable[[Column], Column]) -> DataFrame:
        return texts.withColumn("wanted", F.filter("wanted", lambda w: chosen(w["others"]))).where(F.size("wanted") > 0)

    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bodies = of(lambda others: others <= group).mapInArrow(
        _cut_out(length), "anchor bigint, others bigint, place binary, before int, once boolean, body binary"
    )
    by_anchor = bodies.repartition(partitions, "anchor").sortWithinPartitions("anchor")
    found = by_anchor.mapInArrow(_compare(length), "place binary, first int, last int")
    strings = of(lambda others: others > group).mapInArrow(_string_digests(length), "place binary, string binary, number int")
    often = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    more = strings.join(often, "string").select("place", F.col("number").alias("first"), F.col("number").alias("last"))
    return found.unionByName(more)


def without_repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    # Never null as Spark sees it, so that both joins below share one shuffle of the texts.
    key = F.coalesce(F.unhex(F.md5("text")), F.lit(bytearray(16)))
    texts = docs.select("doc_id", text.alias("text")).withColumn("key", key)
    counted = (
        texts.select("text")
        .mapInArrow(_found_places(length, gram, False), "place binary not null, anchor bigint not null")
        .groupBy("anchor", "place")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Anchors with different surroundings, some of them found once.
    mixed_anchors = (
        counted.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("others"), F.min("n").alias("least"))
        .where("others > 1 and least = 1")
        .select("anchor", "others")
    )
    known = counted.join(mixed_anchors, "anchor", "left").where("n > 1 or others is not null")
    located = texts.select("text", "key").mapInArrow(
        _found_places(length, gram, True), "place binary, key binary, start bigint, strings int, before int"
    )
    where = stored(
        located.join(known, "place").select(
            "key",
            "start",
            "strings",
            F.when(F.col("n") > 1, True).alias("whole"),
            *[F.when(F.col("others").isNotNull(), F.col(c)).alias(c) for c in ("place", "before", "anchor", "others")],
        ),
        "places",
    )
    one_of_each = (
        where.where("others is not null")
        .groupBy("place", "before", "anchor", "others", "strings", F.col("whole").isNull().alias("once"))
        .agg(F.min(F.struct("key", "start")).alias("at"))
    )
    wanted = one_of_each.groupBy("at.key").agg(
        F.collect_list(F.struct("place", "before", "anchor", "others", "strings", "once", "at.start")).alias("wanted")
    )
    cut = texts.join(wanted, "key").dropDuplicates(["key"]).select("doc_id", "text", "wanted")
    once = where.where("whole is null").join(_repeated_strings(cut, length, group), "place")
    found = (
        where.where("whole")
        .select("key", "start", (F.col("start") + F.col("strings") - 1 + length).alias("end"))
        .unionByName(
            once.select(
                "key",
                (F.col("start") + F.col("first")).alias("start"),
                (F.col("start") + F.col("last") + length).alias("end"),
            )
        )
        .distinct()
        .groupBy("key")
        .agg(F.collect_list(F.struct("start", "end")).alias("found"))
    )
    schema = docs.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    schema = schema.add("kept_sha256", "string")
    return texts.join(found, "key", "left").select("doc_id", "text", "found").mapInArrow(_without_repeats(length), schema)
