"""Running computations per key that never put a whole key into one task.

A window ``partitionBy(key).orderBy(...)`` sends every row of a key to one task.
That is right for the long tail of keys and wrong for a key that holds a large
share of the table.  :func:`running` keeps the plain window for ordinary keys
and cuts hot keys into consecutive chunks of bounded size:

1. one pass counts the rows by buckets of key hashes and, only if a bucket is too large
   for one task, another finds the heavy keys with Spark's frequent-items sketch;
2. a bounded sample of the hot keys' positions gives split points (the way a
   range partitioner picks its bounds), held by the driver as a few thousand
   literals, so that retries and lost executors always see the same chunks; rows
   are written out with a random last sort column first, so that even a position
   shared by very many copies can be cut;
3. the window runs per ``(key, chunk)``; what earlier chunks contribute is a
   per-chunk summary (for the row after, later ones), prefix-combined over at most ``MAX_CHUNKS`` rows and
   broadcast back.

The sample only decides where to cut; every row takes part in the result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

ROWS_PER_CHUNK = 4_000_000
MAX_CHUNKS = 4096
_TRACKED_ITEMS = 131_072
_COUNTED_BUCKETS = 16 * MAX_CHUNKS
_SAMPLES_PER_CHUNK = 32

_HASH = "_key_hash"
_BOUNDS = "_bounds"
_TIE = "_tie"
CHUNK = "_chunk"


@dataclass(frozen=True)
class Scan:
    """One running column; build it with the helpers below."""

    kind: str
    column: Column | None = None


def running_sum(column: str | Column) -> Scan:
    """Sum from the start of the key up to and including the row."""
    return Scan("sum", _col(column))


def row_number() -> Scan:
    """1-based position of the row in its key."""
    return Scan("number")


def last_value(column: str | Column) -> Scan:
    """Latest non-null value up to and including the row."""
    return Scan("last", _col(column))


def previous(column: str | Column) -> Scan:
    """Value on the row before, null on the first row of the key."""
    return Scan("previous", _col(column))


def following(column: str | Column) -> Scan:
    """Value on the row after, null on the last row of the key."""
    return Scan("following", _col(column))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def heavy_keys(df: DataFrame, keys: list[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> tuple[int, dict[int, int]]:
    """Chunk size for the table, and the key hashes with more rows than that.

    At most ``MAX_CHUNKS`` keys can be that large.  Rows are counted by buckets of key hashes;
    a key has no more rows than its bucket, so keys are looked at only if a bucket is too large.
    """
    key = F.xxhash64(*keys).alias(_HASH)
    per_bucket = df.select(F.pmod(key, F.lit(_COUNTED_BUCKETS)).alias("bucket")).groupBy("bucket").count()
    total, largest = per_bucket.agg(F.sum("count"), F.max("count")).first()
    size = max(rows_per_chunk, (total or 0) // MAX_CHUNKS)
    if (largest or 0) <= size:
        return size, {}
    sketch = F.expr(f"approx_top_k({_HASH}, {MAX_CHUNKS}, {_TRACKED_ITEMS})")
    frequent = df.select(key).agg(sketch).first()[0]
    return size, {item["item"]: item["count"] for item in frequent if item["count"] > size}


def hot_key_bounds(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rows_per_chunk: int = ROWS_PER_CHUNK,
    sized_by: DataFrame | None = None,
) -> DataFrame | None:
    """Split points of the keys too large for one task, or ``None`` if there are none.

    One row per hot key: its hash and the sorted array of chunk starts.  All keys
    together have at most about ``MAX_CHUNKS`` split points.  ``sized_by`` is a
    frame that is cheaper to read than ``df`` and has about as many rows per key
    or more, such as the table ``df`` was aggregated from.
    """
    size, hot = heavy_keys(df if sized_by is None else sized_by, keys, rows_per_chunk)
    return bounds_of(df, keys, order, size, hot) if hot else None


def bounds_of(df: DataFrame, keys: list[str], order: list[str], size: int, hot: dict[int, int]) -> DataFrame:
    """Split points that cut the keys with hashes in ``hot`` into chunks of about ``size`` rows."""
    probe = df.select(F.xxhash64(*keys).alias(_HASH), F.struct(*order).alias("position"))
    chunks = sum(n // size + 1 for n in hot.values())
    fraction = min(1.0, _SAMPLES_PER_CHUNK * chunks / sum(hot.values()))
    sampled = probe.where(F.col(_HASH).isin(list(hot))).sample(fraction, seed=7).collect()
    points: dict[int, list] = {}
    for row in sorted(sampled, key=lambda r: tuple((v is not None, v) for v in r["position"])):
        points.setdefault(row[_HASH], []).append(row["position"])
    rows = []
    for key, found in points.items():
        wanted = hot[key] // size + 1
        cuts = {found[len(found) * i // wanted] for i in range(1, wanted)}
        rows.append((key, list(cuts)))
    schema = f"{_HASH} bigint, {_BOUNDS} array<{probe.schema['position'].dataType.simpleString()}>"
    local = df.sparkSession.createDataFrame(rows, schema)
    return local.select(_HASH, F.array_sort(_BOUNDS).alias(_BOUNDS))


def _chunk_of(position: Column) -> Column:
    """How many split points are at or before ``position`` (binary descent over the bounds)."""
    steps = F.array(*[F.lit(2**k) for k in range(MAX_CHUNKS.bit_length(), -1, -1)])
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(_BOUNDS, at + step - 1) <= position, at + step).otherwise(at),
    )
    return F.when(F.col(_BOUNDS).isNull(), F.lit(0)).otherwise(found)


def with_chunks(df: DataFrame, keys: list[str], order: list[str], bounds: DataFrame) -> DataFrame:
    """Add the chunk number; rows of ordinary keys are all in chunk 0."""
    marked = df.withColumn(_HASH, F.xxhash64(*keys)).join(F.broadcast(bounds), _HASH, "left")
    return marked.withColumn(CHUNK, _chunk_of(F.struct(*order))).drop(_HASH, _BOUNDS)


def hot_rows(df: DataFrame, keys: list[str], bounds: DataFrame) -> DataFrame:
    """Rows of the keys that were cut."""
    hashed = df.withColumn(_HASH, F.xxhash64(*keys))
    return hashed.join(F.broadcast(bounds.select(_HASH)), _HASH, "left_semi").drop(_HASH)


def cold_rows(df: DataFrame, keys: list[str], bounds: DataFrame) -> DataFrame:
    """Rows of all other keys."""
    hashed = df.withColumn(_HASH, F.xxhash64(*keys))
    return hashed.join(F.broadcast(bounds.select(_HASH)), _HASH, "left_anti").drop(_HASH)


def join_unique(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    rows_per_chunk: int = ROWS_PER_CHUNK,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Inner join with a ``right`` side that has one row per key.

    Keys with very many rows on the left are joined with a broadcast of their few
    right rows (at most ``MAX_CHUNKS``, hash collisions aside), so that no task
    gets all of their left rows; the others go through an ordinary join.
    """
    _, heavy = heavy_keys(left if sized_by is None else sized_by, keys, rows_per_chunk)
    if not heavy:
        return left.join(right, keys)
    is_heavy = F.xxhash64(*keys).isin(list(heavy))
    hot = left.where(is_heavy).join(F.broadcast(right.where(is_heavy)), keys)
    return hot.unionByName(left.where(~is_heavy).join(right.where(~is_heavy), keys))


def same_key(left: DataFrame, right: DataFrame, keys: list[str], prefix: str = "_r_") -> Column:
    """Null-safe equality of ``keys`` with the ``prefix``ed columns of ``right``."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys])


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, Scan],
    rows_per_chunk: int = ROWS_PER_CHUNK,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add running ``columns`` per key, ordered by the ascending columns ``order``.

    ``order`` should identify a row within its key; tied rows are interchangeable.
    """
    size, heavy = heavy_keys(df if sized_by is None else sized_by, keys, rows_per_chunk)
    if not heavy:
        return windowed(df, keys, order, columns)
    stored, order = checkpointed(df.withColumn(_TIE, F.rand(11))), [*order, _TIE]
    bounds = bounds_of(stored, keys, order, size, heavy)
    return running_within(stored, keys, order, columns, bounds).drop(_TIE)


def running_within(
    df: DataFrame, keys: list[str], order: list[str], columns: dict[str, Scan], bounds: DataFrame
) -> DataFrame:
    """As :func:`running` with split points that are already known."""
    chunked = with_chunks(df, keys, order, bounds)
    local = windowed(chunked, [*keys, CHUNK], order, columns)
    carry = _carries(with_chunks(hot_rows(df, keys, bounds), keys, order, bounds), keys, order, columns)
    at = [*keys, CHUNK]
    carry = carry.select(*[F.col(k).alias("_r_" + k) for k in at], *[F.col(c).alias("_c_" + c) for c in columns])
    joined = local.join(F.broadcast(carry), same_key(local, carry, at), "left")
    out = []
    for name, scan in columns.items():
        here, before = F.col(name), F.col("_c_" + name)
        if scan.kind == "sum":
            value = F.when(before.isNull(), here).otherwise(F.coalesce(here, F.lit(0)) + before)
        elif scan.kind == "number":
            value = here + F.coalesce(before, F.lit(0))
        elif scan.kind == "last":
            value = F.coalesce(here, before)
        elif scan.kind == "following":
            value = F.when(F.col("_last_" + name), before).otherwise(here)
        else:
            value = F.when(F.col("_first_" + name), before).otherwise(here)
        out.append(value.alias(name))
    return joined.select(*df.columns, *out)


def windowed(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, Scan]) -> DataFrame:
    """The running columns by plain windows, for keys known to be of ordinary size."""
    over = Window.partitionBy(*keys).orderBy(*order)
    upto = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = []
    for name, scan in columns.items():
        if scan.kind == "sum":
            value = F.sum(scan.column).over(upto)
        elif scan.kind == "number":
            value = F.row_number().over(over).cast("bigint")
        elif scan.kind == "last":
            value = F.last(scan.column, ignorenulls=True).over(upto)
        elif scan.kind == "following":
            value = F.lead(scan.column).over(over)
            if CHUNK in keys:
                out.append(F.lead(F.lit(True)).over(over).isNull().alias("_last_" + name))
        else:
            value = F.lag(scan.column).over(over)
            if CHUNK in keys:
                out.append((F.row_number().over(over) == 1).alias("_first_" + name))
        out.append(value.alias(name))
    return df.select("*", *out)


def _carries(hot: DataFrame, keys: list[str], order: list[str], columns: dict[str, Scan]) -> DataFrame:
    """What all chunks before a chunk contribute, one row per (hot key, chunk)."""
    position = F.struct(*order)
    totals = []
    for name, scan in columns.items():
        if scan.kind == "sum":
            value = F.sum(scan.column)
        elif scan.kind == "number":
            value = F.count(F.lit(1))
        elif scan.kind == "last":
            value = F.max_by(scan.column, F.when(scan.column.isNotNull(), position))
        elif scan.kind == "following":
            value = F.min_by(F.struct(scan.column.alias("v")), position)
        else:
            value = F.max_by(F.struct(scan.column.alias("v")), position)
        totals.append(value.alias(name))
    summary = hot.groupBy(*keys, CHUNK).agg(*totals)
    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    carries = []
    for name, scan in columns.items():
        if scan.kind in ("sum", "number"):
            carries.append(F.sum(name).over(before).alias(name))
        elif scan.kind == "last":
            carries.append(F.last(name, ignorenulls=True).over(before).alias(name))
        elif scan.kind == "following":
            carries.append(F.lead(name).over(by_chunk).getField("v").alias(name))
        else:
            carries.append(F.last(name).over(before).getField("v").alias(name))
    return summary.select(*keys, CHUNK, *carries)
