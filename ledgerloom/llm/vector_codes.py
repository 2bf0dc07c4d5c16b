"""Compression of vectors to one byte per part, with distances read from value dictionaries.

A component ``x`` is the integer ``floor(256 * x)``, and a vector is cut into
``PARTS`` equal consecutive parts.  Each part position has a codebook of at most
``ENTRIES`` entries, first the parts of the rows with the smallest ids, then for
``ROUNDS`` rounds the componentwise floored means of the parts nearest to each entry
(ties to the lower index; an entry without parts stays).

Distances come from dictionaries, one for each dimension of a slice of rows: the
distinct integers of the dimension, and a table of their squared differences to
that dimension of all entries.  Rows hold dictionary codes, so a part's distances
to all entries are gathers from these tables and adds.  A dictionary has at most as
many values as the slice has rows, however many the whole table has.

Codebooks are the only thing that reaches the driver: ``ENTRIES`` entries of the
vectors' length, whatever the number of rows.  A task adds up the parts of its rows
per entry before anything is shuffled.

Defined results: rows whose vector is null, empty, or holds null or non-finite
components are dropped, and so are rows with a component beyond ``LIMIT``, for which
a long could not hold the error.  The length of vectors is that of the first row by
id whose length is a multiple of ``PARTS``; rows of any other length stay, with a null
code and null error, and take no part in the codebooks.  Repeated ids are
rows each, ordered by vector; a row with a null id comes after all others.  Labels are compared as they
are, nulls together.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LIMIT = 1 << 16
_SLICE_ROWS = 4096
_SMALL = 1 << 16


def integers(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a batch that have ``size`` components, and their integers."""
    column = batch.column("vector")
    rows = np.flatnonzero(np.diff(column.offsets.to_numpy()) == size)
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    return rows, np.floor(flat.reshape(len(rows), size) * SCALE).astype(np.int64)


def value_dictionary(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct integers of a column, ascending, and the place of each row's integer among them."""
    low = int(values.min())
    width = int(values.max()) - low + 1
    if width > _SMALL:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(width, bool)
    seen[values - low] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[values - low]


def nearest(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part, ties to the lower one, and the squared distance to it."""
    parts, entries, width = books.shape
    codes = np.empty((len(vectors), parts), np.int64)
    errors = np.empty((len(vectors), parts), np.int64)
    for part in range(parts):
        distance = np.zeros((len(vectors), entries), np.int64)
        for k in range(width):
            distinct, code = value_dictionary(vectors[:, part * width + k])
            table = (distinct[:, None] - books[part, :, k][None]) ** 2
            distance += table[code]
        codes[:, part] = distance.argmin(1)
        errors[:, part] = np.take_along_axis(distance, codes[:, part : part + 1], 1)[:, 0]
    return codes, errors


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE_ROWS):
            yield batch.slice(at, _SLICE_ROWS)


def _part_sums(books: np.ndarray) -> Callable:
    """Sums and counts of the parts nearest to each entry, one row per entry that a task met."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for batch in _slices(batches):
            _, vectors = integers(batch, parts * width)
            if len(vectors):
                codes, _ = nearest(vectors, books)
                for part in range(parts):
                    counts[part] += np.bincount(codes[:, part], minlength=entries)
                    np.add.at(sums[part], codes[:, part], vectors[:, part * width : (part + 1) * width])
        part, entry = np.nonzero(counts)
        component = np.arange(width)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(np.repeat(part, width).astype(np.int32)),
                "entry": pa.array(np.repeat(entry, width).astype(np.int32)),
                "component": pa.array(np.tile(component, len(part)).astype(np.int32)),
                "total": pa.array(sums[part, entry].reshape(-1)),
                "n": pa.array(np.repeat(counts[part, entry], width)),
            }
        )

    return run


def _encoder(books: np.ndarray, names: list[str]) -> Callable:
    """Codes as hex digits and errors of whole rows."""
    parts, _, width = books.shape
    digits = np.array([f"{k:02x}" for k in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            code, error = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            rows, vectors = integers(batch, parts * width)
            if len(rows):
                found, off = nearest(vectors, books)
                code[rows] = ["".join(row) for row in digits[found]]
                error[rows] = off.sum(1)
            columns = [batch.column(name) for name in names]
            columns += [pa.array(code, pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "code", "error"])

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and the ``vector`` of the rows that can be coded."""
    # A null component and NaN (which counts as largest) fail the comparison.
    sound = F.forall("vector", lambda x: F.coalesce(F.abs(x) < LIMIT, F.lit(False)))
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    return rows.where((F.size("vector") > 0) & sound)


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """The parts of the rows with the smallest ids, as ``[part, entry, component]``; ``None`` without rows."""
    by_id = [F.col("vec_id").asc_nulls_last(), "vector"]
    first = rows.where(F.size("vector") % parts == 0).orderBy(*by_id).first()
    if first is None:
        return None
    size = len(first["vector"])
    seeds = rows.where(F.size("vector") == size).select("vec_id", "vector").orderBy(*by_id).limit(entries).collect()
    whole = np.floor(np.array([r["vector"] for r in seeds]) * SCALE).astype(np.int64)
    return whole.reshape(len(seeds), parts, size // parts).transpose(1, 0, 2).copy()


def next_books(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floored means of the parts nearest to them."""
    schema = "part int, entry int, component int, total bigint, n bigint"
    partial = rows.select("vector").mapInArrow(_part_sums(books), schema)
    moved = books.copy()
    sums = partial.groupBy("part", "entry", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    for row in sums.collect():
        moved[row["part"], row["entry"], row["component"]] = row["total"] // row["n"]
    return moved


def books_digest(books: np.ndarray) -> str:
    """Hex digest of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks of the rows that :func:`usable` gives."""
    if not 0 < entries <= 256:
        raise ValueError(f"a code of two hex digits has no room for {entries} entries")
    books = first_books(rows, parts, entries)
    for _ in range(rounds if books is not None else 0):
        books = next_books(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray | None) -> DataFrame:
    """``vec_id``, ``label``, ``code`` and ``error`` of each row."""
    schema = rows.select("vec_id", "label").schema.add("code", "string").add("error", "long")
    if books is None:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    return rows.mapInArrow(_encoder(books, ["vec_id", "label"]), schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per kept row: ``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``."""
    rows = usable(vectors)
    books = train(rows, parts, entries, rounds)
    coded = stored(encode(rows, books), "vector-codes")
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    placed = coded.join(per_label, F.col("label").eqNullSafe(F.col("_label")))
    digest = books_digest(books) if books is not None else hashlib.sha256(b"").hexdigest()
    return placed.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
