"""Words of documents that lie inside passages of a benchmark.

A window is a run of words of an item: ``WINDOW`` of them, or the whole item if
it is shorter.  A window is contained in a document only if each of its shingles
(runs of up to three words) is, so one shingle is enough of a prefix: the rarest
one over all documents.  Documents are joined with the windows on it.  A match
gives the one place where the window could stand; length and position bounds
drop it if the document has no room there, and the words are then compared.

Windows are taken in blocks of bounded size, each sent to all tasks and passed
over the documents, so neither side is ever held whole.

Defined results: null and empty texts have no words and are not contaminated;
an item without words has no window; repeated items count by their ids, repeated
documents each; an empty table of items hits nothing; words are compared after
``A-Z`` is lower-cased; other columns of the documents stay, but for those named
as a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import stored
from .text import NOT_ALNUM, Hasher, Words, grams, slices, utf8

WINDOW = 13
SHINGLE = 3
WINDOWS_PER_BLOCK = 500_000

_WINDOW = "item_id string, words int, window binary, shingles binary"
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("hits", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of each item: words joined by a space, and the hashes of its shingles in order."""

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            names, sizes, texts, hashes = [], [], [], []
            for a, b in slices(offsets):
                words = hasher.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], NOT_ALNUM)
                raw = words.data.tobytes()
                for row in range(a, b):
                    first, last = words.first[row - a], words.first[row - a + 1]
                    n = min(window, last - first)
                    size = min(SHINGLE, n)
                    for w in range(first, last - n + 1) if n else ():
                        names.append(batch.column(0)[row].as_py())
                        sizes.append(n)
                        texts.append(b" ".join(raw[words.start[k] : words.end[k]] for k in range(w, w + n)))
                        own = Words(words.data, words.start[w : w + n], words.end[w : w + n], words.hash[w : w + n], np.array([0, n]))
                        hashes.append(grams(own, size)[0].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(sizes, pa.int32()), pa.array(texts, pa.binary()), pa.array(hashes, pa.binary())],
                ["item_id", "words", "window", "shingles"],
            )

    chosen = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return chosen.mapInArrow(process, _WINDOW).distinct()


@dataclass
class Block:
    """Some windows, by number: size, text, items; and where each one's key shingle is."""

    sizes: np.ndarray
    texts: list[bytes]
    items: list[list[str]]
    keys: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    shingle: np.ndarray


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def shingle_counts(docs: DataFrame, wanted: np.ndarray, shingle_sizes: list[int]) -> np.ndarray:
    """How often each of the sorted shingle hashes ``wanted`` occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, keys = Hasher(), shared.value
        counts = np.zeros(len(keys), np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in slices(offsets):
                words = hasher.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], NOT_ALNUM)
                for size in shingle_sizes:
                    found, at = _looked_up(keys, grams(words, size)[0])
                    counts += np.bincount(at[found], minlength=len(keys))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["at", "n"])

    total = np.zeros(len(wanted), np.int64)
    rows = _texts(docs).mapInArrow(process, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    total[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    shared.unpersist()
    return total


def _looked_up(keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are among the sorted ``keys``, and where."""
    if not len(keys):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    # A bit per hash prefix turns nearly all others away before the search.
    bits = np.zeros(1 << 20, bool)
    bits[(keys >> np.uint64(44)).astype(np.int64)] = True
    maybe = np.flatnonzero(bits[(hashes >> np.uint64(44)).astype(np.int64)])
    at = np.zeros(len(hashes), np.int64)
    at[maybe] = np.minimum(np.searchsorted(keys, hashes[maybe]), len(keys) - 1)
    found = np.zeros(len(hashes), bool)
    found[maybe] = keys[at[maybe]] == hashes[maybe]
    return found, at


def _block(rows: list, docs: DataFrame) -> Block:
    """Windows of one block with the rarest shingle of each as its key; ties go to the smaller hash."""
    shingles = [np.frombuffer(r.shingles, np.uint64) for r in rows]
    wanted = np.unique(np.concatenate(shingles))
    counts = shingle_counts(docs, wanted, sorted({min(SHINGLE, r.words) for r in rows}))
    keys, places = [], []
    for s in shingles:
        k = np.lexsort((s, counts[np.searchsorted(wanted, s)]))[0]
        keys.append(s[k])
        places.append(int(k))
    order = np.argsort(np.array(keys, np.uint64), kind="stable")
    return Block(
        np.array([r.words for r in rows]),
        [bytes(r.window) for r in rows],
        [list(r.items) for r in rows],
        np.array(keys, np.uint64)[order],
        order,
        np.array(places)[order],
        np.array([min(SHINGLE, r.words) for r in rows])[order],
    )


def _occurrences(words: Words, block: Block, distinct: np.ndarray) -> list[tuple[int, int, int]]:
    """Verified places of windows as (window, first word, document)."""
    out = []
    doc = words.doc()
    for size in np.unique(block.shingle):
        hashes, at = grams(words, int(size))
        candidates = np.flatnonzero(_looked_up(distinct, hashes)[0])
        low = np.searchsorted(block.keys, hashes[candidates], "left")
        high = np.searchsorted(block.keys, hashes[candidates], "right")
        for c, a, b in zip(candidates.tolist(), low.tolist(), high.tolist(), strict=True):
            here = int(at[c])
            for k in range(a, b):
                w = int(block.owners[k])
                first, n = here - int(block.places[k]), int(block.sizes[w])
                bounds = words.first[doc[here]], words.first[doc[here] + 1]
                if block.shingle[k] != size or first < bounds[0] or first + n > bounds[1]:
                    continue
                text = b" ".join(words.data[words.start[j] : words.end[j]].tobytes() for j in range(first, first + n))
                if text == block.texts[w]:
                    out.append((w, first, int(doc[here])))
    return out


def _with_hits(docs: DataFrame, block: Block) -> DataFrame:
    """Every document with its number of words, the stretches of words hit, and the items of one block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    schema = T.StructType([*docs.schema.fields, *RESULT.fields])

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, block = Hasher(), shared.value
        distinct = np.unique(block.keys)
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
            n_words, n_hit, items, hits = [], [], [], []
            for a, b in slices(offsets):
                words = hasher.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], NOT_ALNUM)
                edges = np.zeros(len(words.hash) + 1, np.int64)
                named: dict[int, set[str]] = {}
                for w, first, doc in _occurrences(words, block, distinct):
                    edges[first] += 1
                    edges[first + block.sizes[w]] -= 1
                    named.setdefault(doc, set()).update(block.items[w])
                hit = np.cumsum(edges)[:-1] > 0
                for k in range(b - a):
                    first, last = words.first[k], words.first[k + 1]
                    n_words.append(int(last - first))
                    n_hit.append(int(hit[first:last].sum()) if k in named else 0)
                    items.append(sorted(named.get(k, ())))
                    hits.append(_stretches(hit[first:last]) if k in named else [])
            added = [
                pa.array(v, t)
                for v, t in (
                    (n_words, pa.int64()),
                    (n_hit, pa.int64()),
                    (items, pa.list_(pa.string())),
                    (hits, pa.list_(pa.list_(pa.int64()))),
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], [*batch.schema.names, *[f.name for f in RESULT]]
            )

    return docs.mapInArrow(process, schema)


def _stretches(hit: np.ndarray) -> list[list[int]]:
    """Runs of words hit, as first word and end."""
    change = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return change.reshape(-1, 2).tolist()


def _blocks(windows: DataFrame, per_block: int) -> Iterator[list]:
    """Windows with their items, in blocks of about ``per_block`` by hash."""
    grouped = stored(
        windows.groupBy("words", "window", "shingles").agg(F.sort_array(F.collect_set("item_id")).alias("items")),
        "windows",
    )
    blocks = 1 + grouped.count() // per_block
    for k in range(blocks):
        rows = grouped.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).collect()
        if rows:
            yield rows


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, windows_per_block: int = WINDOWS_PER_BLOCK
) -> DataFrame:
    """Every document with ``n_words``, ``n_hit``, the ``items`` it has windows of, and ``hits``, stretches of words."""
    names = [f.name for f in RESULT]
    clean = docs.drop(*names)
    out: DataFrame | None = None
    for rows in _blocks(item_windows(items, window), windows_per_block):
        if out is None:
            out = _with_hits(clean, _block(rows, clean))
        else:
            earlier = out.withColumnsRenamed({n: f"_{n}" for n in names})
            out = _merged(_with_hits(earlier, _block(rows, clean)))
    return out if out is not None else _with_hits(clean, _EMPTY)


_EMPTY = Block(np.zeros(0, np.int64), [], [], np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _merged(both: DataFrame) -> DataFrame:
    """Results of two blocks as one."""

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.to_pydict()
            for k in range(batch.num_rows):
                hit = np.zeros(table["n_words"][k], bool)
                for first, last in [*table["hits"][k], *table["_hits"][k]]:
                    hit[first:last] = True
                table["hits"][k] = _stretches(hit)
                table["n_hit"][k] = int(hit.sum())
                table["items"][k] = sorted({*table["items"][k], *table["_items"][k]})
            kept = [n for n in batch.schema.names if n not in ("_n_words", "_n_hit", "_items", "_hits")]
            yield pa.RecordBatch.from_arrays([pa.array(table[n], batch.schema.field(n).type) for n in kept], kept)

    fields = [f for f in both.schema.fields if f.name not in ("_n_words", "_n_hit", "_items", "_hits")]
    return both.mapInArrow(process, T.StructType(fields))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """At least a twentieth of the words hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def decontaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = find_contamination(docs, items)
    return found.where(~contaminated()).select(*docs.columns)
