"""Interpolated modified Kneser-Ney scores of texts, from a model of word pairs or triples counted over the training texts.

Counting and scoring never hold the model in one place.  Tasks count what they
read and send sorted runs of (hash, count) to ranges of hashes; each range is
merged by one task and written to the shared folder as sorted arrays.  Workers
map those files into memory and look up by binary search, sorted requests at a
time.

* words: sorted hashes, and counts.  A word's id is its place.
* pairs: sorted contexts (ids), how many followers each has, and the followers
  (ids) with counts.  Pairs lie in a range by their context; those of words that
  make up a thousandth of the text or more (at most a thousand words) by both,
  so that no range grows with one word.
* triples (``order`` 3): the same with contexts of two ids; contexts of two such
  frequent words lie in ranges by all three.  A merged range of triples gives
  the pairs below it: a pair's count is then the number of different words
  before it, or, at a text's begin, of texts.
* sums of contexts with many followers, and of those that lie in several ranges:
  total, and numbers of followers seen once, twice, more.
* continuations: for each word the number of different words before it.

Counts take half a byte in the files; larger ones are in a short list beside them.

Each text begins after a start mark and ends with an end mark, which counts as a
token.  A word that training never met shares what the discounts leave over with
all words, as one word more.

Defined results: a null or empty text is an end mark alone; rows with a null id
are in training; repeated rows count each time; without training texts all words
are unknown and every token has the chance 1; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import new_folder
from .text import SLICE_BYTES, SPACE, Hasher, Words, mixed, slices, utf8

TOKENS_PER_RUN = 4_000_000
FREQUENT_SHARE = 1000
TOKENS_PER_RANGE = 8_000_000
WIDE = 32
_GROUP = 16
_LARGE = 15
SCORED_BYTES = 4_000_000
_END = np.uint64(0x5E5E5E5E5E5E5E5F)
_NONE = np.uint64(0xFFFFFFFF)
_RUN = "part int, keys binary, counts binary"
_TRIPLE_RUN = "part int, keys binary, words binary, counts binary"
_DONE = "part int, stats array<bigint>"


def held_out(doc_id: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    """Rows kept from training, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers byte by byte place, compressed, which takes the empty high bytes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def _of_planes(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], size, asbytes=True), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64)


def _packed(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences."""
    return _planes(np.diff(values, prepend=np.uint64(0)))


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_of_planes(data), dtype=np.uint64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _runs(parts: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Sorted keys by part, each part one row."""
    order = np.argsort(parts, kind="stable")
    parts, keys, counts = parts[order], keys[order], counts[order].astype(np.int64)
    bounds = np.append(np.flatnonzero(np.append(True, parts[1:] != parts[:-1])), len(parts)) if len(parts) else []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield int(parts[a]), _packed(keys[a:b]), _planes(counts[a:b])


def _batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.binary())
    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["part", "keys", "counts"])


def _merged(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The runs of one part as one."""
    keys = np.concatenate([_unpacked(k) for k in group["keys"]])
    counts = np.concatenate([_of_planes(c) for c in group["counts"]]).astype(np.int64)
    return _summed(keys, counts)


def _write(folder: str, name: str, values: np.ndarray) -> None:
    """An array to the shared folder; a repeated task writes the same file again."""
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    part = f"{root}/.{name}-{np.random.SeedSequence().entropy:x}"
    with fs.open_output_stream(part) as sink:
        sink.write(np.ascontiguousarray(values).tobytes())
    fs.move(part, f"{root}/{name}")


def _read(folder: str, name: str, dtype) -> np.ndarray:
    """A mapped array; folders that are not in a file system of the machine are read instead."""
    fs, root = pafs.FileSystem.from_uri(folder)
    path = f"{root}/{name}"
    if not fs.get_file_info(path).size:  # absent or empty
        return np.zeros(0, dtype)
    source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
    return np.frombuffer(source.read_buffer(), dtype)


def _write_counts(folder: str, name: str, part: int, counts: np.ndarray) -> None:
    """Counts as half bytes, and a list of (place, count) for those that are too large for that."""
    large = np.flatnonzero(counts >= _LARGE)
    short = np.minimum(np.append(counts, np.zeros(len(counts) % 2, np.int64)), _LARGE).astype(np.uint8)
    _write(folder, f"{name}-{part}", short[::2] | (short[1::2] << 4))
    _write(folder, f"{name}-{part}-large", np.stack([large, counts[large]]).astype(np.int64))


def _starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def _seen(counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the counts of each run, and how many of them are one, two, more."""
    if not len(first):
        return np.zeros((0, 4), np.int64)
    return np.stack([np.add.reduceat(v, first) for v in (counts, counts == 1, counts == 2, counts >= 3)], axis=1).astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int, Words]]]]:
    hasher = Hasher()
    for batch in batches:
        data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        yield batch, (
            (a, b, hasher.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACE)) for a, b in slices(offsets, limit)
        )


def _with_ends(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end mark after each text's words, and where each text begins."""
    first = words.first + np.arange(len(words.first))
    tokens = np.full(first[-1], _END, np.uint64)
    tokens[np.arange(len(words.hash)) + words.doc()] = words.hash
    return tokens, first


@dataclass
class Vocabulary:
    """Words by ranges of their hashes' leading bits."""

    folder: str
    bits: int
    bases: np.ndarray
    total: int
    frequent: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    range_bits: int = 1

    @property
    def size(self) -> int:
        return int(self.bases[-1])

    def open(self) -> Vocabulary:
        self._files: dict[tuple[str, int], np.ndarray] = {}
        return self

    def file(self, name: str, part: int | str, dtype) -> np.ndarray:
        if (name, part) not in self._files:
            self._files[name, part] = _read(self.folder, f"{name}-{part}", dtype)
        return self._files[name, part]

    def counts(self, name: str, part: int, places: np.ndarray) -> np.ndarray:
        """Counts at places of a range."""
        counts = ((self.file(name, part, np.uint8)[places >> 1] >> ((places & 1) << 2).astype(np.uint8)) & 15).astype(np.int64)
        big = np.flatnonzero(counts == _LARGE)
        if len(big):
            at, value = self.file(name, f"{part}-large", np.int64).reshape(2, -1)
            counts[big] = value[np.searchsorted(at, places[big])]
        return counts

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes; ``_NONE`` for unknown ones."""
        out = np.full(len(hashes), _NONE, np.uint64)
        for part, a, b in _stretches(hashes >> np.uint64(64 - self.bits)):
            held = self.file("words", part, np.uint64)
            if len(held):
                at = np.minimum(np.searchsorted(held, hashes[a:b]), len(held) - 1)
                out[a:b] = np.where(held[at] == hashes[a:b], at + int(self.bases[part]), int(_NONE))
        return out

    def values(self, name: str, ids: np.ndarray) -> np.ndarray:
        """What a file of one number per word has for sorted known ids."""
        out = np.zeros(len(ids), np.int64)
        for part, a, b in _stretches(np.searchsorted(self.bases, ids.astype(np.int64), "right") - 1):
            out[a:b] = self.counts(name, part, ids[a:b].astype(np.int64) - int(self.bases[part]))
        return out


def _by_part(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each range; few ranges sort faster as short numbers."""
    order = np.argsort(parts.astype(np.uint16) if len(parts) and parts.max() < 1 << 16 else parts, kind="stable")
    for part, a, b in _stretches(parts[order]):
        yield part, order[a:b]


def _stretches(parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of equal numbers: number, first place, end."""
    if len(parts):
        cut = np.flatnonzero(parts[1:] != parts[:-1]) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(parts)], strict=True):
            yield int(parts[a]), a, b


def _count_words(training: DataFrame, folder: str, bits: int) -> Vocabulary:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0

        def run() -> pa.RecordBatch:
            k, c = _summed(np.concatenate(keys), np.concatenate(counts))
            return _batch(list(_runs(k >> np.uint64(64 - bits), k, c)))

        for _, texts in _texts(batches, "text"):
            for _, _, words in texts:
                k, c = np.unique(_with_ends(words)[0], return_counts=True)
                keys.append(k)
                counts.append(c)
                size += len(k)
                if size > TOKENS_PER_RUN:
                    yield run()
                    keys, counts, size = [], [], 0
        if keys:
            yield run()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        keys, counts = _merged(group)
        _write(folder, f"words-{part}", keys)
        _write_counts(folder, "counts", part, counts)
        return pd.DataFrame({"part": [part], "stats": [[len(keys), int(counts.sum())]]})

    runs = training.mapInArrow(count, _RUN)
    done = runs.groupBy("part").applyInPandas(merge, _DONE).select("part", "stats").collect()
    sizes = np.zeros(1 << bits, np.int64)
    for row in done:
        sizes[row.part] = row.stats[0]
    return Vocabulary(folder, bits, np.append(0, np.cumsum(sizes)), sum(r.stats[1] for r in done))


def _frequent(vocabulary: Vocabulary, spark) -> np.ndarray:
    """Ids of words that are a thousandth of all tokens or more, and the start mark."""
    least = vocabulary.total // FREQUENT_SHARE

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                size = int(vocabulary.bases[part + 1] - vocabulary.bases[part])
                counts = vocabulary.open().counts("counts", part, np.arange(size))
                found = np.flatnonzero(counts > least) + int(vocabulary.bases[part])
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["id"])

    parts = spark.range(0, len(vocabulary.bases) - 1, 1, min(32, len(vocabulary.bases) - 1))
    rows = parts.mapInArrow(find, "id bigint").collect()
    return np.sort(np.array([r.id for r in rows] + [vocabulary.size], np.uint64))


def _pairs(words: Words, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token ids, ids of the tokens before them, where texts begin, and the distinct known ids with their places."""
    tokens, first = _with_ends(words)
    distinct, inverse = np.unique(tokens, return_inverse=True)
    known = vocabulary.ids(distinct)
    ids = known[inverse]
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[first[:-1]] = np.uint64(vocabulary.size)
    return ids, before, first, known, inverse


def _is_frequent(ids: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    return vocabulary.frequent[np.minimum(np.searchsorted(vocabulary.frequent, ids), len(vocabulary.frequent) - 1)] == ids


def _second_context(before: np.ndarray, first: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The two tokens before each as one number; the first token of a text has none and gets a number no triple has."""
    earlier = np.empty_like(before)
    earlier[1:] = before[:-1]
    earlier[first[:-1]] = np.uint64(vocabulary.size + 1)
    return (earlier << np.uint64(32)) | before


def _common(name: str, contexts: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Contexts of frequent words only, whose followers are dealt out over all ranges."""
    if name == "pair":
        return _is_frequent(contexts, vocabulary)
    found = np.flatnonzero(_is_frequent(contexts & np.uint64(0xFFFFFFFF), vocabulary))
    head = contexts[found] >> np.uint64(32)
    out = np.zeros(len(contexts), bool)
    out[found[_is_frequent(head, vocabulary) | (head == np.uint64(vocabulary.size + 1))]] = True
    return out


def _ranges(common: np.ndarray, contexts: np.ndarray, words: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The range that each context with its follower lies in."""
    return mixed(np.where(common, mixed(contexts) + words, contexts)) >> np.uint64(64 - vocabulary.range_bits)


@dataclass
class Model:
    """What scoring needs besides the files: discounts and totals."""

    order: int
    triple_discount: np.ndarray
    vocabulary: Vocabulary
    pair_discount: np.ndarray
    word_discount: np.ndarray
    continuations: int
    left_over: float


def _discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 0 to 3 and more, from how many things were counted once to four times."""
    out = np.zeros(4)
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    for k in (1, 2, 3):
        out[k] = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5
    return np.clip(out, 0, [0, 1, 2, 3])


def _pair_rows(keys: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> list[tuple[int, bytes, bytes]]:
    """Sorted pairs as runs by range."""
    contexts, words = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
    return list(_runs(_ranges(_common("pair", contexts, vocabulary), contexts, words, vocabulary), keys, counts))


def _pair_runs(training: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Pairs with counts as sorted runs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = vocabulary.open()
        keys, size = [], 0

        def run() -> pa.RecordBatch:
            return _batch(_pair_rows(*np.unique(np.concatenate(keys), return_counts=True), opened))

        for _, texts in _texts(batches, "text"):
            for _, _, words in texts:
                ids, before, *_ = _pairs(words, opened)
                keys.append((before << np.uint64(32)) | ids)
                size += len(ids)
                if size > TOKENS_PER_RUN:
                    yield run()
                    keys, size = [], 0
        if keys:
            yield run()

    return training.mapInArrow(count, _RUN)


def _write_table(name: str, part: int, contexts: np.ndarray, words: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> None:
    """One merged range of sorted pairs or triples as files."""
    folder = vocabulary.folder
    first = _starts(contexts)
    owners, seen = contexts[first], _seen(counts, first)
    sizes = np.diff(np.append(first, len(contexts)))
    common = _common(name, owners, vocabulary)
    wide = ~common & (sizes > WIDE)
    _write(folder, f"{name}contexts-{part}", owners)
    _write(folder, f"{name}first-{part}", first[::_GROUP].astype(np.int64))
    _write_counts(folder, f"{name}sizes", part, np.append(sizes, np.zeros(-len(sizes) % _GROUP, np.int64)))
    _write(folder, f"{name}words-{part}", words.astype(np.uint32))
    _write_counts(folder, f"{name}counts", part, counts)
    for kind, rows in (("wide", wide), ("parts", common)):
        _write(folder, f"{name}{kind}-{part}", np.column_stack([owners[rows].astype(np.int64), seen[rows]]))
    _write(folder, f"{name}stats-{part}", np.array([(counts == k).sum() for k in (1, 2, 3, 4)], np.int64))


def _summed_triples(contexts: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted triples with the sums of their counts."""
    order = np.lexsort((words, contexts))
    contexts, words, counts = contexts[order], words[order], counts[order]
    fresh = np.append(True, (contexts[1:] != contexts[:-1]) | (words[1:] != words[:-1])) if len(words) else np.zeros(0, bool)
    first = np.flatnonzero(fresh)
    return contexts[first], words[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_triples(training: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Write triples where the frame is computed; runs of the pairs they give."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = vocabulary.open()
        held, size = [], 0

        def run() -> pa.RecordBatch:
            contexts, words = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            contexts, words, counts = _summed_triples(contexts, words, np.ones(len(words), np.int64))
            parts = _ranges(_common("triple", contexts, opened), contexts, words, opened)
            order = np.argsort(parts, kind="stable")
            rows = []
            for part, a, b in _stretches(parts[order]):
                at = order[a:b]
                rows.append((part, _packed(contexts[at]), _planes(words[at]), _planes(counts[at])))
            kinds = [("part", pa.int32()), ("keys", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], [n for n, _ in kinds]
            )

        for _, texts in _texts(batches, "text"):
            for _, _, words in texts:
                ids, before, first, *_ = _pairs(words, opened)
                held.append((_second_context(before, first, opened), ids))
                size += len(ids)
                if size > TOKENS_PER_RUN:
                    yield run()
                    held, size = [], 0
        if held:
            yield run()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        contexts = np.concatenate([_unpacked(k) for k in group["keys"]])
        words = np.concatenate([_of_planes(w) for w in group["words"]])
        counts = np.concatenate([_of_planes(c) for c in group["counts"]]).astype(np.int64)
        contexts, words, counts = _summed_triples(contexts, words, counts)
        whole = contexts >> np.uint64(32) != np.uint64(vocabulary.size + 1)
        # A pair counts once for each word before it, and at a text's begin once for each text.
        pairs, times = _summed((contexts << np.uint64(32)) | words, np.where(whole, 1, counts))
        _write_table("triple", part, contexts[whole], words[whole], counts[whole], vocabulary)
        return pd.DataFrame(_pair_rows(pairs, times, vocabulary), columns=["part", "keys", "counts"])

    return training.mapInArrow(count, _TRIPLE_RUN).groupBy("part").applyInPandas(merge, _RUN)


def _finish(name: str, spark, vocabulary: Vocabulary) -> list[int]:
    """Add up the contexts that lie in several ranges, into files by context; how many counts are one to four."""
    folder, parts = vocabulary.folder, 1 << vocabulary.range_bits
    ranges = spark.range(0, parts, 1, min(32, parts))
    names = [f"c{k}" for k in range(4)]

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_read(folder, f"{name}stats-{part}", np.int64) for part in batch.column(0).to_pylist()]
            sums = np.sum([f for f in found if len(f)] + [np.zeros(4, np.int64)], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in sums], names)

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                rows = _read(folder, f"{name}parts-{part}", np.int64).reshape(-1, 5)
                at = (mixed(rows[:, 0].astype(np.uint64)) >> np.uint64(64 - vocabulary.range_bits)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(rows[:, k]) for k in range(5)]], ["part", "context", *names])

    def write(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        rows = group[["context", *names]].to_numpy(np.int64)
        _write(folder, f"{name}common-{part}", rows[np.argsort(rows[:, 0].astype(np.uint64))])
        return pd.DataFrame({"part": [part]})

    kinds = ", ".join(f"{n} bigint" for n in names)
    summed = ranges.mapInArrow(common, f"part int, context bigint, {kinds}").groupBy("part", "context")
    summed.agg(*[F.sum(n).alias(n) for n in names]).groupBy("part").applyInPandas(write, "part int").count()
    row = ranges.mapInArrow(stats, kinds).agg(*[F.sum(n) for n in names]).first()
    return [v or 0 for v in row]


def _count_pairs(runs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Write pairs where the frame is computed; runs of continuations."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        keys, counts = _merged(group)
        words = keys & np.uint64(0xFFFFFFFF)
        _write_table("pair", part, keys >> np.uint64(32), words, counts, vocabulary)
        follower, times = np.unique(words, return_counts=True)
        at = np.searchsorted(vocabulary.bases, follower.astype(np.int64), "right") - 1
        return pd.DataFrame(list(_runs(at, follower, times)), columns=["part", "keys", "counts"])

    return runs.groupBy("part").applyInPandas(merge, _RUN)


def _count_continuations(runs: DataFrame, vocabulary: Vocabulary) -> tuple[list[int], int, int]:
    """Write the words' numbers of predecessors; counts of counts, their sum, and the number of words with three or more."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        keys, counts = _merged(group)
        base, end = int(vocabulary.bases[part]), int(vocabulary.bases[part + 1])
        dense = np.zeros(end - base, np.int64)
        dense[keys.astype(np.int64) - base] = counts
        _write_counts(vocabulary.folder, "before", part, dense)
        stats = [*[int((counts == k).sum()) for k in (1, 2, 3, 4)], int(counts.sum()), int((counts >= 3).sum())]
        return pd.DataFrame({"part": [part], "stats": [stats]})

    done = runs.groupBy("part").applyInPandas(merge, _DONE).select("stats").collect()
    sums = np.array([r.stats for r in done], np.int64).reshape(-1, 6).sum(0).tolist()
    return sums[:4], sums[4], sums[5]


def train(training: DataFrame, parts: int | None = None, order: int = 3) -> Model:
    """Count the ``text`` of all rows, in triples or, with ``order`` 2, in pairs of words.

    ``parts`` is the number of ranges of words, that of shuffle partitions if not
    given; pairs and triples get more where a range would have too many tokens.
    """
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    spark = training.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (parts - 1).bit_length())
    texts = training.select(F.col("text").cast("string").alias("text"))
    vocabulary = _count_words(texts, new_folder(spark, "kneser-ney"), bits)
    if vocabulary.size + 1 >= int(_NONE):
        raise ValueError("more words than ids")
    vocabulary.range_bits = max(bits, (vocabulary.total // TOKENS_PER_RANGE).bit_length())
    vocabulary.frequent = _frequent(vocabulary, spark)
    runs = _count_triples(texts, vocabulary) if order == 3 else _pair_runs(texts, vocabulary)
    before, total, many = _count_continuations(_count_pairs(runs, vocabulary), vocabulary)
    pairs = _finish("pair", spark, vocabulary)
    triples = _finish("triple", spark, vocabulary) if order == 3 else [0] * 4
    discount = _discounts(before)
    left = (discount[1:] * [before[0], before[1], many]).sum() / total if total else 1.0
    return Model(order, _discounts(triples), vocabulary, _discounts(pairs), discount, total, float(left))


class Scorer:
    """Looks tokens up in the files of a model."""

    def __init__(self, model: Model):
        self._model, self._vocabulary = model, model.vocabulary.open()

    def _slices(self, name: str, part: int, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the followers of contexts begin and end in a range; 0 twice for those it has not."""
        vocabulary = self._vocabulary
        begin, end = np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.int64)
        held = vocabulary.file(f"{name}contexts", part, np.uint64)
        if len(held):
            at = np.minimum(np.searchsorted(held, contexts), len(held) - 1)
            hit = np.flatnonzero(held[at] == contexts)
            group, inside = at[hit] // _GROUP, at[hit] % _GROUP
            halves = vocabulary.file(f"{name}sizes", part, np.uint8).reshape(-1, _GROUP // 2)[group]
            sizes = np.stack([halves & 15, halves >> 4], axis=2).reshape(-1, _GROUP)
            sizes[np.arange(_GROUP) > inside[:, None]] = 0
            ends = vocabulary.file(f"{name}first", part, np.int64)[group] + sizes.sum(1, dtype=np.int64)
            own = sizes[np.arange(len(hit)), inside].astype(np.int64)
            row, column = np.nonzero(sizes == _LARGE)
            if len(row):
                more = vocabulary.counts(f"{name}sizes", part, group[row] * _GROUP + column) - _LARGE
                np.add.at(ends, row, more)
                last = column == inside[row]
                own[row[last]] += more[last]
            begin[hit], end[hit] = ends - own, ends
        return begin, end

    def _found(self, name: str, part: int, words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Counts of words among the followers from ``begin`` to ``end`` of a range."""
        held = self._vocabulary.file(f"{name}words", part, np.uint32)
        low, top, open_ = begin.copy(), end.copy(), np.flatnonzero(begin < end)
        while len(open_):
            a, b = low[open_], top[open_]
            middle = (a + b) // 2
            lower = held[middle] < words[open_]
            low[open_], top[open_] = np.where(lower, middle + 1, a), np.where(lower, b, middle)
            open_ = open_[low[open_] < top[open_]]
        out = np.zeros(len(words), np.int64)
        there = np.flatnonzero(low < end)
        there = there[held[low[there]] == words[there]] if len(there) else there
        if len(there):
            out[there] = self._vocabulary.counts(f"{name}counts", part, low[there])
        return out

    def _listed(self, name: str, part: int, contexts: np.ndarray) -> np.ndarray:
        """Sums of contexts from the lists of those that have them written down."""
        table = self._vocabulary.file(name, part, np.int64).reshape(-1, 5)
        out = np.zeros((len(contexts), 4), np.int64)
        if len(table) and len(contexts):
            keys = table[:, 0].astype(np.uint64)
            at = np.minimum(np.searchsorted(keys, contexts), len(keys) - 1)
            hit = keys[at] == contexts
            out[hit] = table[at[hit], 1:]
        return out

    def _sums(self, name: str, part: int, contexts: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Total, and followers seen once, twice and more, of contexts that lie in one range."""
        size = end - begin
        out = np.zeros((len(contexts), 4), np.int64)
        few, wide = np.flatnonzero((size > 0) & (size <= WIDE)), np.flatnonzero(size > WIDE)
        if len(few):
            first = np.cumsum(size[few]) - size[few]
            places = np.arange(size[few].sum()) + np.repeat(begin[few] - first, size[few])
            out[few] = _seen(self._vocabulary.counts(f"{name}counts", part, places), first)
        out[wide] = self._listed(f"{name}wide", part, contexts[wide])
        return out

    def _chances(self, name: str, before: np.ndarray, ids: np.ndarray, discount: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Chances of tokens behind contexts, from those behind shorter ones."""
        contexts, at = np.unique(before, return_inverse=True)
        common = _common(name, contexts, self._vocabulary)
        parts = mixed(contexts) >> np.uint64(64 - self._vocabulary.range_bits)
        sums = np.zeros((len(contexts), 4), np.int64)
        begin, end = np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.int64)
        single, several = np.flatnonzero(~common), np.flatnonzero(common)
        for part, rows in _by_part(parts[single]):
            rows = single[rows]
            begin[rows], end[rows] = self._slices(name, part, contexts[rows])
            sums[rows] = self._sums(name, part, contexts[rows], begin[rows], end[rows])
        for part, rows in _by_part(parts[several]):
            sums[several[rows]] = self._listed(f"{name}common", part, contexts[several[rows]])
        known = sums[at, 0] > 0
        seen = np.zeros(len(ids), np.int64)
        tokens = np.flatnonzero(known & ~common[at])
        for part, rows in _by_part(parts[at[tokens]]):
            rows = tokens[rows]
            seen[rows] = self._found(name, part, ids[rows], begin[at[rows]], end[at[rows]])
        tokens = np.flatnonzero(known & common[at])
        dealt = _ranges(common[at[tokens]], before[tokens], ids[tokens], self._vocabulary)
        for part, rows in _by_part(dealt):
            rows = tokens[rows]
            seen[rows] = self._found(name, part, ids[rows], *self._slices(name, part, before[rows]))
        total = np.maximum(sums[:, 0], 1)
        passed = np.where(sums[:, 0] > 0, sums[:, 1:] @ discount[1:] / total, 1.0)
        return np.maximum(seen - discount[np.minimum(seen, 3)], 0) / total[at] + passed[at] * lower

    def score(self, words: Words) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, score of the add-one unigram model and of this one."""
        model, vocabulary = self._model, self._vocabulary
        ids, before, first, known, inverse = _pairs(words, vocabulary)
        real = known != _NONE
        counts = np.zeros(len(known), np.int64)
        preceded = np.zeros(len(known), np.int64)
        order = np.argsort(known[real])
        at = np.flatnonzero(real)[order]
        counts[at] = vocabulary.values("counts", known[at])
        preceded[at] = vocabulary.values("before", known[at])
        base = np.log10((counts + 1) / (vocabulary.total + vocabulary.size + 1))
        share = np.maximum(preceded - model.word_discount[np.minimum(preceded, 3)], 0) / max(model.continuations, 1)
        alone = share + model.left_over / (vocabulary.size + 1)
        chance = self._chances("pair", before, ids, model.pair_discount, alone[inverse])
        if model.order == 3:
            chance = self._chances("triple", _second_context(before, first, vocabulary), ids, model.triple_discount, chance)
        sums = lambda v: np.add.reduceat(v, first[:-1]) if len(first) > 1 else np.zeros(0)
        return {
            "n_tokens": np.diff(first),
            "n_known": sums((counts[inverse] > 0).astype(np.int64)),
            "base_score": sums(base[inverse]),
            "score": sums(np.log10(chance)),
        }


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10 of the text's chance)."""
    kinds = {"n_tokens": "bigint", "n_known": "bigint", "base_score": "double", "score": "double"}
    docs = docs.drop(*kinds, "train_tokens")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema = ", ".join([fields, *[f"{n} {t}" for n, t in kinds.items()]])

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch, texts in _texts(batches, "text", SCORED_BYTES):
            found = [scorer.score(words) for _, _, words in texts]
            columns = [
                pa.array(np.concatenate([*[f[n] for f in found], np.zeros(0, np.int64 if t == "bigint" else float)]))
                for n, t in kinds.items()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *kinds])

    return docs.mapInArrow(process, schema).withColumn("train_tokens", F.lit(model.vocabulary.total).cast("bigint"))


def perplexity() -> Column:
    """Per-token perplexity of scored rows."""
    return F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
