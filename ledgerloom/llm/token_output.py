"""Token ids in Arrow IPC files of equal-length sequences.

All documents' ids, each document's followed by an end id, form one stream in
ascending ``doc_id`` order.  The stream is cut into shards by range, one file a
task; a shard holds fixed-size lists of ``seq_len`` ids with a mask that is false
on the padding of its last sequence.  Batches are equally long, so any sequence
is found by arithmetic, and a memory-mapped file hands it out without copying.
An index table has the place of every document.

Defined results: a null or empty text is the end id alone; rows with the same
``doc_id`` follow each other in the order of their texts' hashes; null ids come
first; an empty table writes no shard and gives an empty index.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import new_folder
from .tokens import default_tokenizer, encoder

SEQ_LEN = 2048
ROWS_PER_BATCH = 128
_INDEX = "doc_id bigint, shard int, at bigint, n_tokens bigint"


def _opened(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


class _ShardWriter:
    """Collects ids and writes full batches."""

    def __init__(self, sink, seq_len: int, dtype: np.dtype):
        ids = pa.list_(pa.from_numpy_dtype(dtype), seq_len)
        self._schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), seq_len))])
        self._writer = pa.ipc.new_file(sink, self._schema)
        self._size, self._dtype = seq_len * ROWS_PER_BATCH, dtype
        self._seq_len, self._waiting, self._count = seq_len, [], 0

    def add(self, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) > np.iinfo(self._dtype).max:
            raise OverflowError(f"id {int(ids.max())} is too large for {self._dtype}")
        self._waiting.append(ids.astype(self._dtype))
        self._count += len(ids)
        if self._count >= self._size:
            flat = np.concatenate(self._waiting)
            whole = len(flat) // self._size * self._size
            for at in range(0, whole, self._size):
                self._write(flat[at : at + self._size], self._size)
            self._waiting, self._count = [flat[whole:]], len(flat) - whole

    def _write(self, flat: np.ndarray, real: int) -> None:
        mask = np.arange(len(flat)) < real
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(v), type=f.type)
            for v, f in zip((flat, mask), self._schema, strict=True)
        ]
        self._writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self._schema))

    def close(self) -> None:
        if self._count:
            flat = np.concatenate(self._waiting)
            self._write(np.pad(flat, (0, -len(flat) % self._seq_len)), len(flat))
        self._writer.close()


def smallest_dtype(tokenizer: str, end_id: int) -> str:
    """The smallest unsigned type that holds all ids."""
    from tokenizers import Tokenizer

    largest = max(end_id, *Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values())
    return str(np.min_scalar_type(max(largest, 256)))


def write_shards(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    end_id: int = 0,
    seq_len: int = SEQ_LEN,
    dtype: str | None = None,
) -> DataFrame:
    """Write the shards below ``folder`` and return the index: ``doc_id``, ``shard``, ``at``, ``n_tokens``.

    ``folder`` must be reachable from all executors.  A shard is written under a
    name of the task attempt and renamed when it is whole, so a repeated task
    leaves the same file.  ``dtype`` is the smallest unsigned one for the tokenizer's largest id if
    none is given; an id that it can't hold fails the job.
    """
    path = tokenizer or default_tokenizer()
    dtype = dtype or smallest_dtype(path, end_id)
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .withColumn("tie", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = task.partitionId()
        fs, root = _opened(folder)
        fs.create_dir(root, recursive=True)
        part, at, writer, encode = f"{root}/.{shard}-{task.taskAttemptId()}", 0, None, encoder(path).encode
        for batch in batches:
            if writer is None and batch.num_rows:
                sink = fs.open_output_stream(part)
                writer = _ShardWriter(sink, seq_len, np.dtype(dtype))
            counts = []
            for ids in encode(batch.column(1)):
                writer.add(np.append(ids, np.uint32(end_id)))
                counts.append(len(ids) + 1)
            n = np.array(counts, np.int64)
            begin = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(n), shard, np.int32)), pa.array(begin), pa.array(n)],
                ["doc_id", "shard", "at", "n_tokens"],
            )
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(part, f"{root}/shard-{shard:06d}.arrow")

    index = ordered.mapInArrow(process, _INDEX)
    index.write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(_INDEX).parquet(f"{folder}/index")


def shard_starts(index: DataFrame) -> DataFrame:
    """Ids in all earlier shards; one row per shard, so as many as there were tasks."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = index.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    return sizes.select("shard", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))


class ShardReader:
    """Random access to the ids of one shard."""

    def __init__(self, folder: str, shard: int):
        fs, root = _opened(folder)
        name = f"{root}/shard-{shard:06d}.arrow"
        local = isinstance(fs, pafs.LocalFileSystem)
        self._file = pa.ipc.open_file(pa.memory_map(name) if local else fs.open_input_file(name))
        self._seq_len = self._file.schema.field("ids").type.list_size
        self._batch = (-1, None, None)

    def _values(self, batch: int) -> tuple[np.ndarray, pa.Array]:
        if self._batch[0] != batch:
            ids, mask = self._file.get_batch(batch).columns
            self._batch = (batch, ids.values.to_numpy(zero_copy_only=True), mask.values)
        return self._batch[1:]

    def ids(self, at: int, count: int) -> np.ndarray:
        """The ``count`` ids from position ``at``; fewer if the mask ends before."""
        size, out = self._seq_len * ROWS_PER_BATCH, []
        while count > 0:
            values, mask = self._values(at // size)
            here = at % size
            take = min(count, len(values) - here)
            real = mask.slice(here, take).to_numpy(zero_copy_only=False)
            out.append(values[here : here + take][real])
            at, count = at + take, count - take
        return np.concatenate(out) if out else np.zeros(0, np.uint16)


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: its place, number of ids and their checksum."""

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[int, ShardReader | None] = (-1, None)
        for batch in batches:
            counts, sums = [], []
            for shard, at, n in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                if opened[0] != shard:
                    opened = (shard, ShardReader(folder, shard))
                ids = opened[1].ids(at, n)
                counts.append(len(ids))
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            columns = [*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "shard", "at", "n_tokens", "ids_crc32"])

    return index.mapInArrow(process, f"{_INDEX}, ids_crc32 bigint")


def token_stream(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write all documents' ids to the shared folder, and describe each document as the files have it."""
    folder = new_folder(docs.sparkSession, "token-shards")
    index = write_shards(docs, folder, tokenizer)
    placed = read_back(index, folder).join(F.broadcast(shard_starts(index)), "shard")
    return placed.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard", "at")
