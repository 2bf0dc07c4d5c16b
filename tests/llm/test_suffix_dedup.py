"""Repeated strings against a plain table of all strings, suffix order against plain sorting, and odd texts."""

import collections
import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import suffix_dedup as sd
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, key string, start string, found string, n string"


def plain(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(a and not b for a, b in zip(gone, b"\0" + gone, strict=False))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def found(spark, rows, *args):
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(4)
    return sorted(repr(tuple(r)) for r in sd.without_repeated_strings(df, *args).collect())


def woven(rng, number, length):
    """Texts of random words with passages of about ``length`` bytes taken from one another."""
    words = ["w%d" % k for k in range(40)] + ["é", "ж", "雪"]
    texts = []
    for _ in range(number):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 200)))
        for _ in range(rng.randrange(0, 4)):
            other = rng.choice(texts) if texts else text
            at = rng.randrange(0, max(1, len(other)))
            passage = other[at : at + rng.randrange(length - 8, length * 2)]
            cut = rng.randrange(0, len(text) + 1)
            text = text[:cut] + passage + text[cut:]
        texts.append(text)
    return texts


@pytest.mark.parametrize("length,gram,group", [(200, 24, 4096), (60, 8, 4096), (60, 8, 3), (9, 1, 2)])
def test_equals_the_table_of_strings(spark, length, gram, group):
    rng = random.Random(length + group)
    rows = list(enumerate(woven(rng, 120, length)))
    assert found(spark, rows, length, gram, group) == plain(rows, length)


def test_query_equals_the_table_of_strings(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = QUERIES["op13_suffix_dedup"](spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain(rows, 200)


def test_odd_texts(spark):
    rng = random.Random(5)
    once = "".join(chr(rng.randrange(0x100, 0x2000)) for _ in range(400))
    rows = [(1, None), (2, ""), (2, ""), (3, "x" * 199), (4, "x" * 199), (5, once), (None, None)]
    rows += [(6, "ab" * 900), (7, "y" * 201), (8, "z" * 200), (9, "q" * 700), (10, "p" * 199 + once[-60:])]
    rows += [(11, once + "!"), (11, once + "!"), (None, "k" * 150 + once[:120])]
    assert found(spark, rows) == plain(rows, 200)
    none = spark.createDataFrame([], SCHEMA)
    assert sd.without_repeated_strings(none).collect() == []


def test_very_long_texts(spark, monkeypatch):
    rng = random.Random(6)
    long = "".join(rng.choice("abcd ") for _ in range(40_000))
    rows = [(1, long), (2, long[700:9000] + "~" + long[20_000:20_300]), (3, long[::-1]), (4, long[39_000:] + "x")]

    monkeypatch.setattr(sd, "_SEGMENT", 1 << 10)
    assert found(spark, rows) == plain(rows, 200)
    cut = list(sd._segments(pa.array([long.encode(), b"tiny"], pa.binary()), 200))
    assert [c[3] for c in cut[:3]] == [0, 1024, 2048] and cut[-1][0] == 1
    starts = [k for _, data, _, at in cut[:-1] for k in range(at, at + len(data) - 199)]
    assert starts == list(range(len(long) - 199))


def test_suffixes_are_sorted():
    rng = np.random.default_rng(3)
    for size, letters, length in ((400, 2, 12), (3000, 3, 40), (300, 1, 7)):
        data = rng.integers(97, 97 + letters, size).astype(np.uint8)
        at = np.arange(size - length + 1)
        bucket = np.sort(rng.integers(0, 5, len(at)))
        order = sd.sorted_suffixes(data, sd.PrefixHashes(data, 1), at, bucket, length)
        whole = data.tobytes()
        want = sorted(range(len(at)), key=lambda k: (bucket[k], whole[at[k] : at[k] + length]))
        assert [whole[at[k] : at[k] + length] for k in order] == [whole[at[k] : at[k] + length] for k in want]
        assert sorted(order) == list(range(len(at)))


def test_wrong_hashes_are_noticed(monkeypatch):
    class Bad(sd.PrefixHashes):
        """With the first values every range has the same hash."""

        def __init__(self, data, seed=0):
            super().__init__(data, seed)
            self.bad = seed < 3

        def of(self, start, length):
            own = super().of(start, length)
            return own * np.uint64(0) if self.bad else own

    monkeypatch.setattr(sd, "PrefixHashes", Bad)
    data = np.frombuffer(b"abcdefabcxyzabcdef", np.uint8)
    at = np.arange(len(data) - 3)
    got = sd.repeated_suffixes(data, at, np.zeros(len(at), int), 4)
    whole = data.tobytes()
    seen = collections.Counter(whole[k : k + 4] for k in at)
    assert list(got) == [seen[whole[k : k + 4]] > 1 for k in at]


def test_first_bytes_tell_suffixes_apart_without_hashes():
    class Unused(sd.PrefixHashes):
        def of(self, start, length):
            assert not len(start), "hashes are for suffixes with the same first bytes"
            return super().of(start, length)

    rng = np.random.default_rng(5)
    data = np.append(rng.permutation(256), np.zeros(20)).astype(np.uint8)
    at = rng.permutation(250)
    order = sd.sorted_suffixes(data, Unused(data, 1), at, np.zeros(len(at), int), 12)
    assert data[at[order]].tolist() == sorted(data[at].tolist())


@pytest.mark.parametrize("length", [5, 8, 16, 19])
def test_every_wrong_extension_is_noticed(length):
    rng = np.random.default_rng(length)
    data = rng.integers(97, 99, 300).astype(np.uint8)
    for a, b in rng.integers(0, 300 - length, (200, 2)):
        x, y = data[a : a + length].tobytes(), data[b : b + length].tobytes()
        right = next((k for k in range(length) if x[k] != y[k]), length)
        for n in range(length + 1):
            known = sd._verified(data, np.array([a]), np.array([b]), np.array([n]), length)
            assert known == (n == right and x <= y)


def test_a_task_has_one_python_worker(spark):
    rows = spark.createDataFrame([(1, "a" * 300, "a", "b", "c", "d")], SCHEMA)
    plan = sd.without_repeated_strings(rows)._jdf.queryExecution().executedPlan().toString()
    above, steps = [], 0
    for line in plan.splitlines():
        name = line.lstrip(" :+-*()0123456789")
        depth = len(line) - len(name)
        above = [(d, n) for d, n in above if d < depth]
        if name.startswith("MapInArrow"):
            steps += 1
            stage = [n for _, n in above]
            cut = max((k + 1 for k, n in enumerate(stage) if n.startswith("Exchange")), default=0)
            assert not [n for n in stage[cut:] if n.startswith("MapInArrow")]
        above.append((depth, name))
    assert steps >= 4


def test_lists_of_places_come_a_part_at_a_time():
    places = pa.array([[]] * 1300, pa.list_(pa.int64()))
    batches = [pa.RecordBatch.from_arrays([places], ["found"]), pa.RecordBatch.from_arrays([places[:0]], ["found"])]
    assert [b.num_rows for b in sd._parts(batches)] == [512, 512, 276, 0]
