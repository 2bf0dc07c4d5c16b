"""Vector codes against a plain loop over Python integers, with odd rows and at other sizes."""

import hashlib
import math
import random

import pytest

from ledgerloom.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<double>, label string, code string, error string"


def plain(rows, parts, entries, rounds):
    """Codes, errors and codebooks of ``(id, integers, label)`` rows, one part and one entry at a time."""
    width = len(rows[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0], rows[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def near(p, vec):
        return min((sum((a - b) ** 2 for a, b in zip(vec, entry, strict=True)), k) for k, entry in enumerate(books[p]))

    for _ in range(rounds):
        taken = [[[] for _ in books[p]] for p in range(parts)]
        for row in cut:
            for p, vec in enumerate(row):
                taken[p][near(p, vec)[1]].append(vec)
        books = [
            [[sum(c) // len(t) for c in zip(*t, strict=True)] if t else books[p][k] for k, t in enumerate(taken[p])]
            for p in range(parts)
        ]
    out = []
    for (vec_id, _, label), row in zip(rows, cut, strict=True):
        best = [near(p, vec) for p, vec in enumerate(row)]
        out.append((vec_id, label, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    sums = {}
    for _, label, _, error in out:
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted(map(repr, ((i, code, error, sums[label], digest) for i, label, code, error in out)))


def found(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("spread", [0.01, 1.0, 900.0])
@pytest.mark.parametrize("parts,entries,rounds", [(16, 64, 2), (4, 7, 3)])
def test_equals_the_loop(spark, spread, parts, entries, rounds):
    rng = random.Random(parts + entries)
    rows = [(k * 3, [rng.gauss(0, spread) for _ in range(32)], rng.choice(["a", "b", None])) for k in range(260)]
    rows += [(k, rows[k % 9][1], "a") for k in range(900, 930)]  # repeated vectors
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    whole = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    assert found(vector_codes.compress(df, parts, entries, rounds)) == plain(whole, parts, entries, rounds)


def test_odd_rows(spark):
    rng = random.Random(4)
    good = [(k, [rng.uniform(-2, 2) for _ in range(16)], "l" if k % 3 else None) for k in range(90)]
    good += [(5, list(good[5][1]), None), (5, [1.0] * 16, "l"), (None, [-1.0] * 16, "l")]
    bad = [
        (100, None, "l"),
        (101, [], "l"),
        (102, [None] * 16, "l"),
        (103, [math.nan] + [0.0] * 15, "l"),
        (104, [math.inf] + [0.0] * 15, None),
        (105, [-1e300] + [0.0] * 15, None),
    ]
    other = [(-1, [1.0, 2.0], "l"), (200, [0.5] * 32, None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in good + bad + other], SCHEMA).repartition(3)
    got = vector_codes.compress(df).collect()
    coded = sorted(repr(tuple(r)) for r in got if r.code is not None)
    assert coded == plain([(i, [math.floor(256 * x) for x in v], label) for i, v, label in good], 16, 64, 2)
    assert sorted(r.vec_id for r in got if r.code is None) == [-1, 200]
    assert vector_codes.compress(df.where("false")).collect() == []
    with pytest.raises(ValueError):
        vector_codes.compress(df, entries=257)
    short = vector_codes.compress(df.where("vec_id = -1")).collect()
    assert [(r.vec_id, r.code, r.error) for r in short] == [(-1, None, None)]


def test_dictionaries_of_wide_and_narrow_values():
    import numpy as np

    for values in (np.array([5, -3, 5, 0]), np.array([1 << 40, -7, 1 << 40]), np.array([0])):
        distinct, code = vector_codes.value_dictionary(values)
        assert (distinct[code] == values).all() and (np.diff(distinct) > 0).all()
