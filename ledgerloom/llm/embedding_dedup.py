"""Near-duplicate embeddings from binary codes of randomly rotated vectors.

A unit vector is rotated at random and kept as one bit per dimension, with a
correction factor: the inner product ``f`` of the rotated vector and the corner
of the cube that its bits name.  For another unit vector ``q`` the inner product
of the corner and ``q``, divided by ``f``, is an unbiased estimate of the cosine.
It differs by at most ``t * sqrt(1 - f**2) * sqrt(1 - cos**2) / f``, where ``t``
is at most 1 and, but for a chance that falls with ``exp(-c * bound**2)``, at
most ``bound / sqrt(dimensions - 1)``.  The estimate comes from counts of bits
(``q`` is rounded to four bits, the rounding error is added to the bound); only
pairs that the bound cannot rule out are computed exactly, in double precision.
With up to 65 dimensions the default bound is certain.

Equal vectors of a label are one class.  The classes of a label are dealt into
blocks and every two blocks meet in one task, which gives back numbers of links
and only as many links as connect its rows; pairs are not written out.

Defined results: vectors that are null, empty, zero or have null or non-finite
components, and vectors with a null label, link with nothing and are components
of their own; vectors of different length never link; repeated rows are vectors
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import stored

THRESHOLD = 0.93
BOUND = 8.0
ROWS_PER_BLOCK = 2048
_PLANES = 4
_TILE = 256


def rotation(dimensions: int, seed: int = 5) -> np.ndarray:
    """A random rotation, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    padded = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """Binary codes of unit vectors with their correction factors, and four-bit forms to compare them with."""

    def __init__(self, unit: np.ndarray):
        turned = unit @ rotation(unit.shape[1])
        self.bits = _packed(turned > 0)
        self.factor = np.abs(turned).sum(1) / np.sqrt(unit.shape[1])
        self.ones = np.bitwise_count(self.bits).sum(1).astype(float)
        self.low = turned.min(1)
        self.step = np.maximum((turned.max(1) - self.low) / (2**_PLANES - 1), 1e-300)
        level = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        self.planes = [_packed((level >> k) & 1) for k in range(_PLANES)]
        self.level_sum = level.sum(1).astype(float)
        near = self.low[:, None] + self.step[:, None] * level
        self.rounding = np.sqrt(((turned - near) ** 2).sum(1))
        self._root = np.sqrt(unit.shape[1])

    def products(self, rows: slice, other: Codes) -> np.ndarray:
        """Inner products of these corners and the other's rounded vectors; over the factors, the estimates."""
        bits = self.bits[rows, None, :]
        counts = sum(
            np.bitwise_count(bits & plane[None]).sum(2, dtype=np.int32) * np.int32(1 << k)
            for k, plane in enumerate(other.planes)
        )
        inner = 2 * (other.step * counts + other.low * self.ones[rows, None])
        total = other.step * other.level_sum + other.low * self._root**2
        return (inner - total) / self._root

    def at_least(self, threshold: float, bound: float, dimensions: int) -> np.ndarray:
        """The smallest product that a pair of this cosine can have within the bound."""
        t = min(1.0, bound / np.sqrt(max(dimensions - 1, 1)))
        spread = np.sqrt(np.maximum(1 - self.factor**2, 0)) * np.sqrt(1 - threshold**2)
        return self.factor * threshold - t * spread


def _linked(
    a: np.ndarray, b: np.ndarray, same: bool, threshold: float, bound: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``a`` and ``b`` whose cosine reaches the threshold; of one block each pair once."""
    size_a, size_b = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    codes = Codes(a / size_a[:, None])
    others = codes if same else Codes(b / size_b[:, None])
    need = codes.at_least(threshold, bound, a.shape[1])
    for start in range(0, len(a), _TILE):
        rows = slice(start, min(start + _TILE, len(a)))
        open_ = codes.products(rows, others) + others.rounding[None] + 1e-9 >= need[rows, None]
        if same:
            open_ &= np.arange(len(b))[None] > np.arange(rows.start, rows.stop)[:, None]
        i, j = np.nonzero(open_)
        for at in range(0, len(i), 65536):
            x, y = i[at : at + 65536] + start, j[at : at + 65536]
            cosine = np.einsum("ij,ij->i", a[x], b[y]) / (size_a[x] * size_b[y])
            hit = cosine >= threshold
            yield x[hit], y[hit]


def _spanning(u: np.ndarray, v: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links that connect what all of them connect."""
    up, out = list(range(n)), []

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(u.tolist(), v.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def block_links(group: pd.DataFrame, threshold: float, bound: float) -> pd.DataFrame:
    """Links between the two blocks of a group: per class the rows it links with, and links that connect."""
    blocks = [b for _, b in group.groupby("block", sort=True)]
    first, second = blocks[0], blocks[-1]
    same = len(blocks) == 1
    out = pd.DataFrame({"class": [], "links": [], "other": []}, dtype="Int64")
    if same and group["low"].iloc[0] != group["high"].iloc[0]:
        return out  # the partner block is empty
    a = np.stack(first["vector"].to_list()).astype(float)
    b = a if same else np.stack(second["vector"].to_list()).astype(float)
    ids = np.concatenate([first["class"].to_numpy(), second["class"].to_numpy()])
    copies = np.concatenate([first["copies"].to_numpy(), second["copies"].to_numpy()])
    links, shift = np.zeros(len(ids), np.int64), 0 if same else len(a)
    edges: list[tuple[int, int]] = []
    for x, y in _linked(a, b, same, threshold, bound):
        y = y + shift
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        edges = _spanning(*(np.concatenate([np.array([e[k] for e in edges], np.int64), w]) for k, w in ((0, x), (1, y))), len(ids))
    some = np.flatnonzero(links)
    counted = pd.DataFrame({"class": ids[some], "links": links[some], "other": pd.NA})
    joined = pd.DataFrame({"class": [ids[x] for x, _ in edges], "links": 0, "other": [ids[y] for _, y in edges]})
    return pd.concat([out, counted, joined], ignore_index=True).astype("Int64")


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    bound: float = BOUND,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id`` and ``kept``, from ``vec_id``, ``embedding`` and ``label``."""
    vector = F.col("embedding").cast("array<double>")
    sound = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    ) & F.exists(vector, lambda x: F.coalesce(x != 0, F.lit(False)))
    usable = F.col("label").isNotNull() & F.coalesce(sound, F.lit(False))
    rows = vectors.select(
        "vec_id", "label", F.when(usable, vector).alias("vector")
    ).withColumn("class", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector")))
    classes = stored(
        rows.where("vector is not null")
        .groupBy("label", "vector", "class")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("rep")),
        "vector-classes",
    ).withColumn("size", F.size("vector"))
    blocks = classes.groupBy("label", "size").agg(F.ceil(F.count(F.lit(1)) / rows_per_block).cast("int").alias("blocks"))
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("low"), F.greatest("block", k).alias("high")),
    )
    dealt = (
        classes.join(blocks, ["label", "size"])
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("p", F.explode(pair))
        .select("label", "size", "p.low", "p.high", "block", "class", "copies", "vector")
    )
    found = stored(
        dealt.groupBy("label", "size", "low", "high").applyInPandas(
            lambda g: block_links(g, threshold, bound), "class bigint, links bigint, other bigint"
        ),
        "vector-links",
    )
    linked = found.where("other is null").groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.where("other is not null").select(F.col("class").alias("u"), F.col("other").alias("v")))
    members = (
        classes.select("class", "copies", "rep")
        .join(linked, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    least = members.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = members.join(least, "root").select(
        "class", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    placed = rows.select("vec_id", "class").join(labels, "class", "left")
    return placed.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("bigint").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
