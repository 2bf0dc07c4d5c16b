"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of its own form (letters, marks, repeats, lengths) and
those of the lines before and after it.  The field labels lines good or bad; its
forward-backward marginals, weighted by the lines' lengths, describe the
document, and a logistic function of them is the document's score.

Only documents have labels.  All lines of a good document are good; which lines
of a bad one are bad is found by turns of fitting and relabelling.  Training
takes a bounded sample of the labelled documents (``MAX_TRAINING``), scoring all.

Defined results: a null or empty text has no lines and gets the score of that;
blank lines do not count; repeated rows are scored each; documents with several
labels count once with the smaller one; with no labels of both kinds every score
is the share of good ones (a half if there are none); input columns with the name
of a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import LOWER, SAME, SPACE, Hasher, slices, utf8

MAX_TRAINING = 4000
GOOD_FROM = 0.7
_NEWLINE = np.arange(256) == 10
_BYTES = np.arange(256)
_CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "lower": (_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 0xC3),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "shout": _BYTES == ord("!"),
    "bar": _BYTES == ord("|"),
    "sign": np.isin(_BYTES, [ord(c) for c in "#$%&*@~^<>{}[]=+_\\/"]),
    "stop": np.isin(_BYTES, [ord(c) for c in ".,;:?"]),
    "inner": (_BYTES & 0xC0) == 0x80,
}
FEATURES = 14


def _line_features(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature rows of all lines with a word, their lengths, and each text's first line."""
    lines = hasher.words(data, offsets, _NEWLINE, SAME)
    words = hasher.words(data, offsets, SPACE, LOWER)
    line = np.searchsorted(lines.start, words.start, "right") - 1
    n = len(lines.start)
    count = np.bincount(line, minlength=n).astype(float)
    share = {}
    for name, members in _CLASSES.items():
        sums = np.append(0, np.cumsum(members[data], dtype=np.int64))
        share[name] = (sums[lines.end] - sums[lines.start]).astype(float)
    chars = np.maximum(lines.end - lines.start - share["inner"], 1)
    letters = np.maximum(share["upper"] + share["lower"], 1)
    same = np.zeros(n)
    if len(words.hash) > 1:
        twice = (words.hash[1:] == words.hash[:-1]) & (line[1:] == line[:-1])
        same = np.bincount(line[1:][twice], minlength=n).astype(float)
    distinct = np.zeros(n)
    if len(words.hash):
        _, sample = np.unique(words.hash ^ (line.astype(np.uint64) << np.uint64(40)), return_index=True)
        distinct = np.bincount(line[sample], minlength=n).astype(float)
    doc = lines.doc()
    again = np.zeros(n)
    if n:
        _, inverse, times = np.unique(lines.hash ^ (doc.astype(np.uint64) << np.uint64(40)), return_inverse=True, return_counts=True)
        again = (times[inverse] > 1).astype(float)
    many = np.maximum(count, 1)
    ends = np.isin(data[np.minimum(lines.end, max(len(data), 1)) - 1], [ord(c) for c in ".!?"]) if n else np.zeros(0)
    rows = np.stack(
        [
            share["upper"] / letters,
            share["shout"] / many,
            share["bar"] / many,
            share["sign"] / chars * 5,
            share["digit"] / chars,
            share["stop"] / many,
            same / many,
            1 - distinct / many,
            again,
            np.log1p(count) / 4,
            (count <= 2).astype(float),
            letters / many / 8,
            ends.astype(float),
            np.minimum((share["shout"] + share["bar"] + share["sign"]) / many, 2),
        ],
        axis=1,
    )
    keep = count > 0
    first = np.append(0, np.cumsum(keep))[lines.first]
    return rows[keep], chars[keep], first


def _with_neighbours(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, a constant, and those of the lines before and after it in its text."""
    n = len(rows)
    before, after = np.zeros_like(rows), np.zeros_like(rows)
    before[1:], after[:-1] = rows[:-1], rows[1:]
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    before[edge[:n]] = 0
    after[edge[1:]] = 0
    return np.hstack([rows, np.ones((n, 1)), before, after])


@dataclass
class Model:
    """Weights of the field (line emissions of *bad*, transitions) and of the document's score."""

    mean: np.ndarray
    scale: np.ndarray
    emit: np.ndarray
    stay: np.ndarray
    doc: np.ndarray
    constant: float | None = None


def _marginals(emission: np.ndarray, stay: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Chance of *bad* per line, expected stays per label, and the log of the partition function.

    ``emission`` is the score of *bad* against *good*; ``stay`` adds to two
    neighbours with label good, and bad.  Texts are worked on side by side.
    """
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    steps = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(steps), "left")  # texts longer than t
    n = len(emission)
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    trans = np.array([[stay[0], 0.0], [0.0, stay[1]]])
    for t in range(steps):
        at = begin[: alive[t]] + t
        alpha[at, 1] = emission[at]
        if t:
            alpha[at] += np.logaddexp(alpha[at - 1, :1] + trans[0], alpha[at - 1, 1:] + trans[1])
    for t in range(steps - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        ahead = beta[at + 1].copy()
        ahead[:, 1] += emission[at + 1]
        beta[at] = np.logaddexp(trans[:, 0] + ahead[:, :1], trans[:, 1] + ahead[:, 1:])
    last = (begin + length - 1)[length > 0]
    z = np.zeros(n)
    total = np.logaddexp(alpha[last, 0], alpha[last, 1])
    for_doc = np.repeat(total, length[length > 0])
    rows = np.concatenate([np.arange(b, b + k) for b, k in zip(begin[length > 0], length[length > 0], strict=True)]) if n else np.zeros(0, int)
    z[rows] = for_doc
    bad = np.exp(alpha[:, 1] + beta[:, 1] - z)
    linked = np.ones(n, bool)
    linked[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(linked)
    stays = [
        np.exp(alpha[at - 1, s] + trans[s, s] + (emission[at] if s else 0) + beta[at, s] - z[at]).sum() for s in (0, 1)
    ]
    return np.clip(bad, 0, 1), np.array(stays), float(total.sum())


def _fit_field(x: np.ndarray, bad: np.ndarray, first: np.ndarray, start: np.ndarray, rounds: int = 80) -> np.ndarray:
    """Maximum likelihood by gradient steps of adaptive size; the last two weights are the stays."""
    weights, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    linked = np.ones(len(x), bool)
    linked[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(linked)
    seen = np.array([((~bad[at - 1]) & (~bad[at])).sum(), (bad[at - 1] & bad[at]).sum()], float)
    for k in range(1, rounds + 1):
        p, stays, _ = _marginals(x @ weights[:-2], weights[-2:], first)
        grad = np.append(x.T @ (bad - p), seen - stays) / max(len(x), 1) - 1e-4 * weights
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        weights = weights + 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return weights


def _fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Newton steps for a small number of inputs."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) / len(x) - penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(x) + penalty * np.eye(len(w))
        w = w + np.linalg.solve(hess, grad)
    return w


def _summary(bad: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What a document's lines say of it: a constant, the length-weighted share of bad, the worst line, no lines."""
    n = np.diff(first)
    filled = n > 0
    out = np.zeros((len(n), 4))
    out[:, 0] = 1
    if filled.any():
        starts = first[:-1][filled]
        out[filled, 1] = np.add.reduceat(bad * size, starts) / np.add.reduceat(size, starts)
        out[filled, 2] = np.maximum.reduceat(bad, starts)
    out[~filled, 3] = 1
    return out


def fit(rows: np.ndarray, size: np.ndarray, first: np.ndarray, good: np.ndarray, turns: int = 3) -> Model:
    """Fit from the line features of labelled documents, laid end to end."""
    zero = np.zeros(3 * FEATURES + 1)
    if not len(rows) or good.all() or not good.any():
        share = float(good.mean()) if len(good) else 0.5
        return Model(np.zeros(FEATURES), np.ones(FEATURES), zero, np.zeros(2), np.zeros(4), share)
    mean, scale = rows.mean(0), rows.std(0) + 1e-3
    x = _with_neighbours((rows - mean) / scale, first)
    doc_bad = np.repeat(~good, np.diff(first))
    own = x[:, : FEATURES + 1]
    bad = doc_bad.copy()
    starts = first[:-1][np.diff(first) > 0]
    for _ in range(turns):
        w = _fit_logistic(own, bad.astype(float))
        p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
        # The worst line of a bad document is bad in any case.
        worst = np.repeat(np.maximum.reduceat(p, starts), np.diff(first)[np.diff(first) > 0])
        bad = doc_bad & ((p > 0.5) | (p >= worst))
    weights = _fit_field(x, bad, first, np.append(np.append(w, np.zeros(2 * FEATURES)), np.zeros(2)))
    p = _marginals(x @ weights[:-2], weights[-2:], first)[0]
    doc = _fit_logistic(_summary(p, size, first), good.astype(float))
    return Model(mean, scale, weights[:-2], weights[-2:], doc)


def _scored(model: Model, data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of texts, and of their lines the chance to be bad with each text's first line."""
    rows, size, first = _line_features(data, offsets, hasher)
    if model.constant is not None:
        return np.full(len(offsets) - 1, model.constant), np.zeros(len(rows)), first
    x = _with_neighbours((rows - model.mean) / model.scale, first)
    bad = _marginals(x @ model.emit, model.stay, first)[0]
    return 1 / (1 + np.exp(-_summary(bad, size, first) @ model.doc)), bad, first


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Rows kept from training, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_training: int = MAX_TRAINING) -> Model:
    """Fit on at most ``max_training`` labelled documents that are not held out, chosen by a hash of their ids."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_training)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            out, lengths = [], []
            for a, b in slices(offsets):
                rows, size, first = _line_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hasher)
                for i, j in zip(first[:-1], first[1:], strict=True):
                    out.append(rows[i:j].astype(np.float32).tobytes())
                    lengths.append(size[i:j].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()), pa.array(lengths, pa.binary())], ["quality", "rows", "size"]
            )

    found = sample.mapInArrow(process, "quality int, rows binary, size binary").toPandas()
    found = found.sort_values(["quality", "rows"], kind="stable")  # the same order, and so the same model, on each run
    rows = [np.frombuffer(r, np.float32).reshape(-1, FEATURES).astype(float) for r in found["rows"]]
    size = [np.frombuffer(r, np.float32).astype(float) for r in found["size"]]
    first = np.append(0, np.cumsum([len(r) for r in rows])).astype(int)
    stacked = np.concatenate([*rows, np.zeros((0, FEATURES))])
    return fit(stacked, np.concatenate([*size, np.zeros(0)]), first, found["quality"].to_numpy() == 1)


def score(docs: DataFrame, model: Model, with_lines: bool = False) -> DataFrame:
    """Documents with ``score``; with ``bad_lines`` too, the chance of each line with a word to be bad, if asked for."""
    docs = docs.drop("score", *(["bad_lines"] if with_lines else []))
    added = [T.StructField("score", T.DoubleType())]
    if with_lines:
        added.append(T.StructField("bad_lines", T.ArrayType(T.DoubleType())))
    schema = T.StructType([*docs.schema.fields, *added])

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
            scores, lines = [np.zeros(0)], []
            for a, b in slices(offsets):
                own, bad, first = _scored(model, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hasher)
                scores.append(own)
                if with_lines:
                    lines.extend(bad[i:j].tolist() for i, j in zip(first[:-1], first[1:], strict=True))
            columns = [pa.array(np.concatenate(scores))]
            if with_lines:
                columns.append(pa.array(lines, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *[f.name for f in added]])

    return docs.mapInArrow(process, schema)


def kept_documents(docs: DataFrame, labels: DataFrame, good_from: float = GOOD_FROM) -> DataFrame:
    """The documents that the classifier does not reject."""
    return score(docs, train(docs, labels)).where(F.col("score") >= good_from).select(*docs.columns)
