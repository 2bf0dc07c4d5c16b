"""Documents whose sets of word shingles are nearly the same, by exact Jaccard similarity.

1. Every text becomes the set of hashes of its shingles.  Equal sets are one node.
2. Two sets that link lack at most a tenth of each other's shingles.  So a node
   with enough shingles is represented by those of a part of all shingles, chosen
   by hash (:func:`share`); small nodes keep all.  Nodes near the border, and
   those with too few chosen shingles to be sure, are in both groups.
3. Rare-first prefixes: document frequencies over all nodes order the shingles;
   of the first ``u + 1``, where ``u`` may be lacking, two linked nodes share one.
   Shingles met once come first and join nothing, so most nodes need no join.
4. Nodes that share a prefix shingle and may link by length, position and sketch are put
   in a cluster.  A sketch is the parities of a set's shingles by their hashes: the bits
   in which two differ are not more than the shingles that only one of the sets has.  So
   texts that share a rare shingle by chance do not chain clusters that grow with the table.
5. Big clusters are cut into blocks and every two blocks meet in one task.  There an index
   of prefixes gives each pair once; length, positional and suffix filters drop most, the
   rest are verified on the whole sets, unless they are connected already.
6. Components of the verified links.

Nothing is dropped or capped: each filter only rules out pairs that cannot link.
Nodes are known by 64 bits of a digest of their set.

Defined results: null and empty texts, and texts of separators, have no shingles
and link with nothing; a text with fewer words than a shingle is one shingle;
repeated rows and equal texts are linked; rows with the same id share a result;
a row with a null id has the result of rows with an equal set, else a null one,
and connects no others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import components
from .store import stored
from .text import SPACE, Hasher, grams, slices, utf8

PERCENT = 90
SHINGLE = 3
SMALL = 256
NODES_PER_BLOCK = 512
_BITS = 1 << 26
_SLICE = 1 << 18
# Frequencies from here on rank alike, before the hashes.
_FREQUENT = (1 << 11) - 1
_HASH_BITS = 52
# Rows with one prefix token that are compared in one place; those of more common tokens are cut into blocks.
_ROWS_TOGETHER = 8192
_HOT_TOKENS = 50_000
_ROWS_AT_ONCE = 1 << 16
# Bytes of a sketch, and the largest sets for them: a bit for each three shingles.
_SKETCHES = ((16, 384), (32, 768), (64, 1536), (128, None))


def _lacking(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """How many shingles of a set of ``n`` may be missing from a set it links with."""
    return n - (percent * n + 99) // 100


def share(percent: int) -> int:
    """How many of a thousand shingles are chosen: a tenth of all beyond the part that may be lacking."""
    return min(1000, 10 * (100 - percent) + 100)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, hasher: Hasher, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = hasher.words(data, offsets, SPACE)
    hashes, at = grams(words, size)
    cut = np.searchsorted(at, words.first)
    counts = np.diff(words.first)
    # A shingle begins at every word of a long enough text but its last ones.
    sets = [np.unique(hashes[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    for k in np.flatnonzero((counts > 0) & (counts < size)):
        own = slice(words.first[k], words.first[k + 1])
        short = hasher.words(data[offsets[k] : offsets[k + 1]], np.array([0, offsets[k + 1] - offsets[k]]), SPACE)
        sets[k] = grams(short, own.stop - own.start)[0]
    return sets


def _node(members: np.ndarray) -> int:
    digest = hashlib.blake2b(members.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _tokens(members: np.ndarray, percent: int, small: int) -> tuple[np.ndarray, int, int]:
    """Shingles that stand for a set, and how many of them are of each group; the last bit tells the group."""
    n = len(members)
    chosen = members[(members >> np.uint64(20)) % np.uint64(1000) < np.uint64(share(percent))] if n * 100 >= small * percent else members[:0]
    whole = n <= small or len(chosen) <= _lacking(n, percent)
    every = members if whole else members[:0]
    one = np.uint64(1)
    return np.concatenate([every & ~one, chosen | one]).view(np.int64), len(every), len(chosen)


def sketch(members: np.ndarray) -> bytes:
    """Parities of the numbers of shingles by the leading bits of their hashes; larger sets have more of them."""
    width, most = _SKETCHES[-1][0], len(members)
    odd = np.bincount((members >> np.uint64(54)).astype(np.int64), minlength=8 * width) & 1
    bits = np.packbits(odd.astype(np.uint8))
    return _folded(bits, next(w for w, n in _SKETCHES if n is None or most <= n)).tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketches with fewer bits, each the parity of several."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def signatures(docs: DataFrame, size: int, percent: int, small: int) -> DataFrame:
    """Per row its node, the size of its set, its sketch and its tokens; nodes of empty sets are null."""

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            nodes, n, m0, m1, sketches, tokens = [], [], [], [], [], []
            for a, b in slices(offsets, _SLICE):
                for members in shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hasher, size):
                    own, whole, chosen = _tokens(members, percent, small)
                    nodes.append(_node(members) if len(members) else None)
                    n.append(len(members))
                    m0.append(whole)
                    m1.append(chosen)
                    sketches.append(sketch(members))
                    tokens.append(own)
            flat = np.concatenate([*tokens, np.zeros(0, np.int64)])
            at = np.append(0, np.cumsum([len(t) for t in tokens])).astype(np.int32)
            columns = [
                batch.column(0),
                pa.array(nodes, pa.int64()),
                pa.array(n, pa.int64()),
                pa.array(m0, pa.int32()),
                pa.array(m1, pa.int32()),
                pa.array(sketches, pa.binary()),
                pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "n", "m0", "m1", "sketch", "tokens"])

    schema = "doc_id bigint, node bigint, n bigint, m0 int, m1 int, sketch binary, tokens array<bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(process, schema)


def prefixes(nodes: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Per node and group: the prefix tokens that other nodes have too, rarest first, and where they begin.

    Tokens are shuffled once, to be counted where they lie.  A token that others have becomes
    its frequency before the rest of its hash, so that numbers tell the order and one is sent a row.
    """
    spread = tokens.select("node", F.explode("tokens").alias("token"))
    counted = spread.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("df > 1")
    rank = F.shiftleft(F.least("df", F.lit(_FREQUENT)).cast("bigint"), _HASH_BITS)
    ranked = counted.select("node", rank.bitwiseOR(F.col("token").bitwiseAND((1 << _HASH_BITS) - 1)).alias("token"))
    # Dealt out before they are listed: lists made before it are twice as large.
    listed = (
        ranked.repartition("node")
        .groupBy("node", (F.col("token").bitwiseAND(1)).cast("int").alias("part"))
        .agg(F.array_sort(F.collect_list("token")).alias("common"))
    )
    lacking = F.col("n") - F.floor((percent * F.col("n") + 99) / 100)
    sized = listed.join(nodes.select("node", "n", "m0", "m1", "sketch"), "node").withColumn(
        "m", F.when(F.col("part") == 0, F.col("m0")).otherwise(F.col("m1"))
    )
    alone = F.col("m") - F.size("common")
    # A node with too few tokens to be sure offers them all.
    wanted = F.when(F.col("m") <= lacking, F.col("m")).otherwise(lacking + 1)
    return (
        sized.withColumn("skip", alone.cast("int"))
        .withColumn("take", (wanted - alone).cast("int"))
        .where("take > 0")
        .select("node", "part", "n", "m", "skip", "sketch", F.slice("common", F.lit(1), F.col("take")).alias("prefix"))
    )


def _clusters(offered: DataFrame, percent: int, together: int) -> DataFrame:
    """Nodes that may link, directly or through others: ``node`` and ``cluster``."""
    lacking = F.col("n") - F.floor((percent * F.col("n") + 99) / 100)
    rows = offered.select(
        "node",
        F.col("n").cast("int").alias("n"),
        (F.col("m") - F.col("skip")).alias("after"),
        (F.col("m") - lacking).cast("int").alias("need"),
        "sketch",
        F.posexplode("prefix").alias("k", "token"),
    )
    most = max(together, (offered.agg(F.sum(F.size("prefix"))).first()[0] or 0) // _HOT_TOKENS)
    # At most _HOT_TOKENS rows.
    common = offered.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("rows"))
    cut = F.broadcast(common.where(F.col("rows") > most).select("token", F.ceil(F.col("rows") / most).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.xxhash64("token", F.least(F.col("block"), k), F.greatest(F.col("block"), k)),
    )
    # Two tokens with one hash are compared together, which costs time only.
    places = F.when(F.col("blocks").isNull(), F.array("token")).otherwise(met)
    placed = rows.join(cut, "token", "left").withColumn("block", block).select(
        F.explode(places).alias("place"), "node", "n", (F.col("after") - F.col("k")).alias("after"), "need", "sketch"
    )

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_places(batches):
            u, v = _near(whole, percent)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    ordered = placed.repartition("place").sortWithinPartitions("place", "n", "node")
    found = components(ordered.mapInArrow(process, "u bigint, v bigint"))
    roots = found.select(F.col("root").alias("node"), F.col("root").alias("cluster")).distinct()
    return found.select("node", F.col("root").alias("cluster")).unionByName(roots)


def _whole_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that come sorted by place, many places at a time and none cut in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) < _ROWS_AT_ONCE:
            continue
        table = pa.Table.from_batches(held)
        place = table["place"].to_numpy()
        cut = int(np.searchsorted(place, place[-1]))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _near(rows: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """Enough pairs of nodes at one place that may link to connect all that may; sorted by place and size."""
    place, n, after, need = (rows[c].to_numpy() for c in ("place", "n", "after", "need"))
    nodes, at = np.unique(rows["node"].to_numpy(), return_inverse=True)
    differing = _differing(rows["sketch"].to_pylist())
    union, root, u, v = _Union(len(nodes)), np.arange(len(nodes)), [], []
    i, step = np.arange(len(place)), 0
    while len(i):
        # Every row with the one so many behind it, as long as that is at its place and not too large.
        step += 1
        i = i[i + step < len(place)]
        j = i + step
        i = i[(place[i] == place[j]) & (100 * n[i].astype(np.int64) >= percent * n[j].astype(np.int64))]
        j = i + step
        open_now = (root[at[i]] != root[at[j]]) & (np.minimum(after[i], after[j]) >= np.maximum(need[i], need[j]))
        a, b = i[open_now], j[open_now]
        both = n[a].astype(np.int64) + n[b]
        least = -(-percent * both // (100 + percent))
        may = differing(a, b) <= both - 2 * least
        joined = [(x, y) for x, y in zip(at[a[may]].tolist(), at[b[may]].tolist(), strict=True) if union.join(x, y)]
        if joined:
            u += nodes[[x for x, _ in joined]].tolist()
            v += nodes[[y for _, y in joined]].tolist()
            root = union.roots()
    return u, v


def _differing(sketches: list[bytes]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """The number of bits in which the sketches of rows differ, by as many bits as both have."""
    width = np.array([len(s) for s in sketches])
    # Per width the sketches of all rows that have at least as many bits, and where each row's is.
    folded = {}
    for w, _ in _SKETCHES:
        mine = np.flatnonzero(width >= w)
        parts = [
            _folded(np.frombuffer(b"".join(sketches[k] for k in own), np.uint8).reshape(-1, x), w)
            for x, _ in _SKETCHES
            if x >= w and len(own := mine[width[mine] == x])
        ]
        order = np.concatenate([mine[width[mine] == x] for x, _ in _SKETCHES if x >= w])
        where = np.zeros(len(sketches), np.int64)
        where[order] = np.arange(len(order))
        folded[w] = (np.concatenate(parts).view(np.uint64) if parts else np.zeros((0, w // 8), np.uint64), where)

    def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        common = np.minimum(width[a], width[b])
        for w, (bits, where) in folded.items():
            own = np.flatnonzero(common == w)
            out[own] = np.bitwise_count(bits[where[a[own]]] ^ bits[where[b[own]]]).sum(axis=1, dtype=np.int64)
        return out

    return differing


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows with ``found``: whether their ``doc_id`` may be among ``ids``; if not, it surely is not.

    A bitmap of hashes of fixed size (2,048 rows of 4 KB) is sent to all tasks; it
    spares the others the shuffle of a join.
    """
    place = f"pmod(xxhash64(doc_id), {_BITS}L)"
    bits = ids.groupBy(F.expr(f"bitmap_bucket_number({place})").alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({place}))").alias("bits")
    )
    marked = (
        rows.withColumns({"bucket": F.expr(f"bitmap_bucket_number({place})"), "bit": F.expr(f"bitmap_bit_position({place})")})
        .join(F.broadcast(bits), "bucket", "left")
    )
    byte = "cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)"
    found = F.expr(f"coalesce(shiftright({byte}, cast(bit % 8 as int)) & 1, 0) = 1")
    return marked.select(*rows.columns, found.alias("found"))


def _split_by(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id`` and ``text`` of the documents that may be among ``ids``, and of those that surely are not."""
    marked = _marked(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), ids)
    return marked.where("found").drop("found"), marked.where("not found").drop("found")


def _with_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """``members`` (``doc_id``, ``node`` and others) with the whole sets of their nodes, from the texts."""
    wanted, _ = _split_by(docs, members)
    texts = wanted.join(members, "doc_id").select(*members.columns, "text")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema)

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            data, offsets = utf8(batch.column(batch.num_columns - 1))
            own = batch.column(batch.schema.get_field_index("node")).to_numpy()
            kept, sets = [], []
            for a, b in slices(offsets, _SLICE):
                found = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hasher, size)
                # A text of another document with the same id has another node.
                kept.append([len(members) > 0 and _node(members) == node for members, node in zip(found, own[a:b], strict=True)])
                sets.extend(members.tobytes() for members in found)
            columns = [*batch.columns[:-1], pa.array(sets, pa.binary())]
            names = [*batch.schema.names[:-1], "members"]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array([k for part in kept for k in part], pa.bool_()))

    return texts.mapInArrow(process, f"{fields}, members binary")


class _Union:
    def __init__(self, n: int):
        self._up = list(range(n))

    def root(self, x: int) -> int:
        while self._up[x] != x:
            self._up[x] = self._up[self._up[x]]
            x = self._up[x]
        return x

    def roots(self) -> np.ndarray:
        """The root of every element."""
        up = np.array(self._up)
        while not np.array_equal(further := up[up], up):
            up = further
        return up

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self._up[max(x, y)] = min(x, y)
        return x != y


def _verified(group: pd.DataFrame, percent: int) -> Iterator[tuple[int, int]]:
    """Links between the nodes of two blocks that connect more than earlier ones did."""
    group = group.drop_duplicates("node").sort_values(["n", "node"], kind="stable").reset_index(drop=True)
    sets = [np.frombuffer(b, np.uint64) for b in group["members"]]
    sizes = group["n"].to_numpy()
    block = group["block"].to_numpy()
    # Shingles by the leading bits of their hashes: the sum of the smaller counts bounds an intersection.
    bins = np.stack([np.bincount((s >> np.uint64(59)).astype(np.int64), minlength=32) for s in sets])
    nodes, union = group["node"].tolist(), _Union(len(group))
    index: dict[int, list[tuple[int, int, int]]] = {}
    cross = len(set(block)) > 1
    for y, offers in enumerate(group["offers"]):
        seen: set[int] = set()
        for offer in offers:
            m, lacking = int(offer["m"]), int(_lacking(int(sizes[y]), percent))
            for k, token in enumerate(offer["prefix"]):
                position = int(offer["skip"]) + k
                held = index.setdefault(int(token), [])
                for x, left, need in held:
                    if x in seen or (cross and block[x] == block[y]):
                        continue
                    seen.add(x)
                    # Length, then position: all that can still be shared from here on.
                    if 100 * sizes[x] < percent * sizes[y] or min(left, m - position) < max(need, m - lacking):
                        continue
                    both = sizes[x] + sizes[y]
                    least = -(-percent * both // (100 + percent))
                    if union.root(x) == union.root(y) or np.minimum(bins[x], bins[y]).sum() < least:
                        continue
                    common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if 100 * common >= percent * (both - common) and union.join(x, y):
                        yield nodes[x], nodes[y]
                held.append((y, m - position, m - lacking))


def _tokens_of(docs: DataFrame, rows: DataFrame, reps: DataFrame, sign) -> DataFrame:
    """Tokens of one document of each node, read from the texts: they are too many to store.

    Documents that surely are no copies of others are taken as they are, so only
    the rest are joined with the list of those that stand for their nodes.
    """
    copies = rows.join(reps.withColumnRenamed("doc_id", "rep"), "node").where("doc_id != rep").select("doc_id")
    doubtful, single = _split_by(docs, copies)
    chosen = sign(doubtful.join(reps.select("doc_id").distinct(), "doc_id")).join(reps, ["node", "doc_id"], "left_semi")
    return sign(single).where("node is not null").select("node", "tokens").unionByName(chosen.select("node", "tokens"))


def _links(docs: DataFrame, nodes: DataFrame, tokens: DataFrame, size: int, percent: int, per_block: int) -> DataFrame:
    """Enough verified links ``u``-``v`` to connect all nodes that links connect."""
    offered = stored(prefixes(nodes, tokens, percent), "prefixes")
    clusters = stored(_clusters(offered, percent, min(_ROWS_TOGETHER, 16 * per_block)), "clusters")
    blocks = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / per_block).cast("int").alias("blocks"))
    bins = 1 + clusters.count() // per_block
    big = F.col("blocks") > 1
    placed = (
        clusters.join(blocks, "cluster")
        .withColumn("block", F.when(big, F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).otherwise(0))
        .withColumn("home", F.when(big, F.col("cluster")).otherwise(F.pmod(F.xxhash64("cluster"), F.lit(bins))))
    )
    offers = offered.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("part", "m", "skip", "prefix"))).alias("offers"))
    wanted = placed.join(nodes.select("node", "doc_id", "n").distinct(), "node").join(offers, "node")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("low"), F.greatest("block", k).alias("high")),
    )
    full = _with_sets(docs, wanted.select("doc_id", "node", "n", "home", "blocks", "block", "offers"), size)
    met = full.withColumn("p", F.explode(pair)).select("home", "blocks", "p.low", "p.high", "node", "n", "block", "members", "offers")

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_verified(group, percent), columns=["u", "v"], dtype="int64")

    return met.groupBy("home", "blocks", "low", "high").applyInPandas(verify, "u bigint, v bigint")


def _rooted(docs: DataFrame, size: int, percent: int, small: int, per_block: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``doc_id``, ``n`` and ``node``; and the nodes with their smallest id and the root of their component."""
    def sign(some: DataFrame) -> DataFrame:
        return signatures(some, size, percent, small)

    rows = stored(sign(docs).drop("tokens"), "signatures")
    # Written, so that joins with it read plain shuffles, whose partitions of many copies Spark can split.
    reps = stored(rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "representatives")
    nodes = rows.join(reps, ["node", "doc_id"])
    found = components(_links(docs, nodes, _tokens_of(docs, rows, reps, sign), size, percent, per_block))
    return rows, reps.join(found, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))


def ngram_components(
    docs: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    small: int = SMALL,
    per_block: int = NODES_PER_BLOCK,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, and ``component_id``, the smallest id it is linked with directly or not."""
    rows, rooted = _rooted(docs, size, percent, small, per_block)
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = rooted.join(least, "root").select("node", "component_id")
    return rows.select("doc_id", "n", "node").join(labels, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _with_nodes(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (``doc_id``, ``text`` and others) with ``node`` in place of the text."""
    schema = T.StructType([*[f for f in rows.schema if f.name != "text"], T.StructField("node", T.LongType())])

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            data, offsets = utf8(batch.column(at))
            nodes = []
            for a, b in slices(offsets, _SLICE):
                sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hasher, size)
                nodes += [_node(members) if len(members) else None for members in sets]
            rest = [k for k in range(batch.num_columns) if k != at]
            names = [batch.schema.names[k] for k in rest]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in rest], pa.array(nodes, pa.int64())], [*names, "node"])

    return rows.mapInArrow(process, schema)


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group, with all columns: one with the group's smallest id.

    Rows without an id are linked like others and rank behind ids below 2^62.
    Rows without shingles are in no group: of those with the same id one stays, and
    all without an id.  If rows have the same id and set, the one with the smallest
    text stays.
    """
    text = F.col("text").cast("string")
    # A key that every reading of the row gives again; where it is also an id, the nodes tell the rows apart.
    made = F.lit(1 << 62) + F.xxhash64(text).bitwiseAND((1 << 62) - 1)
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), made).alias("doc_id"),
        text.alias("text"),
        F.col("doc_id").cast("bigint").isNull().alias("without"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    rows, rooted = _rooted(keyed.select("doc_id", "text"), size, percent, SMALL, NODES_PER_BLOCK)
    first = rooted.groupBy("root").agg(F.min(F.struct("doc_id", "node")).alias("first")).select("first.doc_id", "first.node")
    chosen = stored(first.unionByName(rows.where("node is null").select("doc_id", "node").distinct()), "chosen")
    # An id of one row tells which row is meant; the others need their nodes.
    repeated = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    marked = _marked(keyed, repeated)
    plain = marked.where("not found and not without").join(chosen.select("doc_id"), "doc_id", "left_semi").select("row.*")
    doubtful = _with_nodes(marked.where("found or without").select("doc_id", "without", "row", "text", text.alias("order")), size)
    linked = doubtful.where("node is not null or not without")
    one = linked.groupBy("doc_id", "node").agg(F.min_by("row", F.struct("without", "order")).alias("row"))
    same = one["doc_id"].eqNullSafe(chosen["doc_id"]) & one["node"].eqNullSafe(chosen["node"])
    alone = doubtful.where("node is null and without").select("row.*")
    return plain.unionByName(one.join(chosen, same, "left_semi").select("row.*")).unionByName(alone)
