"""Registered queries against SQL, and those without SQL against plain loops, over the smallest sample."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from ledgerloom.llm import kneser_ney
from ledgerloom.llm.oracle import ORACLE
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(tables):
    return dict(tables.execute("select doc_id, coalesce(text, '') from documents").fetchall())


@pytest.fixture(scope="module")
def ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {d: tokenizer.encode(t, add_special_tokens=False).ids + [0] for d, t in texts.items()}
    return {d: np.array(found[d], "<u4") for d in sorted(found)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, tables, name):
    got = QUERIES[name](spark, SF)
    columns = ", ".join(got.columns)
    want = tables.execute(f"select {columns} from ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


def test_base_secrets(spark, texts):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    for row in QUERIES["op3_secret_scan"](spark, SF).collect():
        text = texts[row.doc_id]
        spans = [
            [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12],
            [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18],
            [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16],
        ]
        base = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(s for one in spans for s in one))
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(map(len, spans))
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(row.spans.split(","))


def test_token_files(spark, ids):
    at = 0
    rows = {r.doc_id: r for r in QUERIES["op4_token_ids"](spark, SF).collect()}
    assert rows.keys() == ids.keys()
    for doc, own in ids.items():
        assert (rows[doc].start, rows[doc].n_tokens, rows[doc].ids_crc32) == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)


def check_packed(rows, ids):
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for doc, own in ids.items():
        at = 0
        for k, r in enumerate(sorted(pieces[doc], key=lambda r: r.piece)):
            part = own[at : at + r.length]
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(part.tobytes()))
            assert r.length == 2048 if k else 0 < r.length <= 2048
            at += r.length
        assert at == len(own)
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    return len(places), -(-sum(map(len, ids.values())) // 2048)


def test_packing(spark, ids):
    used, least = check_packed(QUERIES["op10_best_fit_packing"](spark, SF).collect(), ids)
    assert used <= least * 1.02 + 1


def plain_model(texts, order):
    """The same model by loops over dictionaries."""
    fold = {c: c + 32 for c in range(65, 91)}
    tokens = {d: re.findall(r"[^\x20\x09-\x0d]+", t.translate(fold)) + ["</s>"] for d, t in texts.items()}
    seen, pairs, triples = collections.Counter(), collections.Counter(), collections.Counter()
    for d, own in tokens.items():
        if zlib.crc32(str(d).encode()) % 7 != 2:
            seen.update(own)
            pairs.update(zip(["<s>", *own], own, strict=False))
            triples.update(zip(["<s>", *own], own, own[1:], strict=False))
    if order == 3:
        preceded = collections.Counter((v, w) for _, v, w in triples)
        pairs = collections.Counter({k: c if k[0] == "<s>" else preceded[k] for k, c in pairs.items()})
    total, size = sum(seen.values()), len(seen)

    def discounts(counts):
        n = [sum(v == k for v in counts) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [0] + [max(0, min(k, k - (k + 1) * y * n[k] / n[k - 1])) for k in (1, 2, 3)]

    def contexts(counts, discount):
        sums, passed = collections.Counter(), collections.Counter()
        for k, v in counts.items():
            sums[k[:-1]] += v
            passed[k[:-1]] += discount[min(v, 3)]
        return sums, passed

    def mixed(counts, discount, sums, passed, key, p):
        if not sums[key[:-1]]:
            return p
        return (max(counts[key] - discount[min(counts[key], 3)], 0) + passed[key[:-1]] * p) / sums[key[:-1]]

    before = collections.Counter(w for _, w in pairs)
    lower, middle, upper = discounts(before.values()), discounts(pairs.values()), discounts(triples.values())
    left = sum(lower[min(v, 3)] for v in before.values()) / len(pairs)
    by_one, by_two = contexts(pairs, middle), contexts(triples, upper)
    for d, own in tokens.items():
        score = base = 0.0
        for u, v, w in zip([None, "<s>", *own], ["<s>", *own], own, strict=False):
            p = (before[w] - lower[min(before[w], 3)]) / len(pairs) + left / (size + 1)
            p = mixed(pairs, middle, *by_one, (v, w), p)
            if order == 3:
                p = mixed(triples, upper, *by_two, (u, v, w), p)
            score += math.log10(p)
            base += math.log10((seen[w] + 1) / (total + size + 1))
        yield d, len(own), sum(w in seen for w in own), total, base, score


def test_language_model(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op6_kneser_ney"](spark, SF).collect()}
    assert rows.keys() == texts.keys()
    for d, n, known, total, base, score in plain_model(texts, order=3):
        r = rows[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(d).encode()) % 7 == 2, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=1e-9)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("share", [30, 10**9])
def test_language_model_orders(spark, texts, monkeypatch, order, share):
    """Both orders, with runs, ranges and lists of large counts and contexts that small texts reach."""
    for name, value in {"TOKENS_PER_RUN": 5000, "TOKENS_PER_RANGE": 9000, "WIDE": 2, "SCORED_BYTES": 30_000, "FREQUENT_SHARE": share}.items():
        monkeypatch.setattr(kneser_ney, name, value)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(3)
    model = kneser_ney.train(docs.where(~kneser_ney.held_out()), parts=2, order=order)
    assert model.vocabulary.range_bits > 1
    rows = {r.doc_id: r.score for r in kneser_ney.score(docs, model).collect()}
    want = {d: score for d, *_, score in plain_model(texts, order)}
    assert rows.keys() == want.keys()
    assert all(rows[d] == pytest.approx(want[d], rel=1e-9) for d in want)


def test_language_model_of_another_order(spark):
    with pytest.raises(ValueError, match="order"):
        kneser_ney.train(spark.createDataFrame([("a",)], "text string"), order=4)


def test_quality_held_out(spark, tables):
    rows = {r.doc_id: r for r in QUERIES["op7_line_crf_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = tables.execute("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [(rows[d].predicted, q) for d, q in labels if rows[d].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs.count())
        if k < 4:
            assert docs.columns == columns
    assert kept[0] >= kept[1] >= kept[2] == kept[3] > 0
    assert docs.select("doc_id").distinct().count() == kept[3]
    again = corpus_pipeline.run(spark, SF)
    order = ["doc_id", "piece"]
    assert again.orderBy(order).select("doc_id", "piece", "length", "ids_crc32").collect() == docs.orderBy(order).select(
        "doc_id", "piece", "length", "ids_crc32"
    ).collect()
