"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import gzip
import hashlib
import math
import random
import textwrap
import zlib
from collections import Counter
from urllib.parse import quote

import numpy as np
import pytest
import regex

from ledgerloom.llm import (
    chat_format,
    decontamination,
    embedding_dedup,
    graph,
    kneser_ney,
    license_scan,
    line_crf,
    ngram_join,
    packing,
    secret_scan,
    token_output,
)

DOC = "doc_id bigint, text string, score string, n_words string, length string"
LONG = " ".join(f"w{k % 977}" for k in range(60_000))
ODD = [
    (1, None, "x", "y", "z"),
    (2, "", "x", "y", "z"),
    (3, " \n\t ", "x", "y", "z"),
    (4, "one", "x", "y", "z"),
    (4, "one", "x", "y", "z"),
    (5, "One two", None, None, None),
    (None, "the quick brown fox jumps over the lazy dog again", "x", "y", "z"),
    (6, "the quick brown fox jumps over the lazy dog again", "x", "y", "z"),
    (7, LONG, "x", "y", "z"),
    (8, LONG, "x", "y", "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 500)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: root(x) for x in up if root(x) != x}


def plain_components(texts, size, percent):
    sets = {}
    for d, t in texts:
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\n", " ").replace("\t", " ").split(" ") if x]
        sets[d] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            k = len(sets[a] & sets[b])
            if a < b and k and 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize(("size", "percent", "small", "block"), [(3, 90, 256, 512), (3, 90, 20, 4), (5, 80, 40, 8)])
def test_ngram_components(spark, size, percent, small, block):
    rng, docs = random.Random(7), []
    for base in range(12):
        words = [f"b{base if rng.random() < 0.9 else 0}x{rng.randrange(400)}" for _ in range(rng.choice([2, 5, 30, 90, 300]))]
        for _ in range(rng.choice([1, 2, 14])):
            copy = [w if rng.random() > rng.choice([0, 0.01, 0.03]) else f"n{rng.randrange(10**6)}" for w in words]
            docs.append((len(docs) * 3, " ".join(copy[: rng.choice([len(copy), len(copy) - 1])])))
    docs += [(1000, None), (1001, ""), (1002, "Solo"), (1003, "solo ")]
    rng.shuffle(docs)
    got = ngram_join.ngram_components(spark.createDataFrame(docs, "doc_id bigint, text string"), size, percent, small, block)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == plain_components(docs, size, percent)


def test_ngram_texts_with_passages_in_common_make_no_cluster(spark, monkeypatch):
    written = {}

    def passage(a, b):
        return " ".join(f"p{min(a, b)}x{max(a, b)}w{k}" for k in range(40))

    # Almost every shingle of a text is found in one other text, and no two texts are alike.
    docs = [(a, " ".join(passage(a, b) for b in range(12) if a != b)) for a in range(12)]
    docs += [(100, docs[7][1] + " more"), (101, docs[8][1] + " words")]
    monkeypatch.setattr(ngram_join, "stored", lambda df, name, f=ngram_join.stored: written.setdefault(name, f(df, name)))
    got = ngram_join.ngram_components(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {**{k: k for k in range(12)}, 100: 7, 101: 8}
    assert written["clusters"].count() == 4


def test_sketches_differ_in_no_more_than_the_sets_do():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 40, 384, 385, 700, 1500, 3000)]
    sets += [np.unique(np.concatenate([s[: -len(s) // 20 or None], sets[0]])) for s in sets]
    differing = ngram_join._differing([ngram_join.sketch(s) for s in sets])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    apart = [len(np.setxor1d(sets[x], sets[y])) for x, y in zip(a, b)]
    assert (differing(a, b) <= apart).all() and differing(a, b)[(a == 3) & (b == 4)] > 70


def test_ngram_odd(odd, none):
    got = ngram_join.ngram_components(odd).collect()
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[k].n_shingles for k in (1, 2, 3, 4, 5, 6)] == [0, 0, 0, 1, 1, 8]
    assert by_id[8].component_id == 7 and by_id[3].component_id == 3
    assert ngram_join.ngram_components(none).count() == 0
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns and 8 not in {r.doc_id for r in kept.collect()}


def test_one_row_of_each_group(spark):
    words = [f"w{k}" for k in range(60)]
    a, b, c = " ".join(words), " ".join([*words[:-1], "other"]), "an unrelated text of a few words"
    rows = [(1, b), (3, a), (3, a), (3, c), (4, "x y z"), (4, "x y z"), (None, a), (None, c), (None, "no copy of it"), (None, "no copy of it")]
    rows += [(5, c), (6, ""), (6, None), (None, ""), (None, None), (9, "q r s")]
    kept = ngram_join.one_of_each(spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, row int"))
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert kept.columns == ["doc_id", "text", "row"]
    want = [(1, b), (3, c), (4, "x y z"), (6, None), (9, "q r s"), (None, "no copy of it"), (None, ""), (None, None)]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("rows", [3, 2048])
def test_near_vectors(spark, rows):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((12, 20))
    data = []
    for k in range(60):
        v = base[k % 12] + rng.standard_normal(20) * rng.choice([0.05, 0.25, 0.35])
        data.append((k, [float(x) for x in v], k % 2))
    data += [(100, data[0][1], 0), (101, data[0][1], 0), (102, data[0][1], None), (103, None, 0), (104, [], 0)]
    data += [(105, [0.0] * 20, 0), (106, [float("nan")] * 20, 0), (107, [1.0, None], 0), (108, data[0][1][:10], 0)]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int")
    good = [(i, np.array(v), c) for i, v, c in data if c is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: set() for i, _, _ in data}
    for i, v, c in good:
        for j, w, e in good:
            if i != j and c == e and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93:
                links[i].add(j)
    for r in embedding_dedup.near_duplicates(frame, rows_per_block=rows).collect():
        seen, todo = {r.vec_id}, [r.vec_id]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        assert (r.n_links, r.component_id, r.kept) == (len(links[r.vec_id]), min(seen), min(seen) == r.vec_id)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    v = rng.standard_normal((400, 64))
    v /= np.sqrt((v * v).sum(1))[:, None]
    codes = embedding_dedup.Codes(v)
    estimate = codes.products(slice(0, 400), codes) / codes.factor[:, None]
    error = estimate - v @ v.T
    off = ~np.eye(400, dtype=bool)
    assert abs(error[off].mean()) < 0.005
    near = v @ v.T >= 0.3
    assert (codes.products(slice(0, 400), codes) + codes.rounding[None] + 1e-9 >= codes.at_least(0.3, 8.0, 64)[:, None])[near].all()


def test_nested_secrets(spark, odd, none):
    key = "AKIA" + "Q7" * 10
    packed = base64.b64encode(zlib.compress(("some words " * 5 + key).encode())).decode()
    cases = {
        quote(f"token={'a1' * 10}!", safe=""): "assign",
        base64.b64encode(f"user secret = {'zz9' * 6} x".encode()).decode(): "assign",
        "".join(f"\\u{ord(c):04x}" for c in key): "access",
        packed: "access",
        base64.b64encode(quote(base64.b64encode(key.encode()).decode(), safe="").encode()).decode(): "access",
    }
    for encoded, kind in cases.items():
        text = f"é before {encoded} after"
        base, found = secret_scan.find_secrets(text)
        hits = [(a, b) for a, k, b in found - set(base) if secret_scan.KINDS[k] == kind]
        assert hits and all(9 <= a < b <= 9 + len(encoded) for a, b in hits), encoded
        cleaned = secret_scan.redacted(text, secret_scan._joined(found))
        assert not secret_scan.find_secrets(cleaned)[1] and cleaned.startswith("é before") and cleaned.endswith(" after")
    got = secret_scan.scan_secrets(odd).collect()
    assert len(got) == len(ODD) and all(r.spans == "" for r in got)
    assert secret_scan.scan_secrets(none).count() == 0
    assert sorted(map(str, secret_scan.redact_secrets(odd).collect())) == sorted(map(str, odd.collect()))


@pytest.mark.parametrize(
    "text",
    [
        "api%5Fkey = ABCDEFGHIJKL1234",
        "pass\\u0077ord: hunter2hunter2",
        '"token"\\u003a "abcdefghijkl"',
        "api%5Fkey\\u003d abcdefghijkl",
        "password: token%3A abcdefghijkl",
        "p%2561ssword = hunter2hunter2",
    ],
)
def test_secrets_partly_escaped(text):
    found = secret_scan.find_secrets(f"é {text} end")[1]
    assert any(k == 0 and b == 2 + len(text.rstrip('"')) for _, k, b in found)
    assert secret_scan.redacted(f"é {text} end", secret_scan._joined(found)).endswith(('[REDACTED] end', '[REDACTED]" end'))


def test_secrets_packed_twice_and_over_lines():
    key = "AKIA" + "Q7" * 10
    rng = random.Random(3)
    plain = " ".join(f"word{rng.randrange(10**6)}" for _ in range(40)) + f"\n{key} end"
    once, raw = gzip.compress(plain.encode()), zlib.compressobj(9, zlib.DEFLATED, -15)
    deflated = raw.compress(plain.encode()) + raw.flush()

    def b64(data):
        return base64.b64encode(data).decode()

    members = gzip.compress(b"the first member only ") + gzip.compress(b"second one") + once
    cases = {
        "gzip of gzip": b64(gzip.compress(once)),
        "zlib of gzip": b64(zlib.compress(once)),
        "raw of zlib": b64(zlib.compress(deflated)),
        "members": b64(members),
        "padded members": b64(members[: -len(once)] + b"\0" * 9 + once),
        "percent": "data=" + quote(once, safe=""),
        "repr": repr(once),
        "json": '"' + "".join(f"\\u00{b:02x}" for b in zlib.compress(plain.encode())) + '"',
        "mime": base64.encodebytes(plain.encode()).decode(),
        "mime gzip": base64.encodebytes(once).decode(),
        "indented": "\n    ".join(textwrap.wrap(b64(once), 64)),
        "escaped breaks": "\\n".join(textwrap.wrap(b64(once), 64)),
        "path": "dir/x/" + b64(plain.encode()),
        "path of gzip": "a-name_of/x/" + b64(once),
        "path of deflate": "dir/x/" + b64(deflated),
        "before a path": b64(b"for example " + key.encode() + b" and more") + "/some/where/else",
        "many": b64(gzip.compress(b64(gzip.compress(b64(once).encode())).encode())),
    }
    for name, encoded in cases.items():
        text = f"é before {encoded} after"
        found = secret_scan.find_secrets(text)[1]
        hits = [(a, b) for a, k, b in found if k == 1]
        assert hits and all(9 <= a < b <= 9 + len(encoded) for a, b in hits), name
        cleaned = secret_scan.redacted(text, secret_scan._joined(found))
        assert not [s for s in secret_scan.find_secrets(cleaned)[1] if s[1] == 1], name
    for cut in range(len(members)):
        pieces = [members[:cut], members[cut:], b"", b"tail"]
        assert b"".join(secret_scan._inflate(iter(pieces), 31)) == b"the first member only second one" + plain.encode() + b"\ntail"
    exact = base64.encodebytes(plain.encode()).decode()
    a, _, b = next(s for s in secret_scan.find_secrets(exact)[1] if s[1] == 1)
    at = plain.index(key) * 4 // 3
    assert a == at + at // 76 and b - a <= 34


def test_secrets_far_inside_a_stream(monkeypatch):
    line = "Ein längerer Satz, größer als nötig.\n".encode()
    plain = line * ((65 << 20) // len(line)) + b"token = abcdefghijkl12\n"
    packed = base64.b64encode(gzip.compress(plain, 1)).decode()
    assert {(k, a, b) for a, k, b in secret_scan.find_secrets(f"é {packed} end")[1]} == {(0, 2, 2 + len(packed))}
    key = "AKIA" + "Q7" * 10
    inner = base64.encodebytes(gzip.compress(key.encode() + random.Random(1).randbytes(400))).decode()
    kinds = [key, "token" + " " * 300 + "= abcdefghijkl", "pass%77ord: hunter2hunter2", "0" * 999, inner, quote(inner), "\\x41KIA" + "Q7" * 10]
    rng = random.Random(8)
    monkeypatch.setattr(secret_scan, "CHUNK", 64)
    for secret in kinds:
        for sep in (". \n", ", ", "\n", " "):
            text = "é" + "".join(f"{rng.choice(['word', 'Ä', 'x.y', 'a=b'])}{sep}" for _ in range(rng.randrange(200)))
            text = base64.b64encode(zlib.compress(f"{text}{sep}{secret}{sep}{text}".encode())).decode()
            monkeypatch.setattr(secret_scan, "WINDOW", 1 << 30)
            whole = secret_scan.find_secrets(text)[1]
            monkeypatch.setattr(secret_scan, "WINDOW", 50)
            assert whole and secret_scan.find_secrets(text)[1] == whole


def test_token_files_odd(odd, none):
    rows = token_output.token_stream(odd).collect()
    assert len(rows) == len(ODD) and sum(r.n_tokens == 1 for r in rows) == 2
    ends = sorted((r.start, r.start + r.n_tokens) for r in rows)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert token_output.token_stream(none).count() == 0


def test_packing_plan():
    rng = random.Random(3)
    for _ in range(40):
        capacity = rng.choice([7, 32, 2048])
        counts = {rng.randint(1, capacity): rng.randint(1, 50) for _ in range(rng.randint(0, 40))}
        used: dict[int, int] = {}
        for times, lengths in packing.pack_lengths(counts, capacity):
            assert times > 0 and 0 < sum(lengths) <= capacity
            for v in lengths:
                used[v] = used.get(v, 0) + times
        assert used == counts
    assert sum(t for t, _ in packing.pack_lengths({2000: 9, 40: 9, 8: 9})) == 9


def test_packing_odd(odd, none):
    rows = packing.pack_documents(odd).collect()
    assert {r.doc_id for r in rows} == {r[0] for r in ODD}
    assert packing.pack_documents(none).count() == 0
    pieces = packing.token_pieces(odd, with_ids=True)
    whole = packing.sequences(packing.pack(pieces, ["doc_id", "piece", "start", "ids_crc32"])).collect()
    assert all(len(r.ids) == 4 * r.length <= 8192 for r in whole)
    assert sum(r.length for r in whole) == sum(r.length for r in rows)


def test_contamination_odd(spark, odd, none):
    items = [("a", "The QUICK brown fox, jumps"), ("b", "lazy dog"), ("b", "lazy dog"), ("c", None), ("d", "..."), ("e", "zzz")]
    frame = spark.createDataFrame(items, "item_id string, text string")
    for block in (1, 500_000):
        rows = decontamination.find_contamination(odd, frame, windows_per_block=block).collect()
        assert len(rows) == len(ODD)
        for r in rows:
            fox = bool(r.text) and r.text.startswith("the quick")
            assert (r.n_hit, r.items) == ((7, ["a", "b"]) if fox else (0, []))
            assert r.n_words == (10 if fox else {None: 0, "": 0, "one": 1, "One two": 2, LONG: 60_000}.get(r.text, 0))
    assert decontamination.find_contamination(odd, frame.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.find_contamination(none, frame).count() == 0
    assert decontamination.decontaminated(spark, odd, frame).columns == odd.columns


def test_quality_odd(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (6, None), (7, 0), (None, 1), (4, 1), (4, 0)], "doc_id bigint, quality int")
    model = line_crf.train(odd, labels)
    rows = line_crf.score(odd, model, with_lines=True).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.bad_lines == [] for r in rows if not (r.text or "").strip())
    assert line_crf.score(none, model).count() == 0
    assert line_crf.train(none, labels.limit(0)).constant == 0.5


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(0)
    emission, stay, first = rng.standard_normal(7), np.array([0.7, -0.4]), np.array([0, 4, 4, 7])
    got = line_crf._marginals(emission, stay, first)[0]
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        weight, bad = 0.0, np.zeros(n)
        for code in range(2**n):
            y = [(code >> k) & 1 for k in range(n)]
            s = sum(emission[a + k] * y[k] for k in range(n)) + sum(stay[y[k]] for k in range(n - 1) if y[k] == y[k + 1])
            weight += np.exp(s)
            bad += np.exp(s) * np.array(y)
        assert np.allclose(got[a:b], bad / weight)


def test_language_model_odd(spark, odd, none):
    model = kneser_ney.train(odd, parts=4)
    rows = kneser_ney.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(np.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if not r.text} == {1}
    assert kneser_ney.score(none, model).count() == 0
    empty = kneser_ney.score(odd, kneser_ney.train(none, parts=4)).collect()
    assert all(r.n_known == 0 and r.score == 0 for r in empty)


def test_chat_layouts(spark):
    records = [
        (1, '{"messages":[{"role":"user","content":"a <|im_end|>"},{"role":"assistant","content":"b\\\\|"}],"id":7}'),
        (2, '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"r"}],"system":"s"}'),
        (3, '{"instruction":"i","input":"","output":"o"}'),
        (4, '{"prompt":"p","completion":"c"}'),
        (5, '{"other":1}'),
        (6, "no json"),
        (7, None),
    ]
    frame = spark.createDataFrame(records, "id bigint, record string")
    turns = chat_format.turns_of_records(frame, "id", "record")
    got: dict = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        got.setdefault((r.conv_id, r.layout), []).append((r.role, r.text))
    assert got[1, "messages"] == [("user", "a <|im_end|>"), ("assistant", "b\\|")]
    assert got[2, "from_value"] == [("system", "s"), ("user", "q"), ("assistant", "r")]
    assert got[3, "instruction"] == [("user", "i"), ("assistant", "o")]
    assert got[4, "completion"] == [("user", "p"), ("assistant", "c")]
    assert all((k, None) in got for k in (5, 6, 7))


def test_records_without_a_layout_fail_where_none_may_be_lost(spark):
    for record in ("{not json", '{"other": 1}', None):
        rows = spark.createDataFrame([(1, record), (2, '{"prompt": "a", "completion": "b"}')], "conv_id bigint, record string")
        with pytest.raises(Exception, match="record without a known layout: 1"):
            chat_format.turns_of_records(rows, "conv_id", "record", strict=True).collect()
        kept = chat_format.turns_of_records(rows, "conv_id", "record").collect()
        assert [(r.conv_id, r.layout) for r in sorted(kept, key=lambda r: (r.conv_id, r.turn or 0))][0] == (1, None)


def test_chat_layouts_by_required_paths(spark):
    records = [
        (1, '{"messages":[{"content":"a"},{"role":"assistant","content":"b"}],"prompt":"p","system":"s"}'),
        (2, '{"prompt":"p","completion":"c","input":"more"}'),
        (3, '{"turn":5,"role":"Human","text":"<|im_end|>"}'),
        (3, '{"turn":null,"role":null,"text":null}'),
        (4, '{"instruction":"i","output":"o","system":"s","prompt":"p","completion":"c"}'),
        (5, '{"prompt":"p"}'),
        (6, '{"messages":[]}'),
    ]
    turns = chat_format.turns_of_records(spark.createDataFrame(records, "id bigint, record string"), "id", "record")
    got = sorted(((r.conv_id, r.layout, r.turn, r.role, r.text) for r in turns.collect()), key=str)
    assert got == sorted(
        [
            (1, "messages", 0, "system", "s"),
            (1, "messages", 1, "", "a"),
            (1, "messages", 2, "assistant", "b"),
            (2, "completion", 0, "user", "p"),
            (2, "completion", 1, "assistant", "c"),
            (3, "row", 5, "Human", "<|im_end|>"),
            (3, "row", None, "", ""),
            (4, "instruction", 0, "system", "s"),
            (4, "instruction", 1, "user", "i"),
            (4, "instruction", 2, "assistant", "o"),
            (5, None, None, None, None),
            (6, None, None, None, None),
        ],
        key=str,
    )


def test_chat_layouts_of_all_fingerprints(spark):
    def plain(paths):
        fit = []
        for k, known in enumerate(chat_format.LAYOUTS):
            must = set(known.required())
            if must <= paths:
                fit.append((len(paths & (must | set(known.optional))), -k, known.name))
        return max(fit)[2] if fit else None

    found = {r.fingerprint: r.layout for r in chat_format.known_fingerprints(spark).collect()}
    names = chat_format.PATHS
    for number in range(1 << len(names)):
        paths = [p for k, p in enumerate(names) if number >> k & 1]
        assert found.pop(hashlib.sha256(",".join(paths).encode()).hexdigest(), None) == plain(set(paths))
    assert not found


def test_chat_fingerprints_choose_the_mapping(spark):
    records = [(1, '{"prompt":"p","completion":"c"}'), (2, '{"completion":null,"x":{"y":1},"prompt":"q"}'), (3, "[1]")]
    records += [(k, '{"turn":1,"role":"user","text":"t"}') for k in range(4, 60)]
    turns = chat_format.turns_of_records(spark.createDataFrame(records, "id bigint, record string"), "id", "record")
    plan = turns._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" in plan and "Join LeftOuter, (fingerprint" in plan
    rows = turns.collect()
    known = {r.fingerprint for r in rows if r.conv_id in (1, 2)}
    assert known == {hashlib.sha256(b"prompt,completion").hexdigest()}
    assert {(r.layout, r.fingerprint) for r in rows if r.conv_id > 3} == {("row", hashlib.sha256(b"role,text,turn").hexdigest())}
    assert [(r.layout, r.fingerprint) for r in rows if r.conv_id == 3] == [(None, hashlib.sha256(b"").hexdigest())]


def test_chat_round_trip(spark):
    rng = random.Random(5)
    pieces = ["<|", "|>", "<|im_end|>", "<|im_start|>", "<|im_sep|>", "\\", "\\\\", "\n", "é", "<", "|", "a", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "we<|ird\\\n", None]), "".join(rng.choices(pieces, k=9)) or None) for c in range(30) for t in range(rng.randint(1, 5))]
    rows += [(None, None, None, None), (40, 1, "assistant", "x"), (40, 1, "assistant", "x")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = chat_format.format_conversations(frame.selectExpr("*", "'x' as piece", "1 as at"))
    read = made.select("conv_id", chat_format.read_turns(made.formatted).alias("t"), chat_format.loss_text(made.formatted, made.loss).alias("l"))
    for r in read.collect():
        own = sorted((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == r.conv_id)
        assert [(t.role, t.text) for t in r.t] == [o[1:] for o in own]
        assert r.l == "".join(o[2] for o in own if o[1] == "assistant")
    assert chat_format.digests(chat_format.format_conversations(frame.limit(0))).count() == 0


def test_licenses(spark):
    rows = [
        (1, "repo/LICENSE", "Licensed under the Apache License, Version 2.0."),
        (2, "repo/src/a.py", "x = 1\n# Released under the MIT License.\ny"),
        (3, "repo/src/b.py", "plain"),
        (4, "repo/docs/deep/c.md", None),
        (5, "other/d.md", "no words of that kind"),
        (6, None, "This work is licensed under the GNU General Public License, version 3."),
        (6, None, "This work is licensed under the GNU General Public License, version 3."),
        (7, "repo/src/e.py", "The licence of this poem is its own affair and nobody else's business at all."),
    ]
    got = {r.file_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "file_id bigint, path string, text string")).collect()}
    assert (got[1].license, got[2].license, got[6].license) == ("Apache-2.0", "MIT", "GPL-3.0")
    assert (got[3].license, got[3].origin, got[3].source_dir) == ("MIT", "inherited", "repo/src")
    assert (got[4].license, got[4].origin, got[4].source_dir) == ("Apache-2.0", "inherited", "repo")
    assert got[5].origin == "none" and got[7].origin == "inherited"
    assert license_scan.scan_licenses(spark.createDataFrame([], "file_id bigint, path string, text string")).count() == 0


FILE = "file_id bigint, path string, text string, key string, license string"


def test_licenses_of_wrapped_inline_and_whole_texts(spark):
    full = dict()
    for name, text in license_scan.TEMPLATES:
        full[name] = max(full.get(name, ""), text, key=len)
    gpl2 = (
        "# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
        "# the Free Software Foundation; either version 2 of the License, or\n# (at your option) any later version.\n#\nimport os"
    )
    mit = "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + textwrap.fill(full["MIT"], 60)
    html = license_scan.visible_lines("h")
    pages = spark.createDataFrame([("<p>Licensed under <a href='x'>CC BY 4.0</a></p><p>other<br/>words</p>",)], "h string")
    page = pages.select(html.alias("t")).first().t
    rows = [
        (1, "a/x.py", gpl2),
        (2, "b/x.py", gpl2.replace("software;", "software:").replace("Foundation;", "Foundation,").replace("version 2", "version 3")),
        (3, "c/LICENSE", mit),
        (4, "d/LICENSE.txt", "Copyright 2020\n\n" + textwrap.fill(full["BSD-3-Clause"], 50)),
        (5, "e/COPYING", "Copyright 2020\n\n" + textwrap.fill(full["BSD-2-Clause"], 50)),
        (6, "f/x.html", page),
        (7, "c/src/deep/a.c", "int x;"),
        (8, "LICENSE", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\nmore"),
        (9, "g/h/i.c", ""),
        (10, "i.c", None),
        (11, "c/y.js", "/*\n * " + full["Apache-2.0"][:30] + "\n */"),
        (12, "z/long.txt", "plain words " * 60_000 + "\nReleased under the MIT License.\n"),
    ]
    got = {r.file_id: r for r in license_scan.scan_licenses(spark.createDataFrame([(*r, "k", "l") for r in rows], FILE)).collect()}
    assert [got[k].license for k in range(1, 7)] == ["GPL-2.0", "GPL-3.0", "MIT", "BSD-3-Clause", "BSD-2-Clause", "CC-BY-4.0"]
    assert all(got[k].origin == "own" for k in (1, 2, 3, 4, 5, 6, 8, 12))
    assert (got[7].license, got[7].source_dir) == ("MIT", "c")
    assert got[8].license == "GPL-2.0" and got[12].license == "MIT"
    for k in (9, 10):
        assert (got[k].license, got[k].origin, got[k].source_dir) == ("GPL-2.0", "inherited", "")


def test_license_paths_of_addresses(spark):
    urls = ["http://a.b/c/d.html?x=1", "https://host", "host#top", "", None, "http://h/"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    paths = [r.p for r in frame.select(license_scan.url_path("u").alias("p")).collect()]
    assert paths == ["a.b/c/d.html", "host/", "host/", None, None, "h/"]


def test_license_cosines_by_a_loop(spark):
    rng = random.Random(3)
    words = "license version software mit gnu public terms of the under 2 3 4.0 free copy permission".split()
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(120)] + [t for _, t in license_scan.TEMPLATES[:4]] * 2
    rows = [(k, f"d{k % 9}/f{k}", t) for k, t in enumerate(texts)]
    found = license_scan.headers(spark.createDataFrame(rows, "file_id bigint, path string, text string")).cache()

    def terms(text):
        return Counter(regex.findall(license_scan.TERM, text.lower()))

    listed = [r.header for r in found.collect()]
    df = Counter(t for h in listed for t in terms(h))

    def vector(text):
        tf = {t: n * (math.log((1 + len(listed)) / (1 + df[t])) + 1) for t, n in terms(text).items()}
        norm = math.sqrt(sum(w * w for w in tf.values()))
        return {t: w / norm for t, w in tf.items()}

    known = [(name, vector(t)) for name, t in license_scan.TEMPLATES]
    want = {}
    for h in set(listed):
        v = vector(h)
        best = min((-round(sum(w * u.get(t, 0) for t, w in v.items()), 6), name) for name, u in known)
        if -best[0] >= 0.3:
            want[hashlib.sha256(h.encode()).digest()] = (best[1], -best[0])
    got = {bytes(r.key): (r.license, round(r.cosine, 6)) for r in license_scan.header_licenses(found, spark, 0.3).collect()}
    assert got.keys() == want.keys() and len(got) > 20
    assert all(abs(got[k][1] - want[k][1]) < 2e-6 for k in got)
    assert sum(got[k][0] != want[k][0] for k in got) == 0
