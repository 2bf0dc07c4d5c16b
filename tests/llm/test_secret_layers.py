"""Secrets among bytes that are no text, in streams of other kinds and under other escapes, with their spans."""

import base64
import bz2
import lzma
import random
from urllib.parse import quote

import pytest

from ledgerloom.llm import secret_scan, token_output

SECRET = "password=hunter2hunter2AB"


def spans(text):
    _, found = secret_scan.find_secrets(text)
    return {(secret_scan.KINDS[k], text[a:b]) for a, k, b in found}


def encoded(data):
    return base64.b64encode(data).decode()


@pytest.mark.parametrize(
    "data",
    [
        f"clé {SECRET}".encode("latin-1"),
        b"\0\1\2\3" + SECRET.encode(),
        b"\xff\xfe\xfd" + SECRET.encode(),
        SECRET.encode() + b"\xff" * 40 + b" AKIA" + b"Q" * 20,
        SECRET.encode("utf-16"),
        SECRET.encode("utf-16-be"),
        b"\xff" + SECRET.encode("utf-16-le"),
        bz2.compress(SECRET.encode()),
        bz2.compress(b"x" * 100) + bz2.compress(SECRET.encode()),
        lzma.compress(SECRET.encode()),
        lzma.compress(bz2.compress(encoded(b"\xff" + SECRET.encode()).encode())),
    ],
)
def test_bytes_of_any_kind(data):
    whole = encoded(data)
    found = spans(f"see {whole} here")
    assert any(kind == "assign" and part in whole and len(part) > 20 for kind, part in found)


def test_spans_among_noise_are_narrow():
    whole = encoded(b"\xff" * 30 + SECRET.encode() + b"\xff" * 30)
    # Thirty bytes are forty characters; the secret's 25 bytes take 34 at most.
    assert spans(whole) == {("assign", whole[40:74])}


@pytest.mark.parametrize(
    "letter", ["&#X70;", "&#112;", "&#x70;", "\\U00000070", "\\u{70}", "%u0070", "\\u0070", "\\x70", "%70"]
)
def test_escaped_letters(letter):
    text = f"a {letter}assword=hunter2hunter2AB b"
    assert ("assign", text[2:-2]) in spans(text)


def test_named_characters():
    assert ("assign", "token&quot;: &quot;abcdefghijkl") in spans("{&quot;token&quot;: &quot;abcdefghijkl&quot;}")


def test_nested_at_random():
    """Any nest of encodings gives the secret, at the place of the whole."""
    rng = random.Random(8)
    steps = [
        lambda b: base64.b64encode(b),
        lambda b: quote(b.decode("latin-1"), safe="").encode(),
        lambda b: base64.b64encode(bz2.compress(b)),
        lambda b: base64.b64encode(lzma.compress(b)),
        lambda b: base64.b64encode(b"\xfe\xff\xfa" + b),
        lambda b: "".join(f"\\u{{{c:x}}}" for c in b).encode(),
        lambda b: base64.b64encode(b.decode("latin-1").encode("utf-16-le")),
    ]
    for _ in range(40):
        data = SECRET.encode()
        for _ in range(rng.randrange(1, 4)):
            data = rng.choice(steps)(data)
        text = f"before {data.decode()} after"
        found = [(a, b) for a, k, b in secret_scan.find_secrets(text)[1] if k == 0]
        assert any(7 <= a < b <= len(text) - 6 for a, b in found), text


def test_ids_too_large_for_the_type_fail(tmp_path):
    import numpy as np

    with open(tmp_path / "shard", "wb") as sink:
        writer = token_output._ShardWriter(sink, 8, np.dtype("uint16"))
        with pytest.raises(OverflowError):
            writer.add(np.array([70_000], np.uint32))
