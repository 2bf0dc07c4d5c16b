"""Secrets in texts, also below layers of URL, Unicode, base64 and compressed encoding.

Each text is the first layer of a worklist.  A layer is scanned for secrets and
searched for encoded segments.  URL and Unicode escapes are decoded in place, which
gives the whole text anew; a base64 segment that decodes becomes a layer of its own.
New layers are scanned in turn, until no layer gives another.  Every character of a layer
carries the span of the original text it comes from, so a secret found at any
depth is reported where its encoded form stands in the original.  A layer seen
before at the same place is not opened again, which ends cycles.

Bytes that are not UTF-8 are read byte by byte, and as units of two bytes, whole: what stands before,
between or behind bytes that are no text is searched too.  Base64 of fewer than 16
characters holds nothing long enough and is not decoded; behind a part of a path or
name (which shifts the bytes) base64 is taken up where it begins as text or a stream does.

Compressed streams are unpacked in pieces and searched whole, window by window.
A window ends where nothing can be cut in two, so it may grow to the length of the
longest encoded segment, or of a line of escapes, in the stream.

Defined results: a null text is an empty one and has no spans; empty tables give
empty results; repeated rows are scanned on their own; other columns stay.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate, chain
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Gives the same pieces of bytes from the start each time it is called.
Chunks = Callable[[], Iterator[bytes]]

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run this long is the whole run, as the pattern is greedy and has one class.
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

URL_PART = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_PART = re.compile(
    r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}"
    r"|%u([0-9A-Fa-f]{4})|&#([0-9]{1,7});|&(quot|apos|amp|lt|gt);"
)
NAMED_CHARACTERS = {"quot": '"', "apos": "'", "amp": "&", "lt": "<", "gt": ">"}
UNICODE_SIGNS = ("\\u", "\\x", "\\U", "%u", "&")
# Runs in which bytes may stand, some of them escaped.
URL_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9._~/+-])+")
ESCAPED_BYTES = re.compile(r"""(?:\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|\\[abfnrtv0\\'"/]|[\x20-\x5b\x5d-\x7e])+""")
# One byte of them: two digits, a letter after a backslash, or itself.
URL_BYTE = re.compile(r"%([0-9A-Fa-f]{2})()()|(.)")
ESCAPED_BYTE = re.compile(r"\\x([0-9A-Fa-f]{2})|\\u00([0-9A-Fa-f]{2})|\\(.)|(.)")
NAMED_BYTES = dict(zip("abfnrtv0", "\a\b\f\n\r\t\v\0", strict=True))
BASE64_SEGMENT = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Base64 over several lines; line breaks may be escaped.
BREAK = r"[ \t]*(?:\r\n|\n|\r|(?:\\r)?\\n)[ \t]*"
BASE64_LINES = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{16,}}+(?:{BREAK}[A-Za-z0-9+/_-]++)+={{0,2}}")
BASE64_LINE = re.compile(rf"(?:^|{BREAK})([A-Za-z0-9+/_-]+)")
STREAM_START = re.compile(rb"\x1f\x8b\x08|[\x08\x18\x28\x38\x48\x58\x68\x78]", re.DOTALL)

# Characters that may go on in the next line, and those that are in no secret and no segment.
JOINED = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=;-")
APART = re.compile(r"""[^A-Za-z0-9+/_=;:"'.\s(\\%&#-]""")

# Characters of a stream that are searched at a time.
WINDOW = 4 << 20
# Bytes that go into an unpacking step, and that come out of it, at a time.
PIECE, CHUNK = 4 << 10, 256 << 10
# Fewer bytes of text inside others are taken for chance.
LEAST_TEXT = 12
# The shortest run that a secret, or what holds one, has: 16 characters, here of one byte or of two.
PRINTED = re.compile(rb"[\t\n\r\x20-\x7e]{16}")
PRINTED_LITTLE = re.compile(rb"(?:[\t\n\r\x20-\x7e]\0){16}")
PRINTED_BIG = re.compile(rb"(?:\0[\t\n\r\x20-\x7e]){16}")
CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


@dataclass
class Place:
    """Where runs of a layer's characters stand in the layer above: as one span, or character by character."""

    at: list[int]
    runs: list[tuple[int, int, bool]]
    above: Place | None = None

    def original(self, start: int, end: int) -> tuple[int, int]:
        """The smallest original span that covers these characters."""
        here: Place | None = self
        while here is not None:
            first, last = bisect_right(here.at, start) - 1, bisect_right(here.at, end - 1) - 1
            a, _, each = here.runs[first]
            begin, b, all_of = here.runs[last]
            start, end = a + (start - here.at[first] if each else 0), begin + end - here.at[last] if all_of else b
            here = here.above
        return start, end


@dataclass
class Layer:
    """A text and the place of its characters; the original has none."""

    text: str
    place: Place | None = None

    def original(self, start: int, end: int) -> tuple[int, int]:
        return self.place.original(start, end) if self.place else (start, end)


def _assigned(text: str) -> Iterator[tuple[int, int]]:
    """Spans of assignments; what follows a name with too short a value is tried as a name itself."""
    here = 0
    while m := ASSIGN.search(text, here):
        if len(m[2]) >= 12:
            yield m.span()
        here = m.end() if len(m[2]) >= 12 else m.start(2)


def scan(text: str, below: bool = False) -> list[tuple[str, int, int]]:
    """Secrets of one layer as (kind, start, end)."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans = _assigned(text) if below else (m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 12)
        found += [("assign", *span) for span in spans]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


@dataclass
class Packed:
    """Bytes that a compressed stream holds, and the original span of that stream."""

    chunks: Chunks
    span: tuple[int, int]


def _readable(data: bytes) -> str | None:
    """The bytes as text if they are text: UTF-8 with next to no control characters."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and _odd(text) * 20 <= len(text) else None


def _odd(text: str) -> int:
    return len(CONTROL.findall(text))


def _texts(data: bytes) -> Iterator[tuple[str, int, int | None]]:
    """The bytes as text, all of them: UTF-8 if they are that, else byte by byte, and as units of two bytes.

    With the bytes skipped before the text and the bytes of a character (``None``: as UTF-8 has it).
    Bytes that are not UTF-8 are left out only if they lack a run long enough for any secret
    or anything that could be decoded further.
    """
    text = _readable(data)
    if text is not None:
        yield text, 0, None
        return
    if PRINTED.search(data):
        yield data.decode("latin-1"), 0, 1
    for order, form in (("<u2", PRINTED_LITTLE), (">u2", PRINTED_BIG)):
        for skip in sorted({m.start() % 2 for m in form.finditer(data)}):
            units = np.frombuffer(data, order, (len(data) - skip) // 2, skip)
            yield "".join(chr(u) if not 0xD800 <= u < 0xE000 else "\ufffd" for u in units.tolist()), skip, 2


def _bad(data: bytes) -> int | None:
    """Where the bytes cease to be UTF-8."""
    try:
        data.decode("utf-8")
    except UnicodeDecodeError as e:
        return e.start
    return None


def _pieces(data: bytes | memoryview) -> Iterator[bytes]:
    for k in range(0, len(data), PIECE):
        yield bytes(data[k : k + PIECE])


def _kind(head: bytes) -> int | None:
    """The ``wbits`` of the gzip or zlib stream that begins here, by its header."""
    if head[:3] == b"\x1f\x8b\x08":
        return 31
    zlib_head = len(head) > 1 and head[0] & 15 == 8 and head[0] < 128 and (head[0] << 8 | head[1]) % 31 == 0 and not head[1] & 32
    return 15 if zlib_head else None


def _inflate(chunks: Iterator[bytes], wbits: int) -> Iterator[bytes]:
    """Contents of all members of a stream, as far as it is whole, then what follows it as it is."""
    engine, data = zlib.decompressobj(wbits), b""
    for piece in chain(chunks, (None,)):
        data += piece or b""
        while True:
            if engine is None:
                yield data
                data = b""
                break
            if engine.eof:
                data = data.lstrip(b"\0")
                if not data or (len(data) < 3 and piece is not None):
                    break
                # The next member, or other bytes from here on.
                kind = _kind(data)
                engine = zlib.decompressobj(kind) if kind else None
                if engine is None:
                    yield b"\n"
                continue
            try:
                out = engine.decompress(data, CHUNK)
            except zlib.error:
                return
            if out:
                yield out
            data = engine.unused_data if engine.eof else engine.unconsumed_tail
            if not engine.eof and not data and len(out) < CHUNK:
                break


def _streamed(chunks: Iterator[bytes], start: Callable) -> Iterator[bytes]:
    """Contents of all members of a bzip2 or xz stream, as far as it is whole."""
    engine = start()
    for piece in chunks:
        data = piece
        while True:
            try:
                out = engine.decompress(data, CHUNK)
            except (OSError, lzma.LZMAError):
                return
            data = b""
            if out:
                yield out
            if engine.eof:
                data, engine = engine.unused_data.lstrip(b"\0"), start()
                if not data:
                    break
            elif engine.needs_input:
                break


def _opened(chunks: Chunks) -> Chunks | None:
    """What the bytes hold if they are a gzip, zlib, raw deflate, bzip2 or xz stream."""
    head = next(chunks(), b"")
    for sign, start in ((b"BZh", bz2.BZ2Decompressor), (b"\xfd7zXZ\0", lzma.LZMADecompressor)):
        if head.startswith(sign):
            return (lambda: _streamed(chunks(), start)) if next(_streamed(chunks(), start), b"") else None
    kind = _kind(head)
    for wbits in (31, 15, -15):
        if wbits > 0 and wbits != kind:
            continue
        if wbits < 0 and _bad(head) is None:
            return None
        first = next(_inflate(chunks(), wbits), b"")[:4096]
        if first and (wbits > 0 or _kind(first) or _promising(first)):
            return lambda: _inflate(chunks(), wbits)
    return None


def _promising(head: bytes) -> bool:
    """Whether bytes begin as text does."""
    bad = _bad(head[:LEAST_TEXT + 3])
    text = head[: bad if bad is not None else LEAST_TEXT + 3].decode("utf-8", "ignore")
    return len(text) > 8 and _odd(text) * 20 <= len(text)


def _extent(data: memoryview) -> int:
    """How many of the bytes belong to the members of the stream that begins here."""
    here = 0
    while here < len(data):
        engine = zlib.decompressobj(_kind(data[here : here + 3]) or (-15 if not here else 31))
        try:
            for k in range(here, len(data), PIECE):
                rest, out = data[k : k + PIECE], True
                while (rest or out) and not engine.eof:
                    out = len(engine.decompress(rest, CHUNK)) == CHUNK
                    rest = engine.unconsumed_tail
                if engine.eof:
                    break
        except zlib.error:
            return here or len(data)
        if not engine.eof:
            return len(data)
        here = min(len(data), k + PIECE) - len(engine.unused_data)
    return here


def _inside(layer: Layer, m: re.Match, form: re.Pattern) -> Iterator[Packed]:
    """Compressed streams that begin anywhere in partly escaped bytes, unless those are text."""
    parts = list(form.finditer(m[0]))
    raw = "".join(map(_byte, parts)).encode("latin-1")
    if _bad(raw) is None:
        return
    ends, done = [*(p.start() for p in parts), len(m[0])], 0
    for start in dict.fromkeys([0, *(s.start() for s in STREAM_START.finditer(raw))]):
        if start >= done and (start == 0 or _kind(raw[start : start + 3])):
            view = memoryview(raw)[start:]
            if _opened(lambda view=view: _pieces(view)):
                done = start + _extent(view)
                own = raw[start:done]
                found = _opened(lambda own=own: _pieces(own))
                if found:
                    yield Packed(found, layer.original(m.start() + ends[start], m.start() + ends[done]))


def _byte(m: re.Match) -> str:
    code = m[1] or m[2]
    return chr(int(code, 16)) if code else NAMED_BYTES.get(m[3], m[3]) if m[3] else m[4]


def _replaced(layer: Layer, parts: Iterator[tuple[int, int, str]]) -> Layer:
    """The whole layer with the stretches (start, end, text) decoded in place."""
    pieces, at, runs, size, here = [], [], [], 0, 0
    for start, end, text in parts:
        if here < start:
            at.append(size)
            runs.append((here, start, True))
            pieces.append(layer.text[here:start])
            size += start - here
        at.append(size)
        runs.append((start, end, False))
        pieces.append(text)
        size += len(text)
        here = end
    if here < len(layer.text):
        at.append(size)
        runs.append((here, len(layer.text), True))
        pieces.append(layer.text[here:])
    return Layer("".join(pieces), Place(at, runs, layer.place))


def _unquoted(text: str) -> Iterator[tuple[int, int, str]]:
    """Percent-encoded characters and what they stand for."""
    for part in URL_PART.finditer(text):
        raw, pos = unquote_to_bytes(part[0]), part.start()
        try:
            decoded = raw.decode("utf-8")
        except UnicodeDecodeError:
            decoded = raw.decode("latin-1")
            widths = [1] * len(decoded)
        else:
            widths = [len(c.encode()) for c in decoded]
        for c, width in zip(decoded, widths, strict=True):
            yield pos, pos + 3 * width, c
            pos += 3 * width


def _unescaped(text: str) -> Iterator[tuple[int, int, str]]:
    """Unicode escapes and character references and what they stand for."""
    for part in UNICODE_PART.finditer(text):
        if part[8]:
            yield *part.span(), NAMED_CHARACTERS[part[8]]
            continue
        code = int(part[7]) if part[7] else int(next(filter(None, part.groups())), 16)
        yield *part.span(), chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"


def _base64(layer: Layer, start: int, end: int, lines: list[tuple[int, int]]) -> Iterator[Layer | Packed]:
    """What base64 in these lines (start, end) holds, also behind a part that is a path or name."""
    body = "".join(layer.text[a:b] for a, b in lines)
    first = list(accumulate((b - a for a, b in lines), initial=0))
    plain = body.replace("-", "+").replace("_", "/")

    def place(k: int) -> int:
        line = min(bisect_right(first, k), len(lines)) - 1
        return lines[line][0] + k - first[line]

    starts = [0, *(m.end() for m in re.finditer("[/_-]", body) if len(body) - m.end() >= 16)]
    for turn in range(4):
        own = [k for k in starts if k % 4 == turn]
        if not own:
            continue
        size = len(body) - turn
        size -= size % 4 == 1
        data = base64.b64decode(plain[turn : turn + size] + "=" * (-size % 4))
        done = -1
        for k in own:
            byte = (k - turn) // 4 * 3
            head = data[byte : byte + 512]
            if k < done or (k and not (_promising(head) or _kind(head) or _deflated(head))):
                continue
            view = memoryview(data)[byte:]
            texts = list(_texts(bytes(view))) if k == 0 or _promising(head) else []
            if texts and texts[0][2] is None:
                done = k + len(view) * 4 // 3
            else:
                unpacked = _opened(lambda view=view: _pieces(view))
                if unpacked:
                    yield Packed(unpacked, layer.original(start, end))
            for text, byte, each in texts:
                if layer.place and layer.place.above is None and len(layer.place.at) == 1 and not layer.place.runs[0][2]:
                    # Nothing inside a compressed stream has a place of its own.
                    yield Layer(text, layer.place)
                    continue
                at, runs = [], []
                for n, c in enumerate(text):
                    width = each or len(c.encode())
                    a, b = k + byte * 4 // 3, min(len(body), k - (-(byte + width) * 4 // 3))
                    at.append(n)
                    runs.append((place(a), place(b - 1) + 1, False))
                    byte += width
                # A padding stands for the end of the last character.
                if k + -(-byte * 4 // 3) >= len(body):
                    runs[-1] = (runs[-1][0], end, False)
                yield Layer(text, Place(at, runs, layer.place))


def _deflated(head: bytes) -> bool:
    """Whether raw deflate gives text from here."""
    try:
        return _promising(zlib.decompressobj(-15).decompress(head, 64))
    except zlib.error:
        return False


def _cut(text: str) -> int:
    """The last place that no secret and no encoded segment of this layer, or of one decoded in place, can cross; else 0."""
    end = len(text)
    while (end := text.rfind("\n", 0, end)) > 0:
        before = text[max(0, end - 256) : end].rstrip(" \t\r")
        if before and before[-1] not in JOINED:
            return end + 1
    if not any(k in text for k in ("\\", "%", "&")):
        for size in (1 << k for k in range(10, len(text).bit_length() + 1)):
            last = None
            for last in APART.finditer(text, max(0, len(text) - size)):
                pass
            if last:
                return last.end()
    return 0


def _windows(chunks: Iterator[bytes]) -> Iterator[str]:
    """All of the bytes as text, in parts that can be searched on their own; a part grows until it has a place to end."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    held, size, enough = [], 0, WINDOW
    for chunk in chain(chunks, (None,)):
        held.append(decoder.decode(chunk or b"", chunk is None))
        size += len(held[-1])
        if chunk is not None and size < enough:
            continue
        text = "".join(held)
        cut = len(text) if chunk is None else _cut(text)
        if cut:
            yield text[:cut]
        held, size = [text[cut:]], len(text) - cut
        enough = max(WINDOW, 2 * size)


def _unpacked(packed: Packed) -> Iterator[Layer | Packed]:
    """The bytes of a stream as text, and what they hold if they are a stream themselves."""
    for text in _windows(packed.chunks()):
        yield Layer(text, Place([0], [(*packed.span, False)]))
    deeper = _opened(packed.chunks)
    if deeper:
        yield Packed(deeper, packed.span)


def layers_below(layer: Layer | Packed) -> Iterator[Layer | Packed]:
    """All layers that one decoding step opens."""
    if isinstance(layer, Packed):
        yield from _unpacked(layer)
        return
    text = layer.text
    # In place over the whole layer: a name, its separator and its value need not be escaped alike.
    if "%" in text and URL_PART.search(text):
        yield _replaced(layer, _unquoted(text))
        for m in URL_BYTES.finditer(text):
            if "%" in m[0]:
                yield from _inside(layer, m, URL_BYTE)
    if any(k in text for k in UNICODE_SIGNS) and UNICODE_PART.search(text):
        yield _replaced(layer, _unescaped(text))
        for m in ESCAPED_BYTES.finditer(text):
            if "\\x" in m[0] or "\\u00" in m[0]:
                yield from _inside(layer, m, ESCAPED_BYTE)
    for m in BASE64_SEGMENT.finditer(text):
        yield from _base64(layer, *m.span(), [(m.start(), m.start() + len(m[0].rstrip("=")))])
    for m in BASE64_LINES.finditer(text):
        lines = [(m.start() + line.start(1), m.start() + line.end(1)) for line in BASE64_LINE.finditer(m[0])]
        yield from _base64(layer, *m.span(), lines)


def _digest(layer: Layer | Packed) -> bytes:
    digest = hashlib.sha256(b"" if isinstance(layer, Packed) else layer.text.encode("utf-8", "replace"))
    if isinstance(layer, Packed):
        for chunk in layer.chunks():
            digest.update(chunk)
    return digest.digest()


def find_secrets(text: str) -> tuple[list[tuple[int, int, int]], set[tuple[int, int, int]]]:
    """Secrets of the text itself, and those of all layers, as (start, kind number, end)."""
    order = {k: i for i, k in enumerate(KINDS)}
    base = [(a, order[kind], b) for kind, a, b in scan(text)]
    found = set(base)
    # Layers are opened when their turn comes, so few are held at a time.
    todo, seen = [layers_below(Layer(text))], set()
    while todo:
        layer = next(todo[-1], None)
        if layer is None:
            todo.pop()
            continue
        packed = isinstance(layer, Packed)
        key = (packed, _digest(layer), layer.span if packed else layer.original(0, len(layer.text) or 1))
        if key in seen:
            continue
        seen.add(key)
        for kind, a, b in () if packed else scan(layer.text, below=True):
            start, end = layer.original(a, b)
            found.add((start, order[kind], end))
        todo.append(layers_below(layer))
    return base, found


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


RESULT = T.StructType(
    [
        T.StructField("n_assign", T.LongType()),
        T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()),
        T.StructField("base_spans", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with its secrets: counts and spans of the text itself, and ``spans`` of all layers.

    Columns of the input that have the name of a result are replaced.
    """
    names = [f.name for f in RESULT]
    keep = [c for c in docs.columns if c not in names]
    ordered = docs.select(*keep)
    schema = T.StructType([*ordered.schema.fields, *RESULT.fields])

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(batch.schema.get_field_index(text)):
                base, found = find_secrets(value.as_py() or "")
                counts = [sum(1 for s in base if s[1] == k) for k in range(3)]
                rows.append((*counts, _joined(base), _joined(found)))
            added = [pa.array([r[k] for r in rows], pa.int64() if k < 3 else pa.string()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    return ordered.mapInArrow(process, schema)


def redacted(text: str, spans: str, mark: str = "[REDACTED]") -> str:
    """The text with all spans, as :func:`scan_secrets` gives them, replaced; overlapping ones become one mark."""
    cuts = sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in spans.split(",") if s))
    out, here = [], 0
    for a, b in cuts:
        if a >= here:
            out += [text[here:a], mark]
        here = max(here, b)
    return "".join([*out, text[here:]])


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """The same rows and columns with every secret's span, at any depth, replaced; a null text stays null."""

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for value in batch.column(at).to_pylist():
                found = find_secrets(value)[1] if value else ()
                out.append(redacted(value, _joined(found), mark) if found else value)
            columns = list(batch.columns)
            columns[at] = pa.array(out, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(process, docs.schema)
