"""Token ids of whole texts with a public tokenizer.

Most time of a byte-pair tokenizer goes into merging the same words again and
again.  A byte-level tokenizer whose pattern puts a space in front of the word
it precedes never joins across `` x`` with a non-space before it, so a text may
be cut there: the pieces' ids in a row are the text's ids.  Every distinct
piece is encoded once by the library, all others look its ids up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .text import Hasher, slices, utf8

# First bytes of the UTF-8 forms of all white space beyond ASCII.
_WIDE_SPACE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
_MAX_CACHED = 1_300_000
_JOINED_BYTES = 1 << 15


def default_tokenizer() -> str:
    """The file of the byte-level tokenizer with 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where a piece begins: text starts and single spaces between other characters."""
    begins = np.zeros(len(data), bool)
    if len(data) > 2:
        plain = data > 0x20
        after = plain[2:] & ~_WIDE_SPACE[data[2:]]
        before = plain[:-2].copy()
        before[1:] &= data[:-3] != 0xC2
        before[2:] &= ~_WIDE_SPACE[data[:-4]]
        begins[1:-1] = (data[1:-1] == 0x20) & before & after
    starts = offsets[:-1][np.diff(offsets) > 0]
    lasts = offsets[1:][np.diff(offsets) > 0] - 1
    begins[lasts] = False
    begins[starts] = True
    return np.flatnonzero(begins)


class Encoder:
    """Ids of batches of texts; make one with :func:`encoder`.  Null counts as an empty text."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._hasher = Hasher()
        # How many bytes of text each id stands for; an added token's content is its text.
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self._width[i] = len(token)
        self._clear()

    def _clear(self) -> None:
        # Hashes of known pieces, ascending, and the number of each piece, in the order they were met.
        self._hashes = np.zeros(0, np.uint64)
        self._numbers = np.zeros(0, np.int32)
        self._ids = np.zeros(1 << 16, np.uint32)
        self._ends = np.zeros(1 << 16, np.int64)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and number of ids of pieces that may stand in a row, encoded as texts of many pieces.

        An id stands for a fixed number of bytes, so the pieces' bounds show in the ids.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        cuts = np.searchsorted(ends, np.arange(0, ends[-1], _JOINED_BYTES), "right")
        bounds = [*np.unique(cuts).tolist(), len(pieces)]
        texts = [b"".join(pieces[a:b]).decode() for a, b in zip(bounds, bounds[1:], strict=False) if b > a]
        # One by one: what the library keeps of a text takes many times its size.
        ids = np.concatenate([np.array(i, np.uint32) for text in texts for i in self._encoded([text])])
        last = np.searchsorted(np.cumsum(self._width[ids]), ends)
        return ids, np.diff(last + 1, prepend=0)

    def _add(self, hashes: np.ndarray, pieces: list[bytes], joinable: np.ndarray) -> None:
        """Learn new pieces, ascending by hash; ``joinable`` ones begin with a cut and end before one."""
        if not pieces:
            return
        ids, lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        order = np.argsort(~joinable, kind="stable")
        n = int(joinable.sum())
        if n:
            try:
                ids, lengths = self._joined([pieces[i] for i in order[:n]])
            except UnicodeDecodeError:  # bytes that are no text are replaced one piece at a time
                n = 0
        alone = self._encoded([pieces[i].decode("utf-8", "replace") for i in order[n:]])
        ids = np.concatenate([ids, *[np.array(i, np.uint32) for i in alone]])
        lengths = np.append(lengths, np.fromiter(map(len, alone), np.int64, len(alone)))
        first = len(self._hashes)
        used = int(self._ends[first - 1]) if first else 0
        total = used + len(ids)
        while len(self._ids) < total:
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while len(self._ends) < first + len(pieces):
            self._ends = np.concatenate([self._ends, np.zeros_like(self._ends)])
        self._ids[used:total] = ids
        self._ends[first : first + len(pieces)] = used + np.cumsum(lengths)
        numbers = np.zeros(len(pieces), np.int32)
        numbers[order] = first + np.arange(len(pieces))
        place = np.searchsorted(self._hashes, hashes)
        self._hashes, self._numbers = np.insert(self._hashes, place, hashes), np.insert(self._numbers, place, numbers)

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self._hashes) > _MAX_CACHED:
            self._clear()
        start = _cuts(data, offsets)
        end = np.append(start[1:], len(data))
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        # A piece between two cuts of one text may stand next to any other such piece.
        inner = np.ones(len(start), bool)
        filled = np.diff(offsets) > 0
        inner[np.searchsorted(start, offsets[:-1][filled])] = False
        inner[np.searchsorted(end, offsets[1:][filled])] = False
        distinct, sample, inverse = np.unique(
            self._hasher.spans(data, start, end), return_index=True, return_inverse=True
        )
        found = np.searchsorted(self._hashes, distinct, "right") > np.searchsorted(self._hashes, distinct)
        new = np.flatnonzero(~found)
        raw = data.tobytes()
        spans = zip(start[sample[new]].tolist(), end[sample[new]].tolist(), strict=True)
        self._add(distinct[new], [raw[a:b] for a, b in spans], inner[sample[new]])
        index = self._numbers[np.searchsorted(self._hashes, distinct)][inverse].astype(np.int64)
        begin = np.where(index > 0, self._ends[index - 1], 0)
        length = self._ends[index] - begin
        sums = np.cumsum(length)
        place = np.repeat(begin - (sums - length), length) + np.arange(sums[-1])
        bounds = np.append(0, sums)[np.searchsorted(start, offsets)]
        return self._ids[place], np.diff(bounds)

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each row, made a slice at a time."""
        data, offsets = utf8(column)
        for a, b in slices(offsets):
            ids, counts = self._slice(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield from np.split(ids, np.cumsum(counts)[:-1])


def encoder(path: str) -> Encoder:
    """The encoder of this process: pieces met in earlier tasks are still known.

    Functions reach the workers by value, without the state of their module, so it
    is kept at the library's module.
    """
    import tokenizers

    made = tokenizers.__dict__.setdefault("_encoders_by_path", {})
    if path not in made:
        made[path] = Encoder(path)
    return made[path]
