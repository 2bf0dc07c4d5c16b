"""Address text of public keys and hashes (small per-value helpers for the Arrow functions)."""

from __future__ import annotations

import hashlib
import struct

import numpy as np

# Fixed values of the formats.
BASE58_ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32_ALPHABET = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
MAINNET_KEY_HASH_VERSION = 0
MAINNET_SCRIPT_HASH_VERSION = 5
MAINNET_SEGWIT_PREFIX = "bc"
SECP256K1_PRIME = 2**256 - 2**32 - 977


def sha256d(data: bytes) -> bytes:
    return hashlib.sha256(hashlib.sha256(data).digest()).digest()


def base58check(version: int, payload: bytes) -> str:
    """Version byte, payload and checksum in base 58."""
    body = bytes([version]) + payload
    body += sha256d(body)[:4]
    number = int.from_bytes(body, "big")
    pairs = []
    while number:
        # Ten digits at a time, so that few divisions are of long numbers.
        number, low = divmod(number, _TEN_DIGITS)
        for _ in range(5):
            low, pair = divmod(low, 58 * 58)
            pairs.append(_BASE58_PAIRS[pair])
    zeros = len(body) - len(body.lstrip(b"\0"))
    return BASE58_ALPHABET[0] * zeros + "".join(reversed(pairs)).lstrip(BASE58_ALPHABET[0])


_TEN_DIGITS = 58**10
_BASE58_PAIRS = [a + b for a in BASE58_ALPHABET for b in BASE58_ALPHABET]


def _bech32_factor(top: int) -> int:
    state = 0
    for bit, factor in enumerate(BECH32_GENERATOR):
        if top >> bit & 1:
            state ^= factor
    return state


_BECH32_FACTORS = [_bech32_factor(top) for top in range(32)]


def _bech32_checksum(prefix: str, data: list[int]) -> list[int]:
    expanded = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]
    state = 1
    for value in expanded + data + [0] * 6:
        state = (state & 0x1FFFFFF) << 5 ^ value ^ _BECH32_FACTORS[state >> 25]
    state ^= 1
    return [state >> 5 * (5 - i) & 31 for i in range(6)]


def segwit_address(program: bytes, version: int = 0, prefix: str = MAINNET_SEGWIT_PREFIX) -> str:
    """Bech32 text of a witness program."""
    bits = int.from_bytes(program, "big")
    length = len(program) * 8
    groups = -(-length // 5)
    bits <<= groups * 5 - length
    data = [version] + [bits >> 5 * (groups - 1 - i) & 31 for i in range(groups)]
    return prefix + "1" + "".join(BECH32_ALPHABET[d] for d in data + _bech32_checksum(prefix, data))


def base58check_texts(version: int, payloads: list[bytes]) -> list[str]:
    """As :func:`base58check`, for many payloads of 20 bytes at a time."""
    bodies = [bytes([version]) + p for p in payloads]
    body = b"".join([b + sha256d(b)[:4] for b in bodies])
    # 25 bytes behind three zero bytes are seven numbers of 32 bits, the highest first.
    padded = np.zeros((len(payloads), 28), np.uint8)
    padded[:, 3:] = np.frombuffer(body, np.uint8).reshape(-1, 25)
    limbs = padded.view(">u4").astype(np.uint64).T.copy()
    digits = np.empty((len(payloads), 35), np.uint8)
    for group in range(7, 0, -1):
        # Five digits at a time, the lowest first; the remainder of one limb goes into the next.
        low = np.zeros(len(payloads), np.uint64)
        for limb in limbs:
            limb |= low << np.uint64(32)
            whole = limb // _FIVE_DIGITS
            low = limb - whole * _FIVE_DIGITS
            limb[:] = whole
        low = low.astype(np.uint32)
        for at in range(5 * group - 1, 5 * group - 6, -1):
            rest = low // np.uint32(58)
            digits[:, at] = low - rest * np.uint32(58)
            low = rest
    # Leading digits go, but for one per leading zero byte; neither is all of a body.
    starts = (digits != 0).argmax(axis=1) - (padded[:, 3:] != 0).argmax(axis=1)
    text = _BASE58_CODES[digits].tobytes().decode("ascii")
    return [text[35 * n + start : 35 * n + 35] for n, start in enumerate(starts.tolist())]


_FIVE_DIGITS = np.uint64(58**5)
_BASE58_CODES = np.frombuffer(BASE58_ALPHABET.encode(), np.uint8)


def segwit_addresses(programs: list[bytes], version: int = 0, prefix: str = MAINNET_SEGWIT_PREFIX) -> list[str]:
    """As :func:`segwit_address`, for many programs of one length at a time."""
    size = len(programs[0])
    bits = np.unpackbits(np.frombuffer(b"".join(programs), np.uint8).reshape(-1, size), axis=1)
    groups = -(-size * 8 // 5)
    bits = np.pad(bits, ((0, 0), (0, groups * 5 - size * 8))).reshape(len(programs), groups, 5)
    data = np.empty((len(programs), 1 + groups + 6), np.uint8)
    data[:, 0] = version
    data[:, 1:-6] = bits @ np.array([16, 8, 4, 2, 1], np.uint8)
    data[:, -6:] = 0
    state = np.ones(len(programs), np.uint32)
    for value in [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]:
        state = _bech32_step(state, np.uint32(value))
    for column in data.T.astype(np.uint32):
        state = _bech32_step(state, column)
    state ^= np.uint32(1)
    for i in range(6):
        data[:, i - 6] = state >> np.uint32(5 * (5 - i)) & np.uint32(31)
    text = _BECH32_CODES[data].tobytes().decode("ascii")
    width, head = data.shape[1], prefix + "1"
    return [head + text[at : at + width] for at in range(0, len(text), width)]


def _bech32_step(state: np.ndarray, value: np.ndarray | np.uint32) -> np.ndarray:
    return (state & np.uint32(0x1FFFFFF)) << np.uint32(5) ^ value ^ _BECH32_TABLE[state >> np.uint32(25)]


_BECH32_TABLE = np.array(_BECH32_FACTORS, np.uint32)
_BECH32_CODES = np.frombuffer(BECH32_ALPHABET.encode(), np.uint8)


def is_curve_point(key: bytes) -> bool:
    """Whether bytes encode a point of secp256k1 (compressed, plain or hybrid form)."""
    if not key:
        return False
    kind, p = key[0], SECP256K1_PRIME
    if kind in (2, 3) and len(key) == 33:
        x = int.from_bytes(key[1:], "big")
        square = (pow(x, 3, p) + 7) % p
        return x < p and (square == 0 or pow(square, (p - 1) // 2, p) == 1)
    if kind in (4, 6, 7) and len(key) == 65:
        x, y = int.from_bytes(key[1:33], "big"), int.from_bytes(key[33:], "big")
        on_curve = x < p and y < p and (y * y - pow(x, 3, p) - 7) % p == 0
        return on_curve and (kind == 4 or kind & 1 == y & 1)
    return False


def hash160(data: bytes) -> bytes:
    return _ripemd160(hashlib.sha256(data).digest())


def key_address(key: bytes) -> str:
    """Address of a public key that is a curve point; the hybrid form counts as the plain one."""
    if key[0] in (6, 7):
        key = b"\4" + key[1:]
    return base58check(MAINNET_KEY_HASH_VERSION, hash160(key))


# Fixed values of RIPEMD-160: word order, rotation and constant of the five rounds on both lines.
_LEFT_WORDS = (
    (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15),
    (7, 4, 13, 1, 10, 6, 15, 3, 12, 0, 9, 5, 2, 14, 11, 8),
    (3, 10, 14, 4, 9, 15, 8, 1, 2, 7, 0, 6, 13, 11, 5, 12),
    (1, 9, 11, 10, 0, 8, 12, 4, 13, 3, 7, 15, 14, 5, 6, 2),
    (4, 0, 5, 9, 7, 12, 2, 10, 14, 1, 3, 8, 11, 6, 15, 13),
)
_RIGHT_WORDS = (
    (5, 14, 7, 0, 9, 2, 11, 4, 13, 6, 15, 8, 1, 10, 3, 12),
    (6, 11, 3, 7, 0, 13, 5, 10, 14, 15, 8, 12, 4, 9, 1, 2),
    (15, 5, 1, 3, 7, 14, 6, 9, 11, 8, 12, 2, 10, 0, 4, 13),
    (8, 6, 4, 1, 3, 11, 15, 0, 5, 12, 2, 13, 9, 7, 10, 14),
    (12, 15, 10, 4, 1, 5, 8, 7, 6, 2, 13, 14, 0, 3, 9, 11),
)
_LEFT_TURNS = (
    (11, 14, 15, 12, 5, 8, 7, 9, 11, 13, 14, 15, 6, 7, 9, 8),
    (7, 6, 8, 13, 11, 9, 7, 15, 7, 12, 15, 9, 11, 7, 13, 12),
    (11, 13, 6, 7, 14, 9, 13, 15, 14, 8, 13, 6, 5, 12, 7, 5),
    (11, 12, 14, 15, 14, 15, 9, 8, 9, 14, 5, 6, 8, 6, 5, 12),
    (9, 15, 5, 11, 6, 8, 13, 12, 5, 12, 13, 14, 11, 8, 5, 6),
)
_RIGHT_TURNS = (
    (8, 9, 9, 11, 13, 15, 15, 5, 7, 7, 8, 11, 14, 14, 12, 6),
    (9, 13, 15, 7, 12, 8, 9, 11, 7, 7, 12, 7, 6, 15, 13, 11),
    (9, 7, 15, 11, 8, 6, 6, 14, 12, 13, 5, 14, 13, 13, 7, 5),
    (15, 5, 8, 11, 14, 14, 6, 14, 6, 9, 12, 9, 12, 5, 15, 8),
    (8, 5, 12, 9, 12, 5, 14, 6, 8, 13, 6, 5, 15, 13, 11, 11),
)
_LEFT_ADD = (0x00000000, 0x5A827999, 0x6ED9EBA1, 0x8F1BBCDC, 0xA953FD4E)
_RIGHT_ADD = (0x50A28BE6, 0x5C4DD124, 0x6D703EF3, 0x7A6D76E9, 0x00000000)
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476, 0xC3D2E1F0)
_MIX = (
    lambda x, y, z: x ^ y ^ z,
    lambda x, y, z: (x & y) | (~x & z),
    lambda x, y, z: (x | ~y) ^ z,
    lambda x, y, z: (x & z) | (y & ~z),
    lambda x, y, z: x ^ (y | ~z),
)


def _turn(value: int, by: int) -> int:
    value &= 0xFFFFFFFF
    return (value << by | value >> 32 - by) & 0xFFFFFFFF


def _line(state: tuple, words: tuple, order: tuple, turns: tuple, adds: tuple, mixes: tuple) -> tuple:
    a, b, c, d, e = state
    for which in range(5):
        for word, by in zip(order[which], turns[which], strict=True):
            mixed = _turn(a + mixes[which](b, c, d) + words[word] + adds[which], by) + e
            a, b, c, d, e = e, mixed & 0xFFFFFFFF, b, _turn(c, 10), d
    return a, b, c, d, e


def ripemd160_portable(data: bytes) -> bytes:
    """RIPEMD-160 for installations whose OpenSSL leaves it out."""
    padded = data + b"\x80" + b"\0" * ((55 - len(data)) % 64) + struct.pack("<Q", len(data) * 8)
    state = _START
    for at in range(0, len(padded), 64):
        words = struct.unpack("<16I", padded[at : at + 64])
        left = _line(state, words, _LEFT_WORDS, _LEFT_TURNS, _LEFT_ADD, _MIX)
        right = _line(state, words, _RIGHT_WORDS, _RIGHT_TURNS, _RIGHT_ADD, _MIX[::-1])
        state = tuple((state[(i + 1) % 5] + left[(i + 2) % 5] + right[(i + 3) % 5]) & 0xFFFFFFFF for i in range(5))
    return struct.pack("<5I", *state)


try:
    hashlib.new("ripemd160")
    _ripemd160 = lambda data: hashlib.new("ripemd160", data).digest()
except ValueError:
    _ripemd160 = ripemd160_portable
