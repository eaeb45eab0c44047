"""Hashes of byte spans, words and word windows over whole batches of texts at once.

A batch is one byte array with document offsets. Prefix sums of v[byte] * B**position (mod 2**64)
give the hash of any span by one subtraction and a multiplication with B**-start, so words, word
windows and byte windows of all texts are hashed without a loop over documents.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = {"bytes": 0x9E3779B97F4A7C15, "words": 0xC2B2AE3D27D4EB4F}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (xor-shift and multiply)."""
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i for i < n."""
    have = _powers.get(kind)
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        b = _BASE[kind]
        inverse = pow(b, -1, 1 << 64)
        have = _powers[kind] = tuple(np.multiply.accumulate(np.concatenate(([_U(1)], np.full(n - 1, x, _U)))) for x in (b, inverse))
    return have


def byte_values(lower: bool = False) -> np.ndarray:
    """A fixed value of 64 bits for each byte; A-Z as a-z if lower."""
    v = mix(np.arange(1, 257, dtype=_U) * _U(0xA24BAED4963EE407))
    if lower:
        v[65:91] = v[97:123]
    return v


def prefix(values: np.ndarray, kind: str) -> np.ndarray:
    p, _ = powers(kind, len(values) + 1)
    out = np.zeros(len(values) + 1, _U)
    np.cumsum(values * p[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, kind: str) -> np.ndarray:
    _, inverse = powers(kind, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start])


def words(raw: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each maximal run of bytes with in_word[byte]; runs end with their document."""
    n = len(raw)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    w = in_word[raw]
    opens = w.copy()
    opens[1:] &= ~w[:-1]
    closes = w.copy()
    closes[:-1] &= ~w[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    opens[edge] = w[edge]
    closes[edge - 1] = w[edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def windows(word_hash: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of first word) of each run of size words within one document."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    first = np.flatnonzero(doc[:n] == doc[size - 1 :])
    return span_hash(prefix(word_hash, "words"), first, first + size, "words"), first


def flags(*ranges: tuple[int, int]) -> np.ndarray:
    """True for bytes in the ranges (both ends included)."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Bytes of a word of [^\x20\x09-\x0D]+, and of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
NOT_SPACE = ~flags((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = flags((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
