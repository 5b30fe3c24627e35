"""Words of many UTF-8 texts at once, as 64-bit hashes in numpy arrays.

A word is a longest run of bytes other than space and the controls 9 to 13. None of these
occurs inside a multi-byte character, so bytes and code points give the same words.
Long texts are hashed in pieces cut between words, so memory follows the longest word, not
the longest text, apart from eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Bytes hashed in one go.
BLOCK_BYTES = 2 << 20

_U = np.uint64
SEPARATORS = b"\t\n\x0b\x0c\r "
_IS_SEPARATOR = np.zeros(256, dtype=bool)
_IS_SEPARATOR[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BYTE_VALUE[list(SEPARATORS)] = 0
_STEP = _U(0xD6E8FEB86659FD93)
_powers = np.ones(1, dtype=_U)


def powers(n: int) -> np.ndarray:
    """At least ``n`` powers of an odd constant modulo 2**64; the longest table so far is kept."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 256), _STEP, dtype=_U)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


def _hash_block(data: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of ``data``."""
    codes = np.frombuffer(data, dtype=np.uint8)
    if lower:
        codes = _LOWER[codes]
    outside = _IS_SEPARATOR[codes]
    begins = ~outside
    begins[1:] &= outside[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, dtype=_U), starts
    spans = np.diff(starts, append=len(codes))
    place = np.arange(starts[0], len(codes)) - np.repeat(starts, spans)
    place[outside[starts[0] :]] = 0
    values = _BYTE_VALUE[codes[starts[0] :]] * powers(int(place.max()) + 1)[place]
    sums = np.add.reduceat(values, starts - starts[0])
    return mix(sums + _U(1)), starts


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about a block, cut at separators only."""
    at = 0
    while at < len(data):
        end = at + BLOCK_BYTES
        while end < len(data) and data[end] not in SEPARATORS:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(texts: Sequence[bytes], lower: bool) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """Blocks of texts: which texts, the hashes of all their words, and where each text's words
    begin (one entry more than texts). ``lower`` folds A-Z first."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) < BLOCK_BYTES):
            size += len(texts[last]) + 1
            last += 1
        block = texts[first:last]
        if len(block) == 1 and len(block[0]) > BLOCK_BYTES:
            hashes = np.concatenate([_hash_block(piece, lower)[0] for piece in _pieces(block[0])])
            bounds = np.array([0, len(hashes)])
        else:
            hashes, starts = _hash_block(b"\n".join(block), lower)
            ends = np.cumsum([0, *(len(text) + 1 for text in block)])
            bounds = np.searchsorted(starts, ends)
        yield range(first, last), hashes, bounds
        first = last


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, by its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=_U)
    step, total = powers(size + 1), np.zeros(n, dtype=_U)
    for i in range(size):
        total += hashes[i : i + n] * step[i + 1]
    return mix(total)


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text; nothing for null."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
