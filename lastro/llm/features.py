"""Hashed byte n-grams of texts, as numpy arrays."""

from __future__ import annotations

import numpy as np

#: Letters and all bytes from 0x80 on as themselves, all others as a blank.
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: The same with digits.
_WORDS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else 0x20
               for b in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Texts are worked through in pieces of this many bytes; nothing is left out.
PIECE = 1 << 20


def normal(text: str, digits: bool = False) -> bytes:
    """Lower-cased words parted by single blanks, with one at either end."""
    data = text.lower().encode("utf-8", "replace")
    words = data.translate(_WORDS if digits else _LETTERS).split()
    return b" " + b" ".join(words) + b" " if words else b""


def grams(data: bytes, n: int, bits: int):
    """Hashes, below 2**bits, of the n bytes at each place, piece by piece."""
    octets = np.frombuffer(data, np.uint8)
    for start in range(0, len(octets) - n + 1, PIECE):
        part = octets[start:start + PIECE + n - 1]
        size = len(part) - n + 1
        value = part[:size].astype(np.uint64)
        for k in range(1, n):
            value <<= np.uint64(8)
            value |= part[k:size + k]
        value *= _FACTOR
        value >>= np.uint64(64 - bits)
        yield value.astype(np.int64)


def gram_shares(text: str, n: int, bits: int) -> np.ndarray:
    """Square roots of the shares of a text's n-grams; zeros without any."""
    total = np.zeros(1 << bits, np.float32)
    for found in grams(normal(text), n, bits):
        total += np.bincount(found, minlength=1 << bits)
    count = total.sum()
    return np.sqrt(total / count) if count else total


def present(text: str, n: int, bits: int, wanted: np.ndarray | None = None,
            ) -> np.ndarray:
    """Sorted distinct n-grams of a text, of those marked in ``wanted``."""
    found = [np.empty(0, np.int64)]
    for part in grams(normal(text, digits=True), n, bits):
        found.append(np.unique(part if wanted is None else part[wanted[part]]))
    return np.unique(np.concatenate(found)) if len(found) > 2 else found[-1]
