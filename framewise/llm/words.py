"""Hashes of words and word shingles of a text, with numpy inside a task.

A word's hash is a polynomial over its bytes, taken from running sums over the whole text,
so that no Python code runs per word. Sums and products wrap at 64 bits.
"""

from __future__ import annotations

import numpy as np

#: Texts are hashed in pieces of so many bytes, cut between words where possible.
PIECE = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1

#: The bytes of ``[\x20\x09-\x0D]``.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: ASCII bytes that are neither letters nor digits.
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])

#: Lower case for A-Z, everything else as it is.
LOWER_ASCII = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, PIECE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def _hashes(data: np.ndarray, apart: np.ndarray) -> np.ndarray:
    inside = ~apart[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes, apart: np.ndarray = BLANK) -> np.ndarray:
    """One 64-bit hash for each word, a word being a run of bytes that ``apart`` does not mark."""
    data = np.frombuffer(text, np.uint8)
    if len(data) <= PIECE:
        return _hashes(data, apart)
    found, at = [], 0
    while at < len(data):
        end, step = min(at + PIECE, len(data)), PIECE
        while end < len(data):
            blanks = np.flatnonzero(apart[data[at:end]])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
                break
            step *= 2
            end = min(at + step, len(data))
        found.append(_hashes(data[at:end], apart))
        at = end
    return np.concatenate(found)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct hashes of runs of ``size`` words; of the whole sequence if it is shorter.

    No words give no shingle.
    """
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    value = np.full(count, width, np.uint64)
    for i in range(width):
        value = mix(value * np.uint64(_BASE) + words[i : i + count])
    return np.unique(value)
