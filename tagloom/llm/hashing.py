"""64-bit hashes of words and word windows, for whole arrays at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from .common import WORD_BYTES

MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
S33 = np.uint64(33)
#: Odd base of the window polynomial and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 5
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> S33)) * MIX1
        x = (x ^ (x >> S33)) * MIX2
    return x ^ (x >> S33)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i below n at least."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        with np.errstate(over="ignore"):
            for k, b in enumerate((BASE, INVERSE)):
                steps = np.full(size, b, np.uint64)
                steps[0] = 1
                _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


#: Bytes of text whose words are hashed at a time.
BLOCK = 1 << 18
#: Longer words are hashed one by one: some long words of few letters share a polynomial modulo 2**64.
LONG = 64
#: A random number for each byte.
with np.errstate(over="ignore"):
    BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
SPACE_BYTES = [b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"]
IS_SPACE = np.isin(np.arange(256), [c[0] for c in SPACE_BYTES])


def _blocks(raw: bytes) -> Iterator[bytes]:
    """raw in blocks of BLOCK bytes at most that cut no word, and the longer words by themselves."""
    start = 0
    while len(raw) - start > BLOCK:
        end = max(raw.rfind(c, start, start + BLOCK) for c in SPACE_BYTES) + 1
        if not end:  # one word all along
            end = WORD_BYTES.match(raw, start).end()
        yield raw[start:end]
        start = end
    yield raw[start:]


def _hashes(raw: bytes) -> np.ndarray:
    if len(raw) > BLOCK:
        return np.array([xxhash.xxh3_64_intdigest(raw)], np.uint64)
    b = np.frombuffer(raw, np.uint8)
    edge = np.ones(len(b) + 2, bool)
    edge[1:-1] = IS_SPACE[b]
    ends = np.flatnonzero(edge[1:] != edge[:-1])
    starts, ends = ends[::2], ends[1::2]
    up, down = powers(len(b))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(BYTE[b] * up[: len(b)], out=sums[1:])
        out = mix((sums[ends] - sums[starts]) * down[starts])
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]])
    return out


class WordHasher:
    """Hashes of words, all those of a block of text at once: polynomials of random numbers for their bytes."""

    def of(self, text: str | None, lower: bool = False) -> np.ndarray:
        """Hashes of a text's words in order; ``lower`` lower-cases A-Z."""
        raw = (text or "").encode()
        parts = [_hashes(x) for x in _blocks(raw.lower() if lower else raw)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def windows(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each window of so many words, by its start; empty if there are fewer words."""
    n = len(words)
    if n < length:
        return np.empty(0, np.uint64)
    up, down = powers(n)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(words * up[:n])))
        return mix((sums[length:] - sums[:-length]) * down[: n - length + 1])


def spans(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the words from each start to each end."""
    n = len(words)
    up, down = powers(n)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(words * up[:n])))
        return mix(mix((sums[ends] - sums[starts]) * down[starts]) + (ends - starts).astype(np.uint64))
