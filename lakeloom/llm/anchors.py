"""Rolling hashes and winnowed anchors of token sequences."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

# Windows of a very long text are looked at so many at a time.
STRETCH = 1 << 18
# Anchors are ordered by the upper bits of their hash, then by position, which needs this many bits.
PLACE_BITS = 24
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def scramble(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over the others."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


LETTERS = scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0]))


def _hashed(tokens: np.ndarray) -> np.ndarray:
    return LETTERS[tokens] if tokens.dtype == np.uint8 else tokens


class Powers:
    """Powers of an odd base and of its inverse, modulo 2**64, as many as were asked for."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), None, None

    def prefix(self, tokens: np.ndarray) -> np.ndarray:
        n = len(tokens)
        if self.up is None or len(self.up) <= n:
            size = max(4096, 2 * n)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size, self.base, dtype=np.uint64)])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size, self.inverse, dtype=np.uint64)])
        out = np.empty(n + 1, dtype=np.uint64)
        out[0] = 0
        np.cumsum(tokens * self.up[:n], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the tokens from each start up to its end, wherever they lie."""
        return (prefix[ends] - prefix[starts]) * self.down[starts]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size, low = 1, values
    while size * 2 <= width:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    return np.minimum(low[: len(values) - width + 1], low[width - size :]) if size < width else low


@dataclass(frozen=True)
class Runs:
    """Consecutive windows with one anchor: ``lo`` to ``hi`` are their first tokens, ``at`` the anchor's."""

    hash: np.ndarray
    at: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    sig: np.ndarray  # hash of the tokens of all the run's windows, unlike those of anchors no sum over them


class Winnower:
    """Anchors of windows: of the gram hashes in a window of ``length`` tokens, the leftmost of the smallest.

    Windows of equal tokens have equal anchors at equal places, so that texts which share a window share an anchor.
    """

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram = length, gram
        self.one, self.two = (Powers(base) for base in BASES)

    def bytes(self, text: bytes) -> tuple[np.ndarray, None, None]:
        """Each byte as a token, which is its own place in the text."""
        return np.frombuffer(text, dtype=np.uint8), None, None

    def words(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each word between white space as a token: its 64-bit hash, first byte and last byte + 1."""
        raw = np.frombuffer(text, dtype=np.uint8)
        inside = np.zeros(len(raw) + 2, dtype=bool)
        inside[1:-1] = ~SPACE[raw]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        hashes, begin, digest = np.empty(len(starts), dtype=np.uint64), 0, xxhash.xxh3_64_intdigest
        while begin < len(starts):  # so many bytes at a time, whole words
            end = max(begin + 1, int(np.searchsorted(ends, starts[begin] + STRETCH)))
            words = text[starts[begin] : ends[end - 1]].split()
            hashes[begin:end] = np.fromiter(map(digest, words), dtype=np.uint64, count=end - begin)
            begin = end
        return hashes, starts, ends

    def windows(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128-bit hashes of all windows, as two arrays of 64 bits."""
        tokens = _hashed(tokens)
        starts = np.arange(len(tokens) - self.length + 1)
        return tuple(
            scramble(powers.spans(powers.prefix(tokens), starts, starts + self.length))
            for powers in (self.one, self.two)
        )

    def runs(self, tokens: np.ndarray) -> Iterator[Runs]:
        for start in range(0, len(tokens) - self.length + 1, STRETCH):
            yield self._runs(tokens[start : start + STRETCH + self.length - 1], start)

    def _runs(self, tokens: np.ndarray, offset: int) -> Runs:
        raw, tokens = memoryview(np.ascontiguousarray(tokens)).cast("B"), _hashed(tokens)
        width = len(raw) // len(tokens)
        prefix = self.one.prefix(tokens)
        places = np.arange(len(tokens) - self.gram + 1)
        grams = scramble((prefix[self.gram :] - prefix[: -self.gram]) * self.one.down[: len(places)])
        order = (grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places.astype(np.uint64)
        chosen = sliding_min(order, self.length - self.gram + 1) & np.uint64((1 << PLACE_BITS) - 1)
        chosen = chosen.astype(np.int64)
        lo = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        hi = np.r_[lo[1:], len(chosen)] - 1
        at, ends = chosen[lo], hi + self.length
        spans = zip((lo * width).tolist(), (ends * width).tolist())
        digest = xxhash.xxh3_64_intdigest
        sig = np.fromiter((digest(raw[a:b]) for a, b in spans), dtype=np.uint64, count=len(lo))
        return Runs(grams[at], at + offset, lo + offset, hi + offset, sig)
