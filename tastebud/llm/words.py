"""Whole texts as numpy arrays: words, their hashes, and code points, a few million characters at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1_000_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """64-bit value of each byte, A-Z as a-z, white space 0."""
    v = mixed(np.arange(1, 257, dtype=np.uint64) * _GOLD)
    v[ord("A") : ord("Z") + 1] = v[ord("a") : ord("z") + 1]
    v[SPACES] = 0
    return v


#: The white space that parts words: fixed values.
SPACES = np.array([0x20, *range(0x09, 0x0E)])
BYTE_VALUES = _byte_values()
IS_SPACE = np.isin(np.arange(256), SPACES)


def chunks(lengths: list[int], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` in all; a longer text is a range of its own."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts (A-Z lower-cased), and where each text's words start (one more entry than texts).

    A word's hash is a polynomial of its bytes, modulo 2**64, and its length, mixed.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    inside = ~IS_SPACE[joined]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    lengths = ends - starts
    power = np.ones(int(lengths.max()), dtype=np.uint64)
    power[1:] = _GOLD | np.uint64(1)
    np.cumprod(power, out=power)
    # letters alone, side by side, each times its place's power
    value = BYTE_VALUES[joined[inside]]
    first = np.zeros(len(starts), dtype=np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    value *= power[np.arange(len(value)) - np.repeat(first, lengths)]
    h = mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64) * _M1)
    return h, np.searchsorted(starts, offsets)


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (int64) of each text.

    A shingle is ``width`` consecutive words; a text of fewer words is one
    shingle as a whole; a text without words, or null, has none.
    """
    blobs = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    weight = mixed(np.arange(1, width + 1, dtype=np.uint64) * _M2) | np.uint64(1)
    for a, b in chunks([len(x) for x in blobs]):
        h, first = word_hashes(blobs[a:b])
        n = len(h) - width + 1
        if n > 0:
            s = h[:n] * weight[0]
            for k in range(1, width):
                s += h[k : n + k] * weight[k]
            s = mixed(s)
        for i in range(b - a):
            lo, hi = first[i], first[i + 1]
            if hi - lo >= width:
                yield np.unique(s[lo : hi - width + 1].view(np.int64))
            elif hi > lo:
                whole = mixed((h[lo:hi] * weight[: hi - lo]).sum(dtype=np.uint64, keepdims=True) + np.uint64(hi - lo))
                yield whole.view(np.int64)
            else:
                yield np.zeros(0, np.int64)


def code_points(texts: list[str]) -> np.ndarray:
    """All code points of the texts, one after the other."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
