"""Sets of word shingles as sorted 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
BASE = 0x2545F4914F6CDD1D
BACK = pow(BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each number over all 64."""
    h = (h ^ (h >> np.uint64(30))) * MIX[0]
    h = (h ^ (h >> np.uint64(27))) * MIX[1]
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base ** 2, ... modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z lower-cased, and the number of words of each text."""
    raw = [t.encode() for t in texts]
    codes = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    upper = (codes >= 65) & (codes <= 90)
    codes = codes + (upper * np.uint8(32))
    gap = (codes == 32) | ((codes >= 9) & (codes <= 13))
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + ODD) * powers(len(codes), BASE), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * powers(len(codes), BACK)[starts] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([len(r) + 1 for r in raw])
    upto = np.searchsorted(starts, bounds, "right")
    return hashes, np.diff(upto, prepend=0)


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text.

    A text with fewer words is one shingle, its whole sequence; without words it has none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    starts = ends - counts
    owner = np.repeat(np.arange(len(texts)), counts)
    shingles, owners = np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(words) >= k:
        h = np.zeros(len(words) - k + 1, np.uint64)
        for j in range(k):
            h = h * ODD + words[j : j + len(h)]
        at = np.flatnonzero(owner[: len(h)] == owner[k - 1 :])
        shingles, owners = mix(h[at]), owner[at]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = []
        for i in short.tolist():
            h = np.uint64(counts[i])
            with np.errstate(over="ignore"):
                for w in words[starts[i] : ends[i]]:
                    h = h * MIX[0] + w
            whole.append(h)
        shingles = np.concatenate([shingles, mix(np.array(whole, np.uint64))])
        owners = np.concatenate([owners, short])
    order = np.lexsort((shingles, owners))
    shingles, owners = shingles[order], owners[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owners[1:] != owners[:-1])
    shingles, owners = shingles[new], owners[new]
    return np.split(shingles, np.cumsum(np.bincount(owners, minlength=len(texts)))[:-1])


def pieces(texts: list[str], size: int) -> list[tuple[int, int]]:
    """Ranges of consecutive texts with about ``size`` characters each."""
    out, first, chars = [], 0, 0
    for i, t in enumerate(texts):
        if i > first and chars + len(t) > size:
            out.append((first, i))
            first, chars = i, 0
        chars += len(t)
    if first < len(texts):
        out.append((first, len(texts)))
    return out
