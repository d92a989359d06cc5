"""Hashed word shingles of whole texts, by numpy over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np

MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(MULT), -1, 1 << 64))
#: Texts are joined to chunks of about this many bytes; the work arrays take some 60 bytes for each.
CHUNK = 1 << 21


def _mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64: a bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.empty(0, np.uint64)
_INVERSES = np.empty(0, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULT**0 .. MULT**n and their inverses, kept for the next call."""
    global _POWERS, _INVERSES
    if len(_POWERS) <= n:
        m = max(n + 1, CHUNK + 1)
        out = []
        for base in (MULT, _INVERSE):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS, _INVERSES = out
    return _POWERS, _INVERSES


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _chunk(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and hashes of the words of one chunk."""
    raw = np.frombuffer(data, np.uint8)
    gap = _SPACE[raw]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate(([0], edge))
    if not gap[-1]:
        edge = np.concatenate((edge, [len(raw)]))
    starts, ends = edge[0::2], edge[1::2]
    power, inverse = _powers(len(raw))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, _mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """For each text the hashes of its words, A-Z lower-cased, in order."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(texts):
        parts, at, total = [], [], 0
        while i < len(texts) and (not parts or total < CHUNK):
            b = texts[i].encode("utf-8", "surrogatepass") + b" "
            at.append(total)
            parts.append(b)
            total += len(b)
            i += 1
        starts, hashes = _chunk(b"".join(parts))
        cut = np.searchsorted(starts, at[1:])
        out += np.split(hashes, cut)
    return out


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """For each text its sorted distinct shingle hashes (int64); fewer than width words make one shingle."""
    out = []
    for w in word_hashes(texts):
        n = len(w)
        if n == 0:
            out.append(w.view(np.int64))
            continue
        k = min(width, n)
        h = np.full(n - k + 1, np.uint64(k), np.uint64)
        for j in range(k):
            h = _mix(h * MULT + w[j : n - k + 1 + j])
        out.append(np.unique(h.view(np.int64)))
    return out
