"""Shingle hashes and MinHash signatures for many texts at a time, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import ship

ship(__name__)

MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, those of up to 64 bytes remembered up to a bound (some 30 MB)."""

    def __init__(self, keep: int = 200_000):
        super().__init__()
        self.keep = keep

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.keep and len(word) <= 64:
            self[word] = value
        return value


def scatter(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def scatter_short(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def word_shingles(text: str | None, size: int, known: WordHashes) -> np.ndarray:
    """The set of ``size``-word shingles as sorted 64-bit hashes. A-Z count as a-z; fewer words
    than ``size``: the whole sequence as one; no words: empty."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # for bytes: A-Z alone, at 0x20 and 0x09-0x0D
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(size, len(words))
    n = len(h) - k + 1
    key = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        key = (key ^ (key >> np.uint64(29))) * MIX + h[i : i + n]
    return np.unique(scatter(key))


def line_shingles(lines: list[bytes], size: int, kind: type = np.uint64, block: int = 1 << 16) -> list[np.ndarray]:
    """Hashes of the ``size``-character shingles (a power of two) of UTF-8 lines, in order, as
    uint64 or uint32; a shorter line has none. Lines hold no line feeds. About ``block`` bytes
    are hashed at a time, so that they stay in cache."""
    out: list[np.ndarray] = []
    mix, shift = kind(MIX >> np.uint64(64 - 8 * np.dtype(kind).itemsize)) | kind(1), kind(4 * np.dtype(kind).itemsize - 3)
    begin = 0
    while begin < len(lines):
        end, held = begin, 0
        while end < len(lines) and (end == begin or held + len(lines[end]) <= block):
            held += len(lines[end])
            end += 1
        x = np.frombuffer(b"\n".join(lines[begin:end]).decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        ends = np.append(np.flatnonzero(x == 10), len(x))
        starts = np.append(0, ends[:-1] + 1)
        key, width = x.astype(kind) * mix, 1
        while width < size:  # twice as many characters each time
            key ^= key >> shift
            key, after = key[:-width] * mix if len(key) > width else key[:0], key[width:]
            key += after[: len(key)]
            width *= 2
        key = scatter(key) if kind is np.uint64 else scatter_short(key)
        out += [key[s:e] for s, e in zip(starts.tolist(), np.maximum(ends - size + 1, starts).tolist())]
        begin = end
    return out


def minima(sets: list[np.ndarray], count: int, block: int = 1 << 16) -> np.ndarray:
    """(len(sets), count) uint32 minima of non-empty arrays of uint64 or uint32 shingles under
    ``count`` fixed permutations, about ``block`` shingles at a time so that they stay in cache."""
    factors = np.random.default_rng(20240229).integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    out = np.empty((count, len(sets)), dtype=np.uint32)
    begin = 0
    while begin < len(sets):
        end, held = begin, 0
        while end < len(sets) and (end == begin or held + len(sets[end]) <= block):
            held += len(sets[end])
            end += 1
        x = np.concatenate(sets[begin:end])
        if x.dtype != np.uint32:
            x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
        starts, product = np.cumsum([0, *map(len, sets[begin : end - 1])]), np.empty_like(x)
        for k in range(count):
            np.multiply(x, factors[k], out=product)
            np.minimum.reduceat(product, starts, out=out[k, begin:end])
        begin = end
    return np.ascontiguousarray(out.T)


def band_keys(m: np.ndarray, rows: int) -> np.ndarray:
    """(sets, bands) int64 keys of ``rows`` minima each, the band's number hashed in."""
    n, count = m.shape
    bands = count // rows
    part = m[:, : bands * rows].reshape(n, bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)).copy()
    for r in range(rows):
        key = (key ^ (key >> np.uint64(29))) * MIX + part[:, :, r]
    return scatter(key).view(np.int64)


def low_bits(m: np.ndarray, bits: int) -> np.ndarray:
    """(sets, words) int64: the low ``bits`` of the minima, scattered first, 64 // bits a word."""
    per = 64 // bits
    x = m.astype(np.uint64) * MIX >> np.uint64(64 - bits)
    words = x[:, : x.shape[1] // per * per].reshape(len(m), x.shape[1] // per, per)
    places = np.arange(per, dtype=np.uint64) * np.uint64(bits)
    return np.bitwise_or.reduce(words << places, axis=2).view(np.int64)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0
