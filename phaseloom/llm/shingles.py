"""Word shingles and MinHash signatures of whole texts, by NumPy over blocks of an Arrow column."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_STEP = np.uint64(0xD1B54A32D192ED03)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            _powers[k] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base, np.uint64)]), dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z in lower case, and each word's text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    before, after = np.concatenate([[False], word[:-1]]), np.concatenate([word[1:], [False]])
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner], after[inner - 1] = False, False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[_LOW[data]] * powers[:-1], dtype=np.uint64)])
    raw = (sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64) * _STEP
    return _mixed(raw), np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of `width` words; fewer words make one shingle, none an empty set."""
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    rows = np.zeros(0, np.uint64)
    if len(words) >= width:
        rows = words[: len(words) - width + 1]
        for j in range(1, width):
            rows = _mixed(rows * _STEP + words[j : len(words) - width + 1 + j])
    out = []
    for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
        if n >= width:
            out.append(np.unique(rows[end - n : end - width + 1]))
        elif n:
            own = words[end - n : end]
            short = own[:1] + np.uint64(n)
            for j in range(1, n):
                short = _mixed(short * _STEP + own[j : j + 1])
            out.append(_mixed(short))
        else:
            out.append(rows[:0])
    return out


def permutations(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def signatures(sets: list[np.ndarray], n: int, seed: int) -> np.ndarray:
    """MinHash values, a row of n for each set, none of which may be empty."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((n, len(sets)), np.uint32)
    for k, (a, b) in enumerate(zip(*permutations(n, seed), strict=True)):
        np.minimum.reduceat(flat * a + b, starts, out=out[k])
    return np.ascontiguousarray(out.T)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each set and band, different between bands."""
    cut = signature[:, : bands * rows].astype(np.uint64).reshape(len(signature), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _BASE, cut.shape[:2])
    for j in range(rows):
        keys = _mixed(keys * _STEP + cut[:, :, j])
    return keys.astype(np.int64)


def digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()
