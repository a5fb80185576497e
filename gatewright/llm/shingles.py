"""Sets of word shingles as sorted 64-bit hashes, computed on whole byte arrays."""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 22
_RANDOM = np.random.default_rng(20260901)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def _segment_words(data: np.ndarray) -> np.ndarray:
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64)])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, in order."""
    raw = text.encode().lower()
    if len(raw) <= SEGMENT:
        return _segment_words(np.frombuffer(raw, np.uint8))
    return np.concatenate([_segment_words(np.frombuffer(part, np.uint8)) for part in _cut(raw)])


def _cut(raw: bytes):
    """Pieces of about ``SEGMENT`` bytes that end at white space (a longer word stays whole)."""
    at = 0
    while at < len(raw):
        end = at + SEGMENT
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield raw[at:end]
        at = end


def shingle_set(text: str, size: int) -> np.ndarray:
    """Distinct shingles of ``size`` words, sorted; a shorter text is one shingle, a text without words has none."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words
    width = min(size, len(words))
    seed = np.uint64((len(words) if len(words) < size else size) * 0xD6E8FEB86659FD93 % (1 << 64))
    out = mixed(words[: len(words) - width + 1] + seed)
    for k in range(1, width):
        out = mixed(out * np.uint64(_BASE) + words[k : len(words) - width + 1 + k])
    return np.unique(out)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
