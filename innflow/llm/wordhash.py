"""Vectorised hashes of words and of runs of words (numpy, per text)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

_B = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
_R = 0xD1342543DE82EF95
_SLICE = 1 << 20
_GIANT = 1 << 12
_TOGETHER = 1 << 16
_GAPS = bytes(x == 32 or 9 <= x <= 13 for x in range(256))
_MASK = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _powers:
        inverse = np.uint64(pow(int(_B), -1, 1 << 64))
        for name, base in (("up", _B), ("down", inverse)):
            steps = np.full(_SLICE + 1, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def _words_of_slice(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and its hash."""
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = np.frombuffer(data.translate(_GAPS), dtype=bool)
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _tables()
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    rest = total[1:]
    np.add(np.frombuffer(data, dtype=np.uint8), np.uint64(1), out=rest, dtype=np.uint64)
    rest *= up[:len(data)]
    np.cumsum(rest, out=rest)
    size = (ends - starts).astype(np.uint64)
    out = mix((total[ends] - total[starts]) * down[starts] + mix(size))
    for i in np.flatnonzero(ends - starts > _GIANT):
        out[i] = _giant(data[starts[i]:ends[i]])
    return starts, out


def _hash_slice(data: bytes) -> np.ndarray:
    return _words_of_slice(data)[1]


def _giant(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word (characters other than space and U+0009..U+000D), equal for equal words wherever they stand."""
    data = text.encode("utf-8", "surrogatepass")
    if len(data) <= _SLICE:
        return _hash_slice(data)
    parts: list[np.ndarray] = []
    pending: list[bytes] = []
    held = 0
    for word in data.split():
        if len(word) > _GIANT or held + len(word) + 1 > _SLICE:
            parts.append(_hash_slice(b" ".join(pending)))
            pending, held = [], 0
        if len(word) > _GIANT:
            parts.append(np.array([_giant(word)], dtype=np.uint64))
        else:
            pending.append(word)
            held += len(word) + 1
    parts.append(_hash_slice(b" ".join(pending)))
    return np.concatenate(parts)


def hashes_of_texts(texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``word_hashes`` of many texts, small ones together: per group of texts all hashes in order and how many each text has."""
    group: list[bytes] = []
    held = 0

    def hashed() -> tuple[np.ndarray, np.ndarray]:
        starts, out = _words_of_slice(b" ".join(group))
        ends = np.cumsum([len(data) + 1 for data in group])
        return out, np.diff(np.searchsorted(starts, ends), prepend=0)

    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        if group and held + len(data) > _TOGETHER:
            yield hashed()
            group, held = [], 0
        if len(data) > _TOGETHER:
            out = word_hashes(text)
            yield out, np.array([len(out)])
        else:
            group.append(data)
            held += len(data) + 1
    if group:
        yield hashed()


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on (by doubling, exact modulo 2^64, then scrambled)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    block, size, done = words, 1, 0
    while True:
        if length & size:
            out += np.uint64(pow(_R, done, 1 << 64)) * block[done:done + n]
            done += size
        if done == length:
            return mix(out)
        block = block[:len(block) - size] + np.uint64(pow(_R, size, 1 << 64)) * block[size:]
        size *= 2


def window_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value (the leftmost of equals) in each window of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    best, size = np.arange(len(values)), 1

    def lesser(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] < values[a], b, a)

    while 2 * size <= width:
        best = lesser(best[:len(best) - size], best[size:])
        size *= 2
    return lesser(best[:n], best[width - size:width - size + n])
