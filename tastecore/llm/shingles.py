"""Word shingles as 64-bit hashes, for many texts at once.

Words are runs of bytes other than white space, with A-Z lower-cased; a shingle is `width` words in
a row, or the whole text if it has fewer. A word's hash is a polynomial over its bytes, taken from
running sums over the whole block of texts, so the work is the same for every word length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

BLOCK_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
MIX = np.uint64(0xD6E8FEB86659FD93)


def byte_values(fold: bool) -> np.ndarray:
    """A number for each byte; `fold`: the same for A-Z as for a-z."""
    values = np.frombuffer(hashlib.shake_128(b"bytes").digest(256 * 8), np.uint64).copy()
    if fold:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_byte_values = byte_values(fold=True)
_is_space = np.zeros(256, bool)
_is_space[[32, *range(9, 14)]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def power(kind: str, n: int) -> np.ndarray:
    """BASE ** i, or its inverse, modulo 2 ** 64."""
    if len(_powers[kind]) < n:
        step = BASE if kind == "up" else pow(BASE, -1, 1 << 64)
        values = np.full(max(n, 2 * BLOCK_BYTES), step & (2**64 - 1), np.uint64)
        values[0] = 1
        _powers[kind] = np.multiply.accumulate(values)
    return _powers[kind]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * MIX
    h = (h ^ h >> np.uint64(29)) * MIX
    return h ^ h >> np.uint64(32)


def _blocks(texts: Sequence[str | None]) -> Iterator[list[bytes]]:
    block: list[bytes] = []
    size = 0
    for text in texts:
        block.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(block[-1])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def shingle_sets(texts: Sequence[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; empty without words."""
    factors = power("up", 64)[1 : width + 1]
    for block in _blocks(texts):
        data = np.frombuffer(b" ".join([*block, b""]), np.uint8)
        if not len(data):
            yield from (np.empty(0, np.uint64) for _ in block)
            continue
        inside = ~_is_space[data]
        sums = np.concatenate(([np.uint64(0)], np.cumsum(_byte_values[data] * power("up", len(data))[: len(data)], dtype=np.uint64)))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        words = mixed((sums[ends] - sums[starts]) * power("down", len(data))[starts])
        limits = np.cumsum([len(t) + 1 for t in block])
        bounds = np.concatenate(([0], np.searchsorted(starts, limits)))
        rows = max(len(words) - width + 1, 0)
        joined = np.zeros(rows, np.uint64)
        for i in range(width):
            joined += words[i : i + rows] * factors[i]
        joined = mixed(joined)
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if last - first >= width:
                yield np.unique(joined[first : last - width + 1])
            elif last > first:
                few = words[first:last] * factors[: last - first]
                yield mixed(np.array([few.sum(dtype=np.uint64) + np.uint64(last - first)], np.uint64) * MIX)
            else:
                yield np.empty(0, np.uint64)


def fingerprint(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)
