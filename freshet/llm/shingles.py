"""Sets of word shingles as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5  # of a shingle
SLICE_BYTES = 1 << 20  # of text hashed at once; a longer text is taken alone

_rng = np.random.Generator(np.random.PCG64(20240115))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = _rng.integers(1, 1 << 63, WORDS + 1, dtype=np.uint64) | np.uint64(1)
_BASE = int(_rng.integers(1, 1 << 63)) | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 and so on modulo 2^64, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    factor = base
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(factor)])
        factor = factor * factor % (1 << 64)
    return out


_tables = (_powers(_BASE, 2 * SLICE_BYTES), _powers(_UNBASE, 2 * SLICE_BYTES))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= len(_tables[0]):
        return _tables
    return _powers(_BASE, n), _powers(_UNBASE, n)


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of a buffer that ends in white space."""
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    up, down = _power_tables(len(raw))
    sums = np.cumsum(_BYTE[raw] * up[: len(raw)])
    before = np.where(start > 0, sums[start - 1], np.uint64(0))
    return mix((sums[end - 1] - before) * down[start]), start


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for raw in texts:
        if part and size + len(raw) > SLICE_BYTES:
            yield part
            part, size = [], 0
        part.append(raw)
        size += len(raw) + 1
    if part:
        yield part


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Per text the sorted hashes of its distinct 5-word shingles.

    Words are runs of anything but ASCII white space, A-Z in lower case. A text of
    fewer words has one shingle, the whole sequence; one without words has none.
    """
    out: list[np.ndarray] = []
    for part in _slices([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]):
        raw = np.frombuffer(b"\n".join(part) + b"\n", dtype=np.uint8)
        words, start = _word_hashes(raw)
        ends = np.cumsum([len(x) + 1 for x in part])
        last = np.searchsorted(start, ends)
        n = max(0, len(words) - WORDS + 1)
        joined = sum((words[k : k + n] * _PLACE[k] for k in range(WORDS)), np.zeros(n, dtype=np.uint64))
        joined = mix(joined + _PLACE[WORDS])
        first = 0
        for upto in last.tolist():
            if upto - first >= WORDS:
                out.append(np.unique(joined[first : upto - WORDS + 1]))
            elif upto > first:
                short = (words[first:upto] * _PLACE[: upto - first]).sum(dtype=np.uint64)
                out.append(mix(np.array([short + np.uint64(upto - first)], dtype=np.uint64)))
            else:
                out.append(np.empty(0, dtype=np.uint64))
            first = upto
    return out
