"""Word shingles of whole texts as sets of 64-bit hashes, in numpy over many texts at once.

Words are runs of anything but ASCII white space, A-Z lower-cased.  A set holds the distinct
``k``-word shingles; a text with fewer words has its whole sequence as one; without words the set
is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
#: An odd base and its inverse modulo 2**64, and the constants of splitmix64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bytes hashed at once.
GROUP = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as many as asked for so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, GROUP * 2)
            base = lambda b: np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)])
            up, down = base(_BASE), base(_INVERSE)
            if size > 4 * GROUP:  # not kept: one very long word or line
                return up, down
            self.up, self.down = up, down
        return self.up, self.down


_powers = _Powers()


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in ``data``."""
    a = np.frombuffer(data.lower(), np.uint8)
    inside = np.zeros(len(a) + 2, bool)
    inside[1:-1] = _IN_WORD[a]
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    up, down = _powers.of(len(a) + 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTE[a] * up[: len(a)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _parts(data: bytes) -> Iterator[bytes]:
    """Pieces of about GROUP bytes, cut at white space only."""
    at = 0
    while len(data) - at > GROUP:
        cut = at + GROUP
        while cut < len(data) and _IN_WORD[data[cut]]:
            cut += 1
        yield data[at:cut]
        at = cut
    yield data[at:]


def word_hashes(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For each text the hashes of its words in order."""
    group, size = [], 0

    def flush():
        words, starts = _hashed(b"\n".join(group))
        offsets = np.cumsum([0] + [len(t) + 1 for t in group])
        cuts = np.searchsorted(starts, offsets)
        return [words[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    for text in texts:
        if len(text) > GROUP:
            if group:
                yield from flush()
                group, size = [], 0
            yield np.concatenate([_hashed(p)[0] for p in _parts(text)])
            continue
        group.append(text)
        size += len(text)
        if size > GROUP:
            yield from flush()
            group, size = [], 0
    if group:
        yield from flush()


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The shingles of a word sequence, in order, repeats included."""
    k = min(k, len(words))
    if not k:
        return words
    out = words[: len(words) - k + 1].copy()
    for j in range(1, k):
        out = out * _STEP + words[j : len(words) - k + 1 + j]
    return mixed(out + np.uint64(k))


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    for words in word_hashes(texts):
        yield np.unique(shingle_hashes(words, k))
