"""Word shingles as 64-bit hashes, for a whole batch of texts at a time."""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import groups

WORDS = 5
#: Bytes of text that are hashed at a time; a longer text is hashed alone.
RUN = 1 << 18

#: For bytes: white space is 1 in the first table, A-Z become a-z and each byte 64 random bits in the second.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def random_bytes(seed: int) -> np.ndarray:
    """An odd 64-bit number for each value of a byte."""
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BITS = random_bytes(20)
_BITS[65:91] = _BITS[97:123]
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base^0, base^1, .. modulo 2^64."""
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word of UTF-8 bytes, A-Z lower-cased, split at ASCII white space."""
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = turn[::2], turn[1::2]
    up = powers(_BASE, len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BITS[data] * up[: len(data)], dtype=np.uint64)])
    back = powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
    return mix64((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64)), begin


def shingle_sets(texts: list[str | None], words: int = WORDS):
    """For each text the sorted distinct hashes of its shingles of ``words`` words.

    A text with fewer words gives its whole sequence as one shingle, one without words or null none.
    """
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    for a, b in groups([len(r) + 1 for r in raw], RUN):
        data = np.frombuffer(b" ".join(raw[a:b]) + b" ", np.uint8)
        hashes, begin = word_hashes(data)
        cut = np.searchsorted(begin, np.cumsum([0, *(len(r) + 1 for r in raw[a:b])]))
        for first, last in zip(cut[:-1], cut[1:]):
            own = hashes[first:last]
            n = min(words, len(own))
            if not n:
                yield np.empty(0, np.uint64)
                continue
            total = np.full(len(own) - n + 1, n, np.uint64)
            for j in range(n):
                total = total * np.uint64(0xD6E8FEB86659FD93) + own[j : j + len(total)]
            yield np.unique(mix64(total))
