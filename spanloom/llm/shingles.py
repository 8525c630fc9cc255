"""Sets of word shingles as 64-bit hashes, in arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes of text handled at once, unless one text is longer.
CHUNK = 1 << 19
_P, _M = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_P_INVERSE = pow(_P, -1, 2**64)
_SEPARATORS = [0x20, *range(0x09, 0x0E)]


def _weights() -> np.ndarray:
    t = np.random.default_rng(41).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    t[ord("A") : ord("Z") + 1] = t[ord("a") : ord("z") + 1]
    t[_SEPARATORS] = 0
    return t


WEIGHTS = _weights()
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(max(n, 2 * CHUNK), base, np.uint64)
        p[0] = 1
        _powers[base] = np.multiply.accumulate(p)
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(_M)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(_P)
    return h ^ (h >> np.uint64(32))


def words(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of the texts, how many words each text has). A word is a run without white space; A-Z count as a-z."""
    raw = np.frombuffer(b" ".join([*group, b""]), np.uint8)  # a space stands after each text
    w = WEIGHTS[raw]
    inside = w != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    total = np.concatenate([[np.uint64(0)], np.cumsum(w * powers(_P, len(w)))])
    h = mix((total[b + 1] - total[a]) * powers(_P_INVERSE, len(w))[a] + (b - a).astype(np.uint64))
    ends = np.cumsum([len(x) + 1 for x in group])
    return h, np.diff(np.searchsorted(a, ends), prepend=0)


def shingles(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes of all texts, how many each has, repeats included). Fewer than k words are one shingle."""
    start = np.cumsum(counts) - counts
    total = np.maximum(counts - k + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), total)
    at = start[owner] + np.arange(len(owner)) - (np.cumsum(total) - total)[owner]
    full = np.minimum(counts, k)[owner]
    out = full.astype(np.uint64)
    for j in range(k):
        use = full > j
        out[use] = mix(out[use] * np.uint64(_M) + h[at[use] + j])
    return out, total


def sets(texts: Iterable[str | None], k: int) -> Iterator[np.ndarray]:
    """The set of each text: sorted distinct shingle hashes; empty for null and for texts without words."""
    group: list[bytes] = []
    size = 0
    for t in texts:
        b = (t or "").encode()
        if group and size + len(b) > CHUNK:
            yield from _sets(group, k)
            group, size = [], 0
        group.append(b)
        size += len(b) + 1
    if group:
        yield from _sets(group, k)


def _sets(group: list[bytes], k: int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        s, n = shingles(*words(group), k)
    ends = np.cumsum(n)
    for a, b in zip((ends - n).tolist(), ends.tolist()):
        x = np.sort(s[a:b])
        if len(x) > 1:
            x = x[np.concatenate([[True], x[1:] != x[:-1]])]
        yield x
