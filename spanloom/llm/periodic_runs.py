"""Periodic runs of words, by the divide and conquer of Main and Lorentz (operator 13).

A run is a stretch of consecutive words with smallest period ``q``, of at least ``LEAST`` words and ``TIMES`` periods, that no
neighbouring word extends keeping the period. The words of a text are interned as numbers. A block of them is cut at its
midpoint; every repetition that crosses the midpoint shows in four Z-functions there: how far the words after the midpoint
agree with themselves, and with the words before it, ``q`` later, and the same backwards. Both halves are then blocks of their own. A
repetition that a block's border cuts off crosses the midpoint of a larger block, where it is found whole; an interval that is
found with several periods, or at several midpoints, is kept once with its smallest.

Before that, stretches that can't hold a run are left out, which loses none: within a run of that size every ``GRAM`` words in
a row come again a period later or earlier, so at most a third of the run away. Equal words are equal numbers and grams are compared by
64-bit hashes, where a collision could only add a stretch.

Memory follows the longest text; a text's runs need n log n steps. Nothing is shuffled.

Defined results: a null or empty text, or one without words, has no runs and collapses to an empty text. Texts are read whole. Rows that repeat an
id or text are each answered; a null id stays. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import in_arrow
from .shingles import mix

#: Words and periods that a run has at least; words of a gram: runs of that size hold one at each place.
LEAST, TIMES, GRAM = 24, 3, 8
#: Bytes of collapsed texts that a worker hands back at once, unless one text is longer.
CHUNK = 1 << 20

Run = tuple[int, int, int]  # start, end, period


def prefixes(pattern: list[int], z: list[int], text: list[int], stop: int, first: int = 0) -> list[int]:
    """How many words of ``text`` from each place below ``stop`` on agree with the pattern. ``z``: the same of the pattern in itself."""
    n, size = len(text), len(pattern)
    out = [0] * stop
    left = right = first  # text[left:right] is the beginning of the pattern that reaches furthest
    for i in range(first, stop):
        k = right - i
        if k > 0 and z[i - left] < k:
            out[i] = z[i - left]
            continue
        if k < 0:
            k = 0
        while k < size and i + k < n and pattern[k] == text[i + k]:
            k += 1
        out[i] = k
        left, right = i, i + k
    return out


def z_function(s: list[int], stop: int) -> list[int]:
    """How many words from each place below ``stop`` on agree with the beginning."""
    out = [0] * stop
    n = len(s)
    if stop:
        out[0] = n
    left = right = 1
    for i in range(1, stop):
        k = right - i
        if k > 0 and out[i - left] < k:
            out[i] = out[i - left]
            continue
        if k < 0:
            k = 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        out[i] = k
        left, right = i, i + k
    return out


def crossing(w: list[int], low: int, mid: int, high: int) -> Iterator[Run]:
    """The repetitions of ``w[low:high]`` around the midpoint that are long enough, as far as they reach within the block."""
    most = (high - low) // TIMES
    before, after = w[low:mid][::-1], w[mid:high]
    z_before, z_after = z_function(before, min(len(before), most + 1)), z_function(after, min(len(after), most + 1))
    ahead = prefixes(before, z_before, w[low : mid + most][::-1], most)  # ends agree: words before the midpoint, words q later
    behind = prefixes(after, z_after, w[mid - most : high], most)  # beginnings agree: words after the midpoint, words q earlier
    for q in range(1, most + 1):
        least = max(LEAST, TIMES * q)
        left, right = ahead[most - q], z_after[q]
        if left + right + q >= least:
            yield mid - left, mid + right + q, q
        left, right = z_before[q], behind[most - q]
        if left + right + q >= least:
            yield mid - q - left, mid + right, q


def runs_of(w: list[int]) -> list[Run]:
    """All runs of interned words, by start, then period."""
    found: dict[tuple[int, int], int] = {}
    n = len(w)
    todo = [(0, n)]
    while todo:
        low, high = todo.pop()
        if high - low < LEAST:
            continue
        mid = (low + high) // 2
        for a, b, q in crossing(w, low, mid, high):
            cut = (a == low and a > 0 and w[a - 1] == w[a - 1 + q]) or (b == high and b < n and w[b] == w[b - q])
            if not cut and q < found.get((a, b), n):
                found[a, b] = q
        todo += [(low, mid), (mid, high)]
    return sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def stretches(w: list[int], rounds: int = 8) -> list[tuple[int, int]]:
    """Parts of the text outside which there is no run."""
    n = len(w)
    if n < LEAST:
        return []
    with np.errstate(over="ignore"):
        h = mix(np.array(w, np.uint64) + np.uint64(1))
        step = 1
        while step < GRAM:
            h = mix(h[:-step] * np.uint64(0x9E3779B97F4A7C15) + h[step:])
            step *= 2
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return []
    near = np.full(len(h), n, np.int64)  # to the same gram, the nearest
    earlier, later = order[:-1][same], order[1:][same]
    near[earlier] = later - earlier
    near[later] = np.minimum(near[later], later - earlier)
    done: list[tuple[int, int]] = []
    todo = [(0, n, 0)]
    while todo:
        a, b, k = todo.pop()
        inside = np.zeros(b - a - GRAM + 3, np.int8)
        inside[1:-1] = near[a : b - GRAM + 1] <= (b - a) // TIMES
        edge = np.flatnonzero(np.diff(inside)) + a
        for x, y in zip(edge[::2].tolist(), (edge[1::2] + GRAM - 1).tolist()):
            if y - x >= LEAST:
                if k == rounds or (x, y) == (a, b):
                    done.append((x, y))
                else:
                    todo.append((x, y, k + 1))
    return sorted(done)


def find(words: list[bytes]) -> list[Run]:
    """All runs of a text's words, by start, then period."""
    names: dict[bytes, int] = {}
    w = [names.setdefault(x, len(names)) for x in words]
    out = [(x + a, x + b, q) for x, y in stretches(w) for a, b, q in runs_of(w[x:y])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for a, b, q in runs:
        change[a + q] += 1
        change[b] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``id_col, n_words, runs, collapsed``: every text's runs (``start, length, period`` in words) and what is left when each keeps its first period.

    Words are what stands between ASCII white space. ``edit``: from an id and the words to the words that are searched, for tests of other rows.
    """
    kind = dict(docs.dtypes)[id_col]
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids: list = []
            counts: list[int] = []
            runs: list[list[dict]] = []
            texts: list[bytes] = []
            size = 0

            def made(id_type: pa.DataType = b.schema.field(0).type) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(counts, pa.int64()), pa.array(runs, run_type), pa.array(texts, pa.string())], names=[id_col, "n_words", "runs", "collapsed"])

            for k in range(b.num_rows):
                i, text = b.column(0)[k].as_py(), b.column(1)[k].as_py()
                words = (text or "").encode().split()
                if edit is not None:
                    words = edit(i, words)
                found = find(words)
                left = b" ".join(collapse(words, found))
                if size + len(left) > CHUNK and ids:
                    yield made()
                    for x in (ids, counts, runs, texts):
                        x.clear()
                    size = 0
                ids.append(i)
                counts.append(len(words))
                runs.append([{"start": s, "length": e - s, "period": q} for s, e, q in found])
                texts.append(left)
                size += len(left)
            if ids:
                yield made()

    return in_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
