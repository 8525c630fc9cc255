"""Packing by non-negative least squares over the histogram of lengths (operator 9).

A document is its ids and an end id. Every full window of it is a sequence of its own; what is left is one piece shorter
than a window. The histogram of these lengths has at most ``window`` bins, whatever the input. Combinations of up to
``depth`` lengths that fill a window exactly are the columns of a sparse matrix; non-negative repeat counts that match the
histogram best are found by accelerated projected gradients, rounded to the nearest number and held to what is left of each
length, so that none is used more often than it occurs. The pieces left over are packed greedily, longest first, each with the longest left that still fits; where that
does not nearly fill a sequence, they are cut at powers of two down to ``GRAIN`` and their parts packed in the same way.

The plan says how many sequences have which combination. So each length is a row of places, and a piece takes the place of
its rank among the pieces of its length: its rank within its part of the table plus the pieces of that length in the parts
before. No piece moves to the driver, and no length is gathered in one task.

Defined results: a null or empty text is the end id alone. Repeated rows are documents of their own and each of their ids
lies in exactly one piece; rows that repeat an id appear under that id as often. A text that holds an added token of the
vocabulary gets that token's id there, as the library's plain call does, and what stands between added tokens is split on
its own. Texts are encoded whole. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import Cache, slices
from .shared import in_arrow, materialize

WINDOW, DEPTH, STEPS, END_ID, GRAIN = 1024, 3, 400, 0, 32


#: Bytes that byte-level vocabularies write as themselves; the others are written as 256 and following.
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


class LibraryEncoder(Cache):
    """From pre-token slices to ids as little-endian unsigned 32-bit integers, by the ``tokenizers`` library, each slice once.

    The library cuts a text at added tokens, splits what is between by the same pattern, and then merges; so the ids of a
    text are those of its slices and added tokens in order. Its merges are called without the split.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        library = Tokenizer.from_file(path)
        added = library.get_added_tokens_decoder()
        if library.normalizer is not None or any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError(f"{path}: a vocabulary without normalisation and with plain added tokens is needed")
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items() if t.content}
        # Of added tokens that start at one place the longest counts.
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.merges = library.model.tokenize
        others = (b for b in range(256) if b not in PRINTED)
        self.letters = {b: b for b in PRINTED} | {b: 256 + i for i, b in enumerate(others)}

    def __missing__(self, piece: str) -> bytes:
        self.room(1)
        if (v := self.revive(piece)) is not None:
            return v
        out = np.array([t.id for t in self.merges(piece.encode().decode("latin-1").translate(self.letters))], "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = out
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        marks = [[m.span() for m in self.cut.finditer(t)] if self.cut else [] for t in texts]
        between = [t[a:b] for t, found in zip(texts, marks) for a, b in zip([0, *(e for _, e in found)], [*(s for s, _ in found), len(t)])]
        made = slices(between)
        for t, found in zip(texts, marks):
            out = list(map(self.__getitem__, next(made)))
            for a, b in found:
                out.append(self.added[t[a:b]])
                out += map(self.__getitem__, next(made))
            yield b"".join(out)


@lru_cache(2)
def encoder(path: str) -> LibraryEncoder:
    with open(path, encoding="utf-8") as f:
        json.load(f)  # a clear error for a file of another kind
    return LibraryEncoder(path)


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``id, start, length, ids_crc32, doc_tokens, part, nth, crcs``: every document's pieces.

    ``nth`` counts a length within a part; ``crcs`` are the checksums of the first 32, 64, ... ids of a piece shorter than
    the window, from which those of its parts follow.
    """
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth", "crcs"]
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        e = encoder(vocabulary)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for b in batches:
            for k in range(0, b.num_rows, 512):
                rows = b.slice(k, 512)
                out: list[list[int]] = [[], [], [], []]
                ids, crcs = [], []
                for i, s in zip(rows.column(0).to_pylist(), e.encode([t or "" for t in rows.column(1).to_pylist()])):
                    x = memoryview(s + end)
                    n = len(x) // 4
                    for a in range(0, n, window):
                        ids.append(i)
                        size = min(window, n - a)
                        crc, sums = 0, []
                        if size < window:
                            for g in range(0, size - GRAIN + 1, GRAIN):
                                crc = zlib.crc32(x[4 * (a + g) : 4 * (a + g + GRAIN)], crc)
                                sums.append(crc)
                        done = len(sums) * GRAIN
                        crcs.append(np.array(sums, "<u4").tobytes())
                        for o, v in zip(out, (a, size, zlib.crc32(x[4 * (a + done) : 4 * (a + size)], crc), n)):
                            o.append(v)
                length = np.array(out[1], np.int64)
                order = np.argsort(length, kind="stable")
                first = np.searchsorted(length[order], length[order])
                nth = np.empty(len(length), np.int64)
                nth[order] = seen[length[order]] + np.arange(len(length)) - first
                seen += np.bincount(length, minlength=window + 1)
                yield pa.RecordBatch.from_arrays([pa.array(ids, rows.column(0).type), *(pa.array(v, pa.int64()) for v in out), pa.array(np.full(len(length), part), pa.int32()), pa.array(nth), pa.array(crcs, pa.binary())], names=names)

    kind = dict(docs.dtypes)[id_col]
    return in_arrow(docs.select(id_col, text_col), run, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part int, nth bigint, crcs binary")


def combinations(present: np.ndarray, window: int, depth: int) -> np.ndarray:
    """All multisets of up to ``depth`` (two or three) present lengths that fill the window, padded with 0."""
    here = np.zeros(window + 1, bool)
    here[present] = True
    out = []
    a = present[(present <= window // 2)]
    a = a[here[window - a]]
    out.append(np.stack([window - a, a, np.zeros_like(a)], 1))
    if depth > 2:
        for c in present[present <= window // 3]:
            b = present[(present >= c) & (present <= (window - c) // 2)]
            b = b[here[window - c - b]]
            out.append(np.stack([window - c - b, b, np.full_like(b, c)], 1))
    return np.concatenate(out)


def least_squares(columns: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative repeat counts whose lengths come nearest to ``counts``, each length weighed by its share of ids."""
    if not len(columns):
        return np.zeros(0)
    n = len(counts)
    weight = np.arange(n, dtype=float) / n
    flat, used = columns.ravel(), (columns > 0).ravel()

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat[used], np.repeat(x, columns.shape[1])[used], n)

    def backward(r: np.ndarray) -> np.ndarray:
        r = r.copy()
        r[0] = 0
        return r[columns].sum(1)

    x = np.random.default_rng(3).random(len(columns))  # the largest eigenvalue, by powers
    for _ in range(30):
        x = backward(weight**2 * forward(x))
        norm = float(np.linalg.norm(x))
        x /= norm or 1
    step = 1 / (1.05 * norm or 1)
    x = y = np.zeros(len(columns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * backward(weight**2 * (forward(y) - counts)))
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / u * (new - x)
        x, t = new, u
    return x


def greedy(left: np.ndarray, window: int, least: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, filled up with the longest piece that still fits. Sequences below ``least`` ids are not made; takes from ``left``."""
    out, skipped = [], np.zeros_like(left)
    while left.any():
        combo, room, after = [], window, left.copy()
        while room and (fit := np.flatnonzero(after[: room + 1])).size:
            combo.append(int(fit[-1]))
            after[fit[-1]] -= 1
            room -= int(fit[-1])
        if window - room < least:
            skipped[combo[0]] += left[combo[0]]
            left[combo[0]] = 0
            continue
        use = min(int(left[v]) // combo.count(v) for v in set(combo))
        out.append((tuple(combo), use))
        for v in combo:
            left[v] -= use
    left += skipped
    return out


def parts_of(n: int) -> list[int]:
    """Powers of two from the largest down to the grain, then the rest."""
    return [1 << k for k in range(n.bit_length() - 1, GRAIN.bit_length() - 2, -1) if n >> k & 1] + [n % GRAIN] * (n % GRAIN > 0)


Plan = list[tuple[tuple[int, ...], int]]


def plan(counts: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> tuple[Plan, Plan, np.ndarray]:
    """counts[n]: pieces of length n. Returns combinations of lengths and how often each is used, for whole pieces and for
    parts of pieces that are cut, and how many pieces of each length stay whole."""
    left = counts.astype(np.int64).copy()
    out: Plan = []
    if left[window]:
        out.append(((window,), int(left[window])))
        left[window] = 0
    columns = combinations(np.flatnonzero(left), window, depth)
    repeat = least_squares(columns, left.astype(float))
    for i in np.argsort(-repeat, kind="stable").tolist():
        if repeat[i] <= 0:
            break
        combo = [int(v) for v in columns[i] if v]
        use = min(int(round(repeat[i])), *(int(left[v]) // combo.count(v) for v in combo))
        if use > 0:
            out.append((tuple(combo), use))
            for v in combo:
                left[v] -= use
    out += greedy(left, window, window - window // 128)
    kept = counts - left
    rest = np.zeros_like(left)
    for n in np.flatnonzero(left).tolist():
        for p in parts_of(n):
            rest[p] += left[n]
    return out, greedy(rest, window, 0), kept


def places(made: Plan, base: int = 0) -> list[tuple[int, int, int, int]]:
    """(length, first rank, sequence of that rank, offset) of each run of places of one length; sequences count from base."""
    used: dict[int, int] = {}
    out = []
    for combo, times in made:
        offset = 0
        for n in combo:
            out.append((n, used.get(n, 0), base, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        base += times
    return out


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, depth: int = DEPTH) -> DataFrame:
    """``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece."""
    cut = materialize(pieces(docs, vocabulary, id_col, text_col, window), "pieces")
    tally = materialize(cut.groupBy("part", "length").agg(F.count("*").alias("c")), "tally")
    counts = np.zeros(window + 1, np.int64)
    for r in tally.groupBy("length").agg(F.sum("c").alias("c")).collect():  # at most ``window`` rows
        counts[r["length"]] = r["c"]
    whole, cuts, kept = plan(counts, window, depth)
    sorted_runs = lambda runs: np.array(sorted(runs), np.int64).reshape(-1, 4)
    runs = sorted_runs(places(whole)), sorted_runs(places(cuts, sum(u for _, u in whole)))
    # Where the ranks of the parts begin that come from pieces of one length.
    begins: dict[tuple[int, int], int] = {}
    total: dict[int, int] = {}
    for n in np.flatnonzero(counts - kept).tolist():
        for p in parts_of(n):
            begins[n, p] = total.get(p, 0)
            total[p] = total.get(p, 0) + int(counts[n] - kept[n])
    before = F.sum("c").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = tally.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    # As many rows as the plan has places: bounded by the window, not by the input. The tally grows with the table's parts,
    # so it is never broadcast.
    table = docs.sparkSession.sparkContext.broadcast((*runs, kept, begins))
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def find(runs: np.ndarray, n: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(n), np.int64)
        for v in np.unique(n).tolist():
            a, b = np.searchsorted(runs[:, 0], [v, v + 1])
            at[n == v] = a + np.searchsorted(runs[a:b, 1], r[n == v], side="right") - 1
        return runs[at, 2] + r - runs[at, 1], runs[at, 3]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, parts, kept, begins = table.value
        zeros = bytes(4 * window)
        for b in batches:
            n, r = b.column(2).to_numpy(), b.column(5).to_numpy()
            stay = r < kept[n]
            if stay.any():
                own = b.filter(pa.array(stay))
                sequence, offset = find(whole, n[stay], r[stay])
                yield pa.RecordBatch.from_arrays([*own.columns[:5], pa.array(sequence), pa.array(offset)], names=names)
            rows: list[tuple] = []
            for i, start, size, crc, tokens, rank, crcs in zip(*(c.to_pylist() for c in b.filter(pa.array(~stay)).columns)):
                sums = [0, *np.frombuffer(crcs, "<u4").tolist()]
                at = 0
                for p in parts_of(size):
                    upto = crc if at + p == size else sums[(at + p) // GRAIN]
                    # The checksum of what follows is that of the whole less the first part's, shifted by as many zeros.
                    own = upto ^ zlib.crc32(zeros[: 4 * p], sums[at // GRAIN]) ^ zlib.crc32(zeros[: 4 * p])
                    rows.append((i, start + at, p, own, tokens, begins[size, p] + rank - int(kept[size])))
                    at += p
            if rows:
                ids, *cols = zip(*rows)
                cols = [np.array(c, np.int64) for c in cols]
                sequence, offset = find(parts, cols[1], cols[4])
                yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), *map(pa.array, cols[:4]), pa.array(sequence), pa.array(offset)], names=names)

    kind = dict(docs.dtypes)[id_col]
    ranked = cut.join(offsets.hint("merge"), ["part", "length"]).select("id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("nth")).alias("r"), "crcs")
    return in_arrow(ranked, place, f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
