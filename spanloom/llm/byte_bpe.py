"""Byte-level BPE without regular expressions (operator 7).

Pre-tokenisation finds the matches of the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^\\s L N]+|\\s+(?!\\S)|\\s+`` in arrays. Each code point gets a class; what a match
needs to know of the characters after it is local (the letters of a contraction, the last of a run of white space), so it
goes into the symbol. What it needs to know of the characters before is the state of a small automaton. Each symbol is a
transition function; the functions that can come up form a finite monoid, kept as a table of products. A scan composes
them: all blocks of the text advance together, one position a step, then the blocks' products are composed and the states
are read off. The slices between boundaries feed pair merging, whose results are cached for each distinct slice.

Defined results: a null text counts as empty and has no ids. Special tokens are ordinary text. Repeated rows are each
encoded. Lone surrogates can't occur in Spark strings. Very long texts are cut only into batches, never into pieces that
are encoded apart. Other columns of the input are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import in_arrow

#: Characters that a worker handles at once, unless one text is longer.
CHUNK = 1 << 19
#: Distinct slices whose ids a worker remembers, in each of two generations.
CACHE = 400_000

OTHER, LETTER, NUMBER, SPACE, WHITE = range(5)
# Symbols: the classes, then variants that depend on the characters after.
QUOTE2, QUOTE3, SPACE_LAST, WHITE_LAST, STOP = range(5, 10)
# States: what the last character was.
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, GLUE, IN_WHITE, TAIL1, TAIL2 = range(8)
#: Code points of the Unicode property White_Space. Fixed values.
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    out[WHITE_SPACE] = WHITE
    out[0x20] = SPACE
    return out


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a symbol, and whether a match starts at it."""
    if symbol == STOP:
        return START, True
    if symbol == SPACE_LAST:
        return GLUE, True
    if symbol == WHITE_LAST:
        return IN_WHITE, True
    if symbol in (SPACE, WHITE):
        return IN_WHITE, state != IN_WHITE
    if symbol in (QUOTE2, QUOTE3) and state not in (IN_OTHER, GLUE):
        return (TAIL1 if symbol == QUOTE2 else TAIL2), True
    if symbol == LETTER:
        if state == TAIL2:
            return TAIL1, False
        if state == TAIL1:
            return START, False
        return IN_LETTERS, state not in (IN_LETTERS, GLUE)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, GLUE)
    return IN_OTHER, state not in (IN_OTHER, GLUE)


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function of each symbol, products, value at START, starts by state and symbol); function 0 is the identity."""
    fs = [tuple(step(s, x)[0] for s in range(8)) for x in range(10)]
    found = {tuple(range(8)): 0}
    todo = list(found)
    for f in todo:
        for g in fs:
            h = tuple(g[s] for s in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    product = np.array([[found[tuple(g[s] for s in f)] for g in found] for f in found], np.uint8)
    starts = np.array([[step(s, x)[1] for x in range(10)] for s in range(8)], np.bool_)
    return np.array([found[f] for f in fs], np.uint8), product, np.array([f[START] for f in found], np.uint8), starts


def symbols(points: np.ndarray) -> np.ndarray:
    """points: code points, a STOP written as 0xFFFFFFFF after each text."""
    stop = points == 0xFFFFFFFF
    out = classes()[np.where(stop, 0, points)]
    out[stop] = STOP
    white = (out == SPACE) | (out == WHITE)
    last = white[:-1] & ~white[1:] & ~stop[1:]
    out[:-1][last & (out[:-1] == SPACE)] = SPACE_LAST
    out[:-1][last & (out[:-1] == WHITE)] = WHITE_LAST
    q = np.flatnonzero(points[: max(0, len(points) - 2)] == ord("'"))
    if len(q):
        a, b = points[q + 1], points[q + 2]
        two = np.isin(a, [ord(c) for c in "stmd"])
        three = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        out[q[two]] = QUOTE2
        out[q[three]] = QUOTE3
    return out


def boundaries(points: np.ndarray, width: int = 256) -> np.ndarray:
    """Where matches start (a STOP counts as one)."""
    sym = symbols(points)
    function, product, at_start, starts = monoid()
    n = len(sym)
    blocks = -(-n // width)
    grid = np.full(blocks * width, STOP, np.uint8)
    grid[:n] = sym
    grid = np.ascontiguousarray(function[grid].reshape(blocks, width).T)
    before = np.empty((width, blocks), np.uint8)
    acc = np.zeros(blocks, np.uint8)
    flat, m = product.ravel(), product.shape[0]
    for k in range(width):
        before[k] = acc
        acc = flat[acc.astype(np.uint16) * m + grid[k]]
    into = np.fromiter(accumulate(acc.tolist()[:-1], lambda f, g: product[f, g], initial=0), np.uint8, blocks)
    state = at_start[product[into[None, :], before]].T.reshape(-1)[:n]
    return np.flatnonzero(starts[state, sym])


def slices(texts: list[str]) -> Iterator[list[str]]:
    """The matches of each text, in order."""
    group: list[str] = []
    size = 0
    for t in texts:
        if group and size + len(t) > CHUNK:
            yield from _slices(group)
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield from _slices(group)


def _slices(texts: list[str]) -> Iterator[list[str]]:
    whole = "\0".join([*texts, ""])  # a place for the STOP after each text
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32).copy()
    points[ends] = 0xFFFFFFFF
    at = boundaries(points)
    last = np.searchsorted(at, ends).tolist()
    first = [0, *(x + 1 for x in last)]
    cuts = at.tolist()
    for a, b in zip(first, last):
        own = cuts[a : b + 1]  # up to this text's STOP
        yield [whole[x:y] for x, y in zip(own, own[1:])]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair with the lowest rank is joined until none has a rank."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    if n > 64:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(n)]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and linked parts, so that one very long slice takes n log n steps."""
    import heapq

    n = len(piece)
    end = list(range(1, n + 1))  # part i is piece[i:end[i]], if alive
    prev, alive = list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Cache(dict):
    """From slices to bytes, in two generations of CACHE entries each: what was not used while the younger one filled up is forgotten."""

    def __init__(self) -> None:
        self.older: dict[str, bytes] = {}

    def room(self, n: int) -> None:
        if len(self) + n > CACHE:
            self.older = dict(self)
            self.clear()

    def revive(self, piece: str) -> bytes | None:
        """The value from the older generation, which brings it into the younger one."""
        if (v := self.older.get(piece)) is not None:
            self[piece] = v
        return v


class Encoder(Cache):
    """From slices to their ids as little-endian unsigned 32-bit integers; fills itself."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        self.room(1)
        if (v := self.revive(piece)) is not None:
            return v
        out = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = out
        return out


class Tokenizer:
    """Ranks of a public vocabulary file, one base64 piece and its rank a line."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        self.piece = {v: k for k, v in self.ranks.items()}
        self.encoder = Encoder(self.ranks)

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        get = self.encoder.__getitem__
        for s in slices(list(texts)):
            yield b"".join(map(get, s))

    def decode(self, ids: bytes) -> tuple[bytes, np.ndarray]:
        """The bytes, and the byte offset at which each id starts."""
        pieces = list(map(self.piece.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        return b"".join(pieces), np.cumsum(lengths) - lengths


@lru_cache(4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def encode_texts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids, offsets``: the ids and the byte offset at which each starts. vocabulary: a file on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(vocabulary)
        for b in batches:
            for ids, part in _encoded(t, b):
                offsets = [t.decode(x)[1] for x in ids]
                yield pa.RecordBatch.from_arrays([part, pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(offsets, pa.list_(pa.int64()))], names=[id_col, "ids", "offsets"])

    kind = dict(docs.dtypes)[id_col]
    return in_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, ids array<int>, offsets array<bigint>")


def _encoded(t: Tokenizer, b: pa.RecordBatch, rows: int = 512) -> Iterator[tuple[list[bytes], pa.Array]]:
    for k in range(0, b.num_rows, rows):
        texts = [x or "" for x in b.column(1).slice(k, rows).to_pylist()]
        yield list(t.encode(texts)), b.column(0).slice(k, rows)


def digest_round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: encodes every text, decodes the ids, and keeps only digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(vocabulary)
        for b in batches:
            for ids, part in _encoded(t, b):
                sha = [hashlib.sha256(x).hexdigest() for x in ids]
                back = [hashlib.sha256(t.decode(x)[0]).hexdigest() for x in ids]
                yield pa.RecordBatch.from_arrays([part, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(sha), pa.array(back)], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)[id_col]
    return in_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
