"""Byte-level BPE as a streaming transducer with bounded lookahead (operator 11).

The merge list alone says how far ahead a merge can depend on what follows. Take two texts that begin alike and run the rules in their
order. As long as both have the same tokens up to some place, a rule ``(a, b)`` moves that place only where the last common token is ``a`` and
one text alone goes on with ``b``; then it moves back by ``a``. The next rule to move it must come later in the list, and what
follows the place now begins with ``a`` in both texts; so ``a`` lies on the left edge of its right part. The longest such chain of rules, in
bytes, is the ``lookahead`` of the list (``MergeList.lookahead``): a token that ends so many bytes before the end of what has
been read is the same whatever follows. Nothing is merged across the end of such a token, so what is behind it can be merged anew on its own.

Two machines run one after another. ``Slicer`` takes a text in blocks and carries the state of a small automaton and two
characters of lookahead across them; it cuts slices where the split pattern of byte-level vocabularies does. ``Merger`` gets the slices in
fragments, holds ``lookahead + HOLD`` bytes of an open slice at most, and emits the tokens that are stable. Both hold
constant memory, however long a text or a slice is. Short slices that begin and end within a block recur, so their ids are cached.

Decoding is a machine as well: each id gives its bytes, and characters come out as soon as they are complete; at most three bytes wait.
Bytes that aren't UTF-8 become U+FFFD, as in the library.

Defined results: a null text counts as empty and has no ids. An added token of the vocabulary that stands in a text gets its own id, as
in the library's plain call; what is between added tokens is split on its own. Repeated rows are each encoded. Other columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import math
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .byte_bpe import START, STOP, Cache, monoid, step, symbols
from .nnls_packing import PRINTED
from .shared import in_arrow

#: Characters of a block; bytes that an open slice is let grow to beyond the lookahead before stable tokens are emitted.
BLOCK, HOLD = 1 << 17, 1 << 10
#: Longest slice in bytes that is cached.
SHORT = 64
_STOP = 0xFFFFFFFF
_ID, _NONE = (1 << 32) - 1, 1 << 62


class MergeList:
    """Merges in their order, and ids of tokens, from a ``tokenizers`` file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, added = file["model"], file.get("added_tokens") or []
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        split = file.get("pre_tokenizer") or {}
        if odd or file.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or any(t[k] for t in added for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError(f"{path}: a byte-level vocabulary without normalisation and with plain added tokens is needed")
        others = (b for b in range(256) if b not in PRINTED)
        letters = {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}
        spelled = {**{t: i for t, i in model["vocab"].items()}, **{t["content"]: t["id"] for t in added}}
        #: The bytes of each id. A token with a character that stands for no byte is text itself.
        self.bytes = {i: bytes(map(letters.__getitem__, t)) if all(c in letters for c in t) else t.encode() for t, i in spelled.items()}
        self.added = {t["content"]: t["id"] for t in added if t["content"]}
        # Of added tokens that start at one place the longest counts.
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        vocab = model["vocab"]
        self.first = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]  # the id of each byte
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        #: (left id, right id) -> rank * 2**32 + id of both, in order of rank
        self.rules = {(vocab[a], vocab[b]): (k << 32) + vocab[a + b] for k, (a, b) in enumerate(pairs)}
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        """The bytes of the longest chain of rules that can hand a difference on to the left."""
        left_part: dict[int, int] = {}  # of a merged token
        best: dict[int, int] = {}  # by the left part of a chain's last rule, its bytes
        longest = 0
        for (a, b), rule in self.rules.items():  # in their order
            both, chain, edge = rule & _ID, 0, b
            while edge is not None:
                chain = max(chain, best.get(edge, 0))
                edge = left_part.get(edge)
            chain += len(self.bytes[a])
            best[a] = max(best.get(a, 0), chain)
            left_part.setdefault(both, a)
            longest = max(longest, chain)
        return max(1, longest)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a slice: of adjacent pairs the one of the least rank, and of these the first, is joined until none has a rank."""
        if len(piece) > SHORT:
            return self._merge_long(piece)
        ids, get = list(map(self.first.__getitem__, piece)), self.rules.get
        rules = [get(p, _NONE) for p in zip(ids, ids[1:])]
        while rules and (rule := min(rules)) != _NONE:
            i = rules.index(rule)
            ids[i : i + 2] = [rule & _ID]
            del rules[i]
            if i:
                rules[i - 1] = get((ids[i - 1], ids[i]), _NONE)
            if i < len(rules):
                rules[i] = get((ids[i], ids[i + 1]), _NONE)
        return ids

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap and linked tokens, in n log n steps."""
        ids, rules, n = list(map(self.first.__getitem__, piece)), self.rules, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r >> 32, i, r & _ID, *p) for i, p in enumerate(zip(ids, ids[1:])) if (r := rules.get(p)) is not None]
        heapq.heapify(heap)

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (r := rules.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (r >> 32, i, r & _ID, ids[i], ids[j]))

        while heap:
            _, i, both, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = both, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [x for x in ids if x >= 0]


class Slicer:
    """Where the slices of a text start, over blocks of it. What was fed and isn't judged yet is at most two characters."""

    def __init__(self) -> None:
        self.state, self.wait = START, ""

    def feed(self, text: str, end: bool) -> tuple[str, list[int]]:
        """(the characters that are judged now, the places among them where a slice starts). With ``end`` the text is over and all are judged."""
        text = self.wait + text
        points = np.frombuffer((text + "\0" if end else text).encode("utf-32-le"), np.uint32).copy()
        if end:
            points[-1] = _STOP
        ready = len(text) if end else max(0, len(text) - 2)
        self.wait = text[ready:]
        if not ready:
            self.state = START if end else self.state
            return "", []
        at, self.state = _starts(symbols(points)[:ready], self.state)
        if end:
            self.state = START
        return text[:ready], at


@lru_cache(1)
def _values() -> np.ndarray:
    """The state that each function of the automaton's monoid makes of each state."""
    _, product, _, _ = monoid()
    out = np.zeros((len(product), 8), np.uint8)
    out[0] = np.arange(8)
    function = monoid()[0]
    known, todo = {0}, [0]
    while todo:
        f = todo.pop()
        for x, own in enumerate(function.tolist()):
            g = int(product[f, own])
            if g not in known:
                out[g] = [step(int(s), x)[0] for s in out[f]]
                known.add(g)
                todo.append(g)
    return out


def _starts(sym: np.ndarray, state: int) -> tuple[list[int], int]:
    """Where slices start among the symbols, and the state after them: parts advance together, then their products are composed."""
    function, product, _, starts = monoid()
    n = len(sym)
    width = min(256, math.isqrt(n) + 1)
    blocks = -(-n // width)
    grid = np.zeros(blocks * width, np.uint8)  # the identity behind the last symbol
    grid[:n] = function[sym]
    grid = np.ascontiguousarray(grid.reshape(blocks, width).T)
    before = np.empty((width, blocks), np.uint8)
    acc = np.zeros(blocks, np.uint8)
    flat, m = product.ravel(), product.shape[0]
    for k in range(width):
        before[k] = acc
        acc = flat[acc.astype(np.uint16) * m + grid[k]]
    into, value = [state], _values()
    for f in acc.tolist():
        into.append(int(value[f, into[-1]]))
    at = value[before, np.array(into[:-1], np.uint8)[None, :]].T.reshape(-1)[:n]
    return np.flatnonzero(starts[at, sym]).tolist(), into[-1]


class Merger:
    """Ids of slices that come in fragments, emitted once stable. ``held`` is the most bytes that have waited."""

    def __init__(self, merges: MergeList) -> None:
        self.merges, self.open, self.held = merges, b"", 0

    def feed(self, fragment: bytes) -> list[int]:
        """Tokens of the open slice that no later byte can change."""
        out: list[int] = []
        look, most = self.merges.lookahead, self.merges.lookahead + HOLD
        for a in range(0, len(fragment), HOLD):
            self.open += fragment[a : a + HOLD]
            self.held = max(self.held, len(self.open))
            if len(self.open) >= most:
                stable = len(self.open) - look
                end = 0
                for t in self.merges.merge(self.open):
                    size = len(self.merges.bytes[t])
                    if end + size > stable:
                        break
                    out.append(t)
                    end += size
                self.open = self.open[end:]
        return out

    def close(self) -> list[int]:
        """The tokens that are left when the slice ends."""
        out = self.merges.merge(self.open) if self.open else []
        self.open = b""
        return out


class Slices(Cache):
    """Ids of short slices as little-endian unsigned 32-bit integers; fills itself."""

    def __init__(self, merges: MergeList) -> None:
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: str) -> bytes:
        self.room(1)
        if (v := self.revive(piece)) is not None:
            return v
        raw = piece.encode()
        if len(raw) <= SHORT:
            out = self[piece] = np.array(self.merges.merge(raw), "<u4").tobytes()
            return out
        m = Merger(self.merges)
        return np.array(m.feed(raw) + m.close(), "<u4").tobytes()


class Transducer:
    """A vocabulary's encoder and decoder; caches are shared by all texts."""

    def __init__(self, path: str) -> None:
        self.merges = MergeList(path)
        self.cache = Slices(self.merges)
        # ids that a decoder may meet but the vocabulary lacks give no bytes
        self.pieces = [self.merges.bytes.get(i, b"") for i in range(max(self.merges.bytes) + 1)]

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of a text, in parts as they become stable."""
        at = 0
        for found in self.merges.cut.finditer(text) if self.merges.cut else ():
            yield from self._between(text, at, found.start())
            yield np.array([self.merges.added[found[0]]], "<u4").tobytes()
            at = found.end()
        yield from self._between(text, at, len(text))

    def _between(self, text: str, low: int, high: int) -> Iterator[bytes]:
        slicer, merger, get, running = Slicer(), Merger(self.merges), self.cache.__getitem__, False
        for a in range(low, high, BLOCK):
            b = min(high, a + BLOCK)
            judged, cuts = slicer.feed(text[a:b], b == high)
            ids: list[bytes] = []
            if running and judged:
                # A slice is open from an earlier block.
                head = cuts[0] if cuts else len(judged)
                tokens = merger.feed(judged[:head].encode())
                if cuts or b == high:
                    tokens += merger.close()
                ids.append(np.array(tokens, "<u4").tobytes())
            if cuts:
                ids += map(get, [judged[x:y] for x, y in zip(cuts, cuts[1:])])
                if b == high:
                    ids.append(get(judged[cuts[-1] :]))
                else:
                    running = True
                    ids.append(np.array(merger.feed(judged[cuts[-1] :].encode()), "<u4").tobytes())
            yield b"".join(ids)

    def decoder(self) -> Decoder:
        return Decoder(self.pieces)


class Decoder:
    """From ids to text, as they come."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.pieces, self.machine = pieces, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        """The characters that are complete now."""
        return self.machine.decode(b"".join(map(self.pieces.__getitem__, ids)))

    def close(self) -> str:
        """What is left: a cut character counts as one U+FFFD."""
        return self.machine.decode(b"", final=True)


@lru_cache(2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def _each(docs: DataFrame, id_col: str, text_col: str, schema: str, columns: list[pa.Field], row: Callable[[str], tuple], most: int = 1 << 20) -> DataFrame:
    """A row of ``columns`` for every text, handed on by about ``most`` characters of texts."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, size, made = 0, 0, []
            for k in range(b.num_rows):
                text = b.column(1)[k].as_py() or ""
                made.append(row(text))
                size += len(text)
                if size >= most or k + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(made)), *(pa.array(v, f.type) for v, f in zip(zip(*made), columns))], names=[id_col, *(f.name for f in columns)])
                    first, size, made = k + 1, 0, []

    return in_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, {schema}")


def encode_texts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` of every text. vocabulary: a file on every machine."""

    def row(text: str) -> tuple:
        return (np.frombuffer(b"".join(transducer(vocabulary).encode(text)), "<u4").astype(np.int32),)

    return _each(docs, id_col, text_col, "ids array<int>", [pa.field("ids", pa.list_(pa.int32()))], row)


def decode_ids(rows: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text`` of every list of ids (null, and null ids in a list, count as none)."""
    kind = dict(rows.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(vocabulary)
        for b in batches:
            texts = []
            for ids in b.column(1).to_pylist():
                d = t.decoder()
                texts.append(d.feed(i for i in ids or () if i is not None) + d.close())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return in_arrow(rows.select(id_col, ids_col), run, f"`{id_col}` {kind}, text string")


def digest_round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: encodes every text and decodes its ids as they come; neither is ever held whole."""

    def row(text: str) -> tuple:
        t = transducer(vocabulary)
        decoder, n, of_ids, of_text = t.decoder(), 0, hashlib.sha256(), hashlib.sha256()
        for part in t.encode(text):
            ids = np.frombuffer(part, "<u4").tolist()
            if ids:
                of_ids.update(((b"," if n else b"") + b",".join(map(b"%d".__mod__, ids))))
                n += len(ids)
                of_text.update(decoder.feed(ids).encode())
        of_text.update(decoder.close().encode())
        return n, of_ids.hexdigest(), of_text.hexdigest()

    columns = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    return _each(docs, id_col, text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", columns, row)
