"""Toxicity by compression distance (operator 6).

Two dictionaries are trained by zstandard's own trainer (COVER), one on windows of ordinary texts, one on windows of toxic
texts. A text is cut into windows of a few words; each window is compressed with either dictionary, and what the toxic one
saves, where it saves at least a calibrated number of bytes, is added up over the windows of the text and divided by the
root of their number, as chance savings grow with it. A calibrated monotone step function of that is the score.

Words are too short for a compressor: a match costs almost what it saves. So before training and compressing, each byte of
a word becomes four bytes, a hash of the word up to there. Equal beginnings of words stay equal (a whole word
differs from the same beginning of a longer one in its last code), a beginning of some letters is long enough to pay, and
what words share in their middle no longer matches.

Most of a toxic text is made of ordinary words, and a dictionary trained on it as it stands would hold these. So what tells
toxic texts is found first: beginnings of words (whole words are such) that stand in more toxic documents than their share of ordinary ones
lets expect, by ``SIGMAS`` standard deviations. A word is kept in the toxic windows up to its longest such beginning; a word without one is left out.
The README says what this adds. Words of fewer than ``TAUGHT`` ordinary documents, which may be parts of toxic ones by
chance, are left out of the ordinary windows. At last the ordinary dictionary is put behind the toxic one, so that
both know all ordinary words at the same distance, and lengths differ by what toxic texts alone have.

Training uses a bounded sample of the labelled rows: at most ``MAX_ROWS`` documents, chosen by a hash of the id, and of
these as many, in the order of their ids' hashes, as ``MAX_BYTES`` hold; the ordinary dictionary is trained on at most
``MAX_WINDOWS`` evenly spread windows of them. Dictionaries for the
calibration of a part of the sample (one of ``FOLDS``) come from the other parts. Labels, language, source and id are no inputs of a score.

Defined results: a null or empty text, or one without words, has the score of a text without toxic windows. A label that is
null is left out; several labels of one document count by their mean; of several texts with one id the one with the least
hash is learnt from. Without labels of both classes no window is toxic. Repeated rows get equal scores. Texts are read
whole. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .additive_quality import training_labels
from .shared import drop_path, give_back, in_arrow, keep_rows, written

#: Labelled rows used in training and bytes of their texts, words in a window, bytes of text handled at once.
MAX_ROWS, MAX_BYTES, WINDOW, CHUNK = 6_000, 48 << 20, 12, 1 << 18
#: Bytes of the ordinary dictionary and of the toxic one; windows that the first is trained on; bytes of a sample at most.
ORDINARY_BYTES, TOXIC_BYTES, MAX_WINDOWS, PART = 120_000, 8_192, 80_000, 1_024
#: By how many standard deviations a beginning must be more frequent in toxic documents; in how many ordinary documents a
#: word must stand to be in their windows.
SIGMAS, TAUGHT = 10, 2
#: Parts of the sample for calibration.
FOLDS = 4
WIDTH = 4
_PRIME, _MIX = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93
#: Tells the last byte of a word from the same beginning of a longer one.
_END = 0xA0761D6478BD642F
_INVERSE = pow(_PRIME, -1, 2**64)


def _letter_table() -> np.ndarray:
    """Random weights of the bytes of words, 0 for all others; capitals weigh as small letters."""
    t = np.random.default_rng(20).integers(1, 2**63, 256, np.uint64)
    for c in range(128):
        if not chr(c).isalnum():
            t[c] = 0
    t[ord("A") : ord("Z") + 1] = t[ord("a") : ord("z") + 1]
    return t


TABLE = _letter_table()
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        with np.errstate(over="ignore"):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[base] = np.multiply.accumulate(p)
    return _powers[base][:n]


def hash_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all bytes in words, where each word starts among them, where it starts in ``raw``)."""
    w = TABLE[raw]
    inside = w != 0
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    at = np.flatnonzero(start)
    n = len(raw)
    with np.errstate(over="ignore"):
        total = np.cumsum(w * _power(_PRIME, n))
        before = np.zeros(len(at), np.uint64)
        before[at > 0] = total[at[at > 0] - 1]
        word = (np.cumsum(start) - 1)[inside]
        h = (total[inside] - before[word]) * _power(_INVERSE, n)[at][word]
        h[np.append((np.cumsum(inside) - 1)[at][1:] - 1, len(h) - 1) if len(at) else []] ^= np.uint64(_END)
        h ^= h >> np.uint64(29)
        h *= np.uint64(_MIX)
    return h, (np.cumsum(inside) - 1)[at], at


def coded(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype("<u4")


def _params() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(
        window_log=18, hash_log=17, chain_log=18, search_log=4, min_match=5, strategy=zstandard.STRATEGY_LAZY,
        write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )


class Compressor:
    def __init__(self, dictionary: bytes) -> None:
        d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=_params())
        self.c = zstandard.ZstdCompressor(compression_params=_params(), dict_data=d)

    def lengths(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        segments = np.stack([starts, sizes], 1).astype("<u8").tobytes()
        out = self.c.multi_compress_to_buffer(zstandard.BufferWithSegments(data, segments), threads=0)
        return np.fromiter((len(out[i]) for i in range(len(starts))), np.int64, len(starts))


def total(doc: np.ndarray, saved: np.ndarray, least: int, n: int) -> np.ndarray:
    """Bytes saved over the windows of each text that save enough."""
    return np.bincount(doc, np.where(saved >= max(1, least), saved, 0), n).astype(np.int64)


def per_root(doc: np.ndarray, saved: np.ndarray, least: int, n: int) -> np.ndarray:
    """The same over the root of the number of windows."""
    return total(doc, saved, least, n) / np.sqrt(np.maximum(1, np.bincount(doc, minlength=n)))


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    least: int = 0
    steps: list[tuple[float, float]] = field(default_factory=list)  # from which saving on, which score

    def windows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the text of each window, the bytes that the toxic dictionary saves on it)."""
        docs, saved = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if not self.toxic or not texts:
            return docs[0], saved[0]
        if not hasattr(self, "_made"):
            self._made = Compressor(self.ordinary), Compressor(self.toxic)
        first, size, group = 0, 0, []
        for i, t in enumerate([*texts, None]):
            b = b"" if t is None else t.encode() + b"\n"
            if group and (t is None or size + len(b) > CHUNK):
                d, x = self._windows(group)
                docs.append(d + first)
                saved.append(x)
                first, size, group = i, 0, []
            group.append(b)
            size += len(b)
        return np.concatenate(docs), np.concatenate(saved)

    def _windows(self, group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        h, starts, at = hash_words(np.frombuffer(b"".join(group), np.uint8))
        codes = coded(h)
        doc = np.searchsorted(np.cumsum([len(b) for b in group]), at, side="right")
        first_word = np.searchsorted(doc, np.arange(len(group)))
        heads = np.flatnonzero((np.arange(len(starts)) - first_word[doc]) % WINDOW == 0)
        if not len(heads):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a = starts[heads] * WIDTH
        n = np.diff(np.append(a, len(codes) * WIDTH))
        data = codes.tobytes()
        ordinary, toxic = (c.lengths(data, a, n) for c in self._made)
        return doc[heads], ordinary - toxic

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_made"}

    def likelihood(self, saved: np.ndarray) -> np.ndarray:
        at = np.array([x for x, _ in self.steps] or [-np.inf])
        value = np.array([v for _, v in self.steps] or [0.0])
        return value[np.searchsorted(at, saved, side="right") - 1]

    def score(self, texts: list[str]) -> np.ndarray:
        return self.likelihood(per_root(*self.windows(texts), self.least, len(texts)))


@dataclass
class Words:
    """The words of some texts: hashes and codes of their bytes, and for each word its place, hash and text."""

    beginnings: np.ndarray  # at each byte of a word, the hash of the word up to there
    codes: bytes
    starts: np.ndarray  # in bytes of codes, as the sizes
    sizes: np.ndarray
    whole: np.ndarray  # hash of each word
    doc: np.ndarray
    texts: int

    @staticmethod
    def of(texts: list[str]) -> Words:
        raw = [t.encode() + b"\n" for t in texts]
        h, starts, at = hash_words(np.frombuffer(b"".join(raw), np.uint8))
        doc = np.searchsorted(np.cumsum([len(b) for b in raw]), at, side="right")
        sizes = np.diff(np.append(starts, len(h)))
        whole = h[starts + sizes - 1] if len(starts) else np.zeros(0, np.uint64)
        return Words(h, coded(h).tobytes(), starts * WIDTH, sizes * WIDTH, whole, doc, len(texts))

    def text(self, i: int) -> bytes:
        return self.codes[self.starts[i] : self.starts[i] + self.sizes[i]]

    def windows(self, keep: np.ndarray) -> Iterator[bytes]:
        """The kept words of each text, ``WINDOW`` at a time."""
        at = np.flatnonzero(keep)
        first = np.searchsorted(self.doc[at], np.arange(self.texts))
        nth = np.arange(len(at)) - first[self.doc[at]]
        cuts = np.append(np.flatnonzero(nth % WINDOW == 0), len(at)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            yield b"".join(map(self.text, at[a:b].tolist()))


def _chunks(texts: list[str]) -> Iterator[Words]:
    """So that memory follows the size of a chunk and not that of the sample."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > CHUNK:
            yield Words.of(texts[first:i])
            first, size = i, 0
        size += len(t)
    if texts:
        yield Words.of(texts[first:])


def _once(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The distinct hashes of each text."""
    order = np.lexsort((h, doc))
    v, d = h[order], doc[order]
    return v[np.concatenate([[True], (v[1:] != v[:-1]) | (d[1:] != d[:-1])])] if len(v) else v


def _tally(parts: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, how often each comes), with no more held than these and about a million values beside."""
    words, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    wait: list[np.ndarray] = []
    for v in itertools.chain(parts, [None]):
        if wait and (v is None or sum(map(len, wait)) > 1_000_000 + len(words)):
            u, c = np.unique(np.concatenate(wait), return_counts=True)
            both, at = np.unique(np.concatenate([words, u]), return_inverse=True)
            words, count = both, np.bincount(at, np.concatenate([count, c]), len(both)).astype(np.int64)
            wait = []
        if v is not None:
            wait.append(v)
    return words, count


def _beginnings(w: Words) -> np.ndarray:
    return _once(w.beginnings, np.repeat(w.doc, w.sizes // WIDTH))


def _looked_up(words: np.ndarray, value: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted word, 0 where it isn't among the sorted words."""
    if not len(words):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(words, wanted), len(words) - 1)
    return np.where(words[at] == wanted, value[at], 0)


def telling(bad: list[str], plain: list[str]) -> np.ndarray:
    """Hashes of the beginnings that are that much more frequent in toxic documents, sorted."""
    found, toxic_in = _tally(_beginnings(w) for w in _chunks(bad))
    ordinary_in = np.zeros(len(found), np.int64)
    for w in _chunks(plain):
        v = _beginnings(w)
        at = np.minimum(np.searchsorted(found, v), max(0, len(found) - 1))
        np.add.at(ordinary_in, at[found[at] == v] if len(found) else [], 1)
    share = (ordinary_in + 0.5) / (len(plain) + 1)
    expected = share * len(bad)
    return found[toxic_in - expected >= SIGMAS * np.sqrt(expected * np.maximum(0, 1 - share))]


def up_to(w: Words, wanted: np.ndarray) -> np.ndarray:
    """Of each word the bytes of its codes up to the longest wanted beginning."""
    good = np.flatnonzero(np.isin(w.beginnings, wanted))
    word = np.repeat(np.arange(len(w.whole)), w.sizes // WIDTH)[good]
    out = np.zeros(len(w.whole), np.int64)
    np.maximum.at(out, word, WIDTH * (good + 1) - w.starts[word])
    return out


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A dictionary by zstandard's trainer. Samples that fit when each distinct one is taken once are the dictionary, whole."""
    parts = [x[i : i + PART] for x in samples for i in range(0, len(x), PART)]
    if sum(map(len, (distinct := dict.fromkeys(parts)))) <= size:
        return b"".join(distinct)
    return zstandard.train_dictionary(size, parts, k=segment, d=8).as_bytes()


def train_dictionaries(texts: list[str], toxic: np.ndarray) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary, the latter with the former behind it."""
    bad = [t for t, y in zip(texts, toxic) if y]
    plain = [t for t, y in zip(texts, toxic) if not y]
    words, ordinary_in = _tally(_once(w.whole, w.doc) for w in _chunks(plain))
    if not len(words):
        return b"", b""
    every = max(1, sum(-(-int(n) // WINDOW) for w in _chunks(plain) for n in np.bincount(w.doc)) // MAX_WINDOWS)
    samples: list[bytes] = []  # windows of ordinary texts, evenly spread
    k = 0
    for w in _chunks(plain):
        for x in w.windows(_looked_up(words, ordinary_in, w.whole) >= TAUGHT):
            if k % every == 0:
                samples.append(x)
            k += 1
    ordinary = trained(samples, ORDINARY_BYTES, 64)
    samples.clear()
    wanted = telling(bad, plain)
    for w in _chunks(bad):
        w.sizes = up_to(w, wanted)
        samples += w.windows(w.sizes > 0)
    only = trained(samples, TOXIC_BYTES, 32)
    return (ordinary, only + ordinary) if only else (b"", b"")


def folds(texts: list[str]) -> np.ndarray:
    """Parts by the least hash of a text's words in pairs, so that most copies of a text fall into one part."""
    out = [np.zeros(0, np.uint64)]
    for w in _chunks(texts):
        least = np.full(w.texts, 2**64 - 1, np.uint64)
        with np.errstate(over="ignore"):
            pair = (w.whole * np.uint64(3) ^ np.append(w.whole[1:], np.uint64(0))) * np.uint64(_PRIME)
            np.minimum.at(least, w.doc, pair)
        out.append((least >> np.uint64(9)) % np.uint64(FOLDS))
    return np.concatenate(out)


def isotonic(x: np.ndarray, y: np.ndarray) -> list[tuple[float, float]]:
    """The monotone step function nearest to y, each step pulled to the mean by one row."""
    order = np.argsort(x, kind="stable")
    xs, ys = x[order], y[order].astype(float)
    mean = ys.mean()
    blocks: list[list[float]] = []
    for v in np.unique(xs):
        own = ys[xs == v]
        blocks.append([float(v), own.sum(), len(own)])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            _, s, n = blocks.pop()
            blocks[-1][1] += s
            blocks[-1][2] += n
    return [(-np.inf if i == 0 else v, (s + mean) / (n + 1)) for i, (v, s, n) in enumerate(blocks)]


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """Deterministic for given rows in given order."""
    if not len(texts) or toxic.min() == toxic.max():
        return Model(steps=[(-np.inf, float(np.mean(toxic)) if len(texts) else 0.0)])
    fold = folds(texts)
    models = [Model(*train_dictionaries([t for t, h in zip(texts, fold) if h != k], toxic[fold != k])) for k in range(FOLDS)]
    seen = [m.windows([t for t, h in zip(texts, fold) if h == k]) for k, m in enumerate(models)]
    best = (-1.0, 0, None)
    for least in (2, 3, 4, 6, 8):
        x = np.zeros(len(texts))
        for k, (doc, saved) in enumerate(seen):
            x[fold == k] = per_root(doc, saved, least, int((fold == k).sum()))
        steps = isotonic(x, toxic)
        p = np.array([v for _, v in steps])[np.searchsorted(np.array([s for s, _ in steps]), x, side="right") - 1]
        likely = float((toxic * np.log(p) + (1 - toxic) * np.log1p(-p)).mean())
        if best[2] is None or likely > best[0] + 1e-9:
            best = (likely, least, steps)
    return Model(*train_dictionaries(texts, toxic), least=best[1], steps=best[2])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Model:
    """At most ``max_rows`` ids are broadcast, and their texts, one for each id, come to the driver as far as ``max_bytes`` hold them."""
    chosen = F.broadcast(training_labels(labels, label_col, id_col, max_rows))
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(id_col, text.alias("text")).join(chosen, id_col).select(id_col, "y", F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text")).alias("t"))
    sample, path = written(rows.groupBy(id_col, "y").agg(F.min("t").alias("t")).select(id_col, "y", "t.text"), "toxic_sample")
    sizes = sample.select(id_col, F.octet_length("text").alias("n")).orderBy(F.xxhash64(id_col), id_col).toPandas()
    fits, room = [], max_bytes
    for i, n in zip(sizes[id_col].tolist(), sizes["n"].tolist()):
        if n <= room:
            fits.append(i)
            room -= n
    small = docs.sparkSession.createDataFrame([(i,) for i in fits], f"`{id_col}` {dict(docs.dtypes)[id_col]}")
    got = sample.join(F.broadcast(small), id_col).toPandas().sort_values([id_col, "y"], kind="stable")
    drop_path(docs.sparkSession, path)
    texts, toxic = got["text"].tolist(), got["y"].to_numpy(int)
    del got
    model = fit(texts, toxic)
    del texts
    give_back()
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, saved`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                windows = model.windows([t or "" for t in part.column(1).to_pylist()])
                saved = total(*windows, model.least, part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.likelihood(per_root(*windows, model.least, part.num_rows))), pa.array(saved)], names=[id_col, "score", "saved"])

    kind = dict(docs.dtypes)[id_col]
    return in_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, score double, saved bigint")


def keep(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The documents below that score, with all their columns."""
    return keep_rows(docs, lambda texts: model.score(texts) < threshold, text_col)
