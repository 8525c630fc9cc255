"""Quality by a generalised additive model with pairwise interactions (operator 5).

Whole texts become a few numbers; each is cut into bins at quantiles of the training rows. Cyclic boosting goes round the
features and fits a shallow tree to the bins of one feature at a time, which adds up to a lookup table per feature; then
the pairs of features that explain most of what is left get tables of their own in the same way. A score is the logistic
function of the sum of the bins' additions.

Training uses a bounded sample of the labelled rows (``MAX_ROWS``, chosen by a hash of the id); everything else covers all
rows. Labels, language, source and id are no inputs of a score.

Defined results: a null or empty text has features of its own and a score as any other. A label that is null is left out;
several labels of one document count by their mean, a tie as 1. Without labels every score is 0.5, with one class only it
is near that class. Of several texts with one id the one with the least hash is learnt from. Repeated rows get equal scores. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_arrow, keep_rows

MAX_ROWS, BINS, PAIR_BINS, ROUNDS, PAIRS, PAIR_ROUNDS, RATE = 20_000, 32, 8, 60, 6, 40, 0.2

FEATURES = (
    "log_chars", "log_words", "word_length", "upper", "digits", "symbols", "punctuation", "exclamation", "pipes",
    "distinct_words", "repeated_words", "log_lines", "line_length", "distinct_lines", "stops", "symbol_words", "spaces", "non_ascii",
)
_UPPER, _SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*+/<>=@\\^_`{|}~[]!"
#: Symbols become ``#`` and white space a space, so that words that end in a symbol can be counted.
_SHAPE = bytes(35 if b in _SYMBOLS else 32 if b in b" \t\r\n" else b for b in range(256))


def features(text: str) -> list[float]:
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    raw = text.encode()
    size = len(raw)
    words, lines = text.split(), text.split("\n")
    m = max(1, len(words))
    drop = lambda chars: (size - len(raw.translate(None, chars))) / size
    return [
        np.log1p(n), np.log1p(len(words)), n / m, drop(_UPPER), drop(b"0123456789"), drop(_SYMBOLS), drop(b".,;:?!'\"-()"), drop(b"!"), drop(b"|"),
        len(set(words)) / m, sum(map(eq, words, words[1:])) / m, np.log1p(len(lines)), n / len(lines), len(set(lines)) / len(lines),
        raw.count(b". ") / m, (raw + b" ").translate(_SHAPE).count(b"# ") / m, drop(b" \t\r\n"), (size - n) / size,
    ]


@dataclass
class Model:
    """Cuts of each feature, a table of additions for each feature and for each chosen pair."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)]
        for b, t in zip(bins, self.tables):
            out += t[b]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _best_cuts(g: np.ndarray, h: np.ndarray, leaves: int = 3, ridge: float = 2.0) -> list[int]:
    """Cuts of a shallow tree over ordered bins, by gain of the second-order loss."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    worth = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        best, at = 1e-9, -1
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                k = np.arange(a + 1, b)
                gain = worth(a, k) + worth(k, b) - worth(a, b)
                i = int(np.argmax(gain))
                if gain[i] > best:
                    best, at = float(gain[i]), int(k[i])
        if at < 0:
            break
        cuts = sorted([*cuts, at])
    return cuts


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Deterministic for given rows."""
    if not len(y):
        return Model()
    p0 = (y.sum() + 0.5) / (len(y) + 1)
    m = Model(float(np.log(p0 / (1 - p0))))
    if y.min() == y.max():
        return m
    for j in range(x.shape[1]):
        m.cuts.append(np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")))
    bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(m.cuts)]
    m.tables = [np.zeros(len(c) + 1) for c in m.cuts]
    m.coarse = [np.arange(len(c) + 1) * PAIR_BINS // (len(c) + 1) for c in m.cuts]
    f = np.full(len(y), m.intercept)
    for _ in range(ROUNDS):
        for b, t in zip(bins, m.tables):
            p = 1 / (1 + np.exp(-f))
            g, h = np.bincount(b, y - p, len(t)), np.bincount(b, p * (1 - p), len(t))
            cuts = _best_cuts(g, h)
            for a, e in zip(cuts, cuts[1:]):
                t[a:e] += (add := RATE * g[a:e].sum() / (h[a:e].sum() + 2.0))
                f[(b >= a) & (b < e)] += add
    p = 1 / (1 + np.exp(-f))
    cells = {}
    for i in range(x.shape[1]):
        for j in range(i):
            c = m.coarse[i][bins[i]] * PAIR_BINS + m.coarse[j][bins[j]]
            g, h = np.bincount(c, y - p, PAIR_BINS**2), np.bincount(c, p * (1 - p), PAIR_BINS**2)
            cells[i, j] = (float((g * g / (h + 2.0)).sum()), c)
    m.pairs = sorted(cells, key=lambda k: (-cells[k][0], k))[:PAIRS]
    m.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in m.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, t in zip(m.pairs, m.pair_tables):
            c = cells[k][1]
            p = 1 / (1 + np.exp(-f))
            g, h = (np.bincount(c, v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for v in (y - p, p * (1 - p)))
            add = np.zeros_like(t)
            rows = _best_cuts(g.sum(1), h.sum(1), 2)
            for a, e in zip(rows, rows[1:]):  # one cut in the first feature, then one in the second on each side
                cols = _best_cuts(g[a:e].sum(0), h[a:e].sum(0), 2)
                for u, v in zip(cols, cols[1:]):
                    add[a:e, u:v] = RATE * g[a:e, u:v].sum() / (h[a:e, u:v].sum() + 2.0)
            t += add
            f += add.ravel()[c]
    return m


def matrix(texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))


def _features_of(batches: Iterator[pa.RecordBatch], names: list[str], more) -> Iterator[pa.RecordBatch]:
    """The last column is the text; it gives way to ``more(matrix of features)``."""
    for b in batches:
        for k in range(0, b.num_rows, 1024):
            part = b.slice(k, 1024)
            x = matrix([t or "" for t in part.column(b.num_columns - 1).to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *more(x)], names=names)


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that no model learns from; a row without an id is none of them."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id", max_rows: int = MAX_ROWS) -> DataFrame:
    """``id_col, y`` of at most ``max_rows`` documents, chosen by a hash of the id; held-out rows never are."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    each = known.groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    return each.orderBy(F.xxhash64(id_col), id_col).limit(max_rows)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> Model:
    """Only labelled documents are read into features. At most ``max_rows`` ids are broadcast, and one row of numbers for each comes to the driver."""
    chosen = F.broadcast(training_labels(labels, label_col, id_col, max_rows))
    rows = docs.select(id_col, text_col).join(chosen, id_col).select(id_col, "y", F.xxhash64(text_col).alias("h"), text_col)
    kind = dict(docs.dtypes)[id_col]
    names = [id_col, "y", "h", "x"]
    each = in_arrow(rows, lambda it: _features_of(it, names, lambda x: [pa.array(list(x), pa.list_(pa.float64()))]), f"`{id_col}` {kind}, y int, h bigint, x array<double>")
    got = each.groupBy(id_col, "y").agg(F.min(F.struct("h", "x")).alias("m")).select(id_col, "y", "m.x").toPandas()
    got = got.sort_values([id_col, "y"], kind="stable")
    x = np.array(got["x"].tolist()).reshape(len(got), len(FEATURES))
    return fit(x, got["y"].to_numpy(float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` for every row."""
    kind = dict(docs.dtypes)[id_col]
    return in_arrow(docs.select(id_col, text_col), lambda it: _features_of(it, [id_col, "score"], lambda x: [pa.array(model.score(x))]), f"`{id_col}` {kind}, score double")


def keep(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The documents with at least that score, with all their columns."""
    return keep_rows(docs, lambda texts: model.score(matrix(texts)) >= threshold, text_col)
