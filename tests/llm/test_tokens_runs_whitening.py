"""Streaming BPE against the library, runs against a plain search, whitening against exact fractions."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from spanloom.llm import bpe_transducer as B
from spanloom.llm import periodic_runs as R
from spanloom.llm import queries as Q
from spanloom.llm import whitening as W
from spanloom.session import table

VOCABULARY = public_tokenizers.path(Q.BPE_FILE)
LIBRARY = Tokenizer.from_file(VOCABULARY)


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def own_ids(text):
    return np.frombuffer(b"".join(B.transducer(VOCABULARY).encode(text)), "<u4").tolist()


def decoded(ids):
    d = B.transducer(VOCABULARY).decoder()
    return "".join([d.feed([i]) for i in ids]) + d.close()


# Streaming BPE

PARTS = ["a", "aa", "aaaa", "é", "漢", "字", " ", "  ", "\n", "\r\n", "'s", "'re", "'", "1", "22", "!!", "<|endoftext|>", "<|endo", "　", "\x1c", "the", " don't", "abcdefghij", "🙂"]


@pytest.mark.parametrize("block, hold", [(7, 5), (64, 16), (1 << 17, 1 << 10)])
def test_ids_equal_the_library(monkeypatch, block, hold):
    monkeypatch.setattr(B, "BLOCK", block)
    monkeypatch.setattr(B, "HOLD", hold)
    rng = random.Random(block)
    for k in range(150):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(200)))
        if k % 3 == 0:
            text = "".join(rng.choice("abcdetnsrio") for _ in range(rng.randrange(2000)))
        if k % 7 == 0:
            text = rng.choice(["a", "ab", "é", "=", "\n", "0", " "]) * rng.randrange(3000)
        ids = library_ids(text)
        assert own_ids(text) == ids and decoded(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_decoder_takes_any_ids():
    rng = random.Random(8)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(40))]
        assert decoded(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_lookahead_is_sufficient_and_memory_constant():
    merges = B.transducer(VOCABULARY).merges
    rng = random.Random(3)
    heads = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(2 * merges.lookahead)) for _ in range(20)] + ["a" * 2 * merges.lookahead]
    for head in heads:
        firm = None
        for _ in range(20):
            tail = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(60)))
            tokens, end = [], 0
            for t in merges.merge((head + tail).encode()):
                end += len(merges.bytes[t])
                if end > len(head) - merges.lookahead:
                    break
                tokens.append(t)
            assert firm in (None, tokens)
            firm = tokens
    m = B.Merger(merges)
    out = [t for _ in range(400) for t in m.feed("abcdefghij".encode() * 25)] + m.close()
    assert out == library_ids("abcdefghij" * 10_000) and m.held <= merges.lookahead + 2 * B.HOLD


def test_lookahead_of_a_small_list():
    m = object.__new__(B.MergeList)
    m.bytes = {0: b"a", 1: b"b", 2: b"c", 3: b"ab", 4: b"cab", 5: b"bc"}
    m.rules = {(0, 1): 3, (2, 3): (1 << 32) + 4, (1, 2): (2 << 32) + 5}
    # ab, then c + ab, whose right part begins with a, then b + c: chains a, ca and bca.
    assert m._lookahead() == 3


def test_transducer_on_tables(spark, sf):
    df = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "a <|endoftext|> b", 5), (2, "x" * 100_000, 5), (2, "x" * 100_000, 5)], "doc_id bigint, text string, ids int")
    got = sorted((r["doc_id"] or 0, r["ids"]) for r in B.encode_texts(df, VOCABULARY).collect())
    assert got == sorted((r["doc_id"] or 0, library_ids(r["text"])) for r in df.collect())
    assert {r["text"] for r in B.decode_ids(B.encode_texts(df, VOCABULARY), VOCABULARY).collect()} == {r["text"] or "" for r in df.collect()}
    assert B.digest_round_trip(df.limit(0), VOCABULARY).count() == 0
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    rows = Q.queries()["op11_bpe_transducer"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library_ids(texts[r["doc_id"]])
        assert tuple(r)[1:] == (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False)))


# Runs


def plain_runs(w):
    out = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((a, b, q) for (a, b), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_a_plain_search():
    rng = random.Random(1)
    total = 0
    for _ in range(1200):
        w = []
        while len(w) < rng.choice([10, 24, 60, 200]):
            base = [bytes([97 + rng.randrange(rng.choice([1, 2, 3, 26]))]) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 20]))]
            m = rng.randrange(1, 6 * len(base) + 30)
            w += (base * m)[:m]
        want = plain_runs(w)
        assert R.find(w) == want and [(a, b, q) for a, b, q in R.runs_of(w)] == want
        total += len(want)
    assert total > 500


@pytest.mark.parametrize("q", [1, 2, 7, 8, 9, 10, 50])
def test_least_lengths(q):
    base, least = [b"w%d" % i for i in range(q)], max(24, 3 * q)
    for n in (least - 1, least, least + 1):
        w = [b"x", *(base * n)[:n], b"y"]
        assert R.find(w) == ([(1, n + 1, q)] if n >= least else [])


def test_long_texts_stay_fast():
    assert R.find([b"a"] * 100_000) == [(0, 100_000, 1)]
    assert R.find([b"%d" % (i % 30_000) for i in range(100_000)]) == [(0, 100_000, 30_000)]


def plain_row(doc_id, text):
    words = [w for w in (text or "").encode().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    of_best = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *of_best, sha("".join(f"{a},{b - a},{q}\n" for a, b, q in runs)), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_run_query(spark, sf, tmp_path):
    docs = [r["doc_id"] for r in table(spark, sf, "documents").collect()]
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    got = Q.queries()["op13_periodic_runs"](spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_row(i, texts[i]) for i in docs)
    odd = [(None, None), (None, "a b " * 40), (3, ""), (4, " \x0b\x0c\t"), (5, "e\x1cé " * 30), (6, "one two three " * 8 + "x " + "y z " * 12), (6, "one two three " * 8), (7, "a" * 5000)]
    odd += [(k, " ".join(f"w{i}" for i in range(k % 50))) for k in range(100, 300)]
    path = f"file://{tmp_path}/documents.parquet"
    spark.createDataFrame([(*r, 1, 2) for r in odd], "doc_id bigint, text string, runs int, collapsed int").write.parquet(path)
    got = Q.queries()["op13_periodic_runs"](spark, f"file://{tmp_path}").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(plain_row(*r)) for r in odd)
    assert R.periodic_runs(spark.read.parquet(path).limit(0)).count() == 0


def test_collapsed_text(spark):
    df = spark.createDataFrame([(1, "start " + "ha " * 30 + "end")], "doc_id bigint, text string")
    r = R.periodic_runs(df).collect()[0]
    assert (r["n_words"], r["collapsed"], [tuple(x) for x in r["runs"]]) == (32, "start ha end", [(1, 30, 1)])


# Whitening


def exact_fit(xs):
    """n, S, and the covariance as fractions."""
    fit = sorted(set(map(tuple, xs)))
    n, dim = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(dim)]
    cov = [[Fraction(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in fit), n**3) for j in range(dim)] for i in range(dim)]
    return fit, n, s, cov


def check_whitening(rows, vectors):
    """rows: of the operator; vectors: id and entries of those that take part, all of one length."""
    to_int = lambda v: [int(np.floor(64 * float(np.float64(c)))) + 1_000_000 for c in v]
    xs = [(i, to_int(v)) for i, v in vectors]
    fit, n, s, cov = exact_fit([x for _, x in xs])
    v = np.array([[float(c) for c in row] for row in cov])
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1][:16], basis[:, ::-1][:, :16]
    assert len(rows) == len(xs) * len(values)
    of = {}
    for r in rows:
        of.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    for i, x in xs:
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, s))
        own = of[i, deviation]
        assert sorted(own) == list(range(1, len(values) + 1)) and all(r["n"] == n for r in own.values())
        z = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s)]) @ basis / np.sqrt(values)
        for k, r in own.items():
            assert abs(abs(r["whitened"]) - abs(z[k - 1])) < 1e-6 * max(1, abs(z[k - 1])) and abs(r["explained"] / (values[k - 1] / np.trace(v)) - 1) < 1e-9
            assert r["identity_error"] < 1e-6


def test_whitening_query(spark, sf):
    vectors = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    got = Q.queries()["op12_whitening"](spark, sf)
    assert dict(got.dtypes)["deviation"] == "bigint"
    good = [(i, v) for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    check_whitening(got.collect(), good)


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(0, 1, 5).tolist()) for i in range(40)]
    good += [(1, good[1][1]), (None, good[2][1]), (50, good[3][1])] + [(60 + i, good[4][1]) for i in range(30)]
    bad = [(70, None), (71, []), (72, [1.0, None, 0.0, 0.0, 0.0]), (73, [float("nan")] * 5), (74, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (75, [1e300, 0.0, 0.0, 0.0, 0.0])]
    schema = "vec_id bigint, embedding array<double>, x int, n int"
    df = spark.createDataFrame([(*r, 1, 2) for r in good + bad], schema).repartition(7)
    check_whitening(W.whiten(df).collect(), good)
    assert W.whiten(df.limit(0)).count() == 0 and W.whiten(df.filter("vec_id = 3")).count() == 0
    # Two lengths, each with its own fit; a component without variance is left out.
    both = spark.createDataFrame([(*r, 1, 2) for r in good] + [(100 + i, [float(i), 7.0, 2.0 * i], 1, 2) for i in range(10)], schema)
    rows = W.whiten(both).collect()
    check_whitening([r for r in rows if r["vec_id"] is None or r["vec_id"] < 100], good)
    flat = [r for r in rows if (r["vec_id"] or 0) >= 100]
    assert {r["component"] for r in flat} == {1} and abs(flat[0]["explained"] - 1) < 1e-12 and {r["n"] for r in flat} == {10}


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(6)
    x = [(i, [float(c) * 1e12 for c in rng.normal(0, 1, 3)]) for i in range(50)]
    df = spark.createDataFrame(x, "vec_id bigint, embedding array<double>").repartition(4)
    check_whitening(W.whiten(df).collect(), x)
    xs = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in x]
    m = W.Moments.none(3)
    m.add(np.array(xs))
    whole = {}
    for at, limb, value in zip(*m.limbs()):
        whole[at] = whole.get(at, 0) + (value << W.LIMB * limb)
    assert whole[1] == sum(v[0] for v in xs) and whole[4] == sum(v[0] * v[0] for v in xs) and whole[5] == sum(v[0] * v[1] for v in xs)
