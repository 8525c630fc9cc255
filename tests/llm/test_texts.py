"""Secrets, tokens, packing, shingles and the two models, against brute force or held-out rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanloom.llm import additive_quality, byte_bpe, nnls_packing, prefix_join, secret_ledger, zstd_toxicity
from spanloom.llm import queries as Q
from spanloom.session import table

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, score int, id int, n int"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash", 0, 1, 2) for i, t in enumerate(texts)], SCHEMA)


LONG = " ".join(f"word{i % 977}" for i in range(60_000))

# Secrets

KEY = "AKIA" + "ABCDEFGH12345678"
SECRETS = [
    "password=hunter2hunter2", "PassWd : 'abcdefghijkl'", "secret=token = abcdefghijklmnop", "secret=token=abcdefghijklmnop", "api_key:\"aaaaaaaaaaaa\" apikey=bbbbbbbbbbbb", "token=short", KEY, "AKIAAKIA" + "X" * 14,
    "AKIA12", "deadbeefdeadbeef", "DEADBEEFDEADBEEF", "éé 0123456789abcdef01 " + KEY + "f00", "ſecret=abcdefghijklmnop", "toKen=abcdefghijklmnop", None, "", "plain text", "token=0123456789abcdef0123", "password==aaaaaaaaaaaaaa",
] + ["password=hunter2hunter2"] * 3 + [LONG + " secret=abcdefghijkl"]


def spans_of(text):
    text, out = text or "", []
    for k, (kind, pattern, ok) in enumerate([
        ("assign", r"(?i:(?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[1]) >= 12),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    ]):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if ok(m)]
    return [(kind, a, e) for a, _, kind, e in sorted(out)]


def test_secrets(spark):
    ledger = secret_ledger.Ledger(spark)
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secret_ledger.scan(docs(spark, SECRETS), ledger).collect()}
    assert got == {i: spans_of(t) for i, t in enumerate(SECRETS)}
    known = ledger.read().count()
    assert known == len({t or "" for t in SECRETS})
    more = [*SECRETS, "new token=abcdefabcdefabcdef"]
    assert secret_ledger.scan(docs(spark, more), ledger).count() == len(more) and ledger.read().count() == known + 1
    secret_ledger.scan(docs(spark, SECRETS), ledger, version="base-2")
    assert ledger.read().count() == 2 * known + 1


def test_history_scans_each_blob_once(spark):
    rows = [("a", 1, "token=abcdefabcdefabcdef"), ("a", 2, "clean"), ("b", 1, "token=abcdefabcdefabcdef"), ("b", 2, None), (None, 3, "secret=abcdefghijklmnop")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "path string, version int, text string, blob int")
    ledger = secret_ledger.Ledger(spark)
    got = {(r["path"], r["version"], r["kind"], r["start"], r["end"]) for r in secret_ledger.scan_history(df, ledger).collect()}
    assert got == {(p, v, *s) for p, v, t in rows for s in spans_of(t)} and ledger.read().count() == 4
    before = spark.read.parquet(ledger.path).inputFiles()
    ledger.append(ledger.read())  # as two scans at once would
    assert secret_ledger.scan_history(df, ledger).count() == len(got)
    assert len(spark.read.parquet(ledger.path).inputFiles()) > len(before) and ledger.read().count() == 8
    more = spark.createDataFrame([("c", 1, "token=abcdefabcdefabcdef", 0), ("c", 2, "api_key: 0123456789abcdef", 0)], df.schema)
    assert {r["path"] for r in secret_ledger.scan_history(more, ledger).collect()} == {"c"} and ledger.read().count() == 9


def test_redaction_keeps_clashing_columns(spark):
    df = docs(spark, SECRETS).withColumns({"_blob": F.lit("mine"), "_spans": F.lit(3), "__blob": F.lit(4)})
    got = secret_ledger.redact_documents(df, secret_ledger.Ledger(spark))
    assert got.columns == df.columns and got.filter("_blob = 'mine' AND _spans = 3 AND __blob = 4").count() == len(SECRETS)


def test_redaction(spark):
    got = {r["doc_id"]: r for r in secret_ledger.redact_documents(docs(spark, SECRETS), secret_ledger.Ledger(spark)).collect()}
    for i, t in enumerate(SECRETS):
        want, end = [], 0
        merged = []
        for _, a, e in spans_of(t):
            if merged and merged[-1][1] >= a:
                merged[-1][1] = max(e, merged[-1][1])
            else:
                merged.append([a, e])
        for a, e in merged:
            want += [t[end:a], "[SECRET]"]
            end = e
        want = t if t is None else "".join(want) + t[end:]
        assert got[i]["text"] == want and got[i]["n_chars"] == len(want or "")


def test_no_documents(spark):
    empty = docs(spark, [])
    assert secret_ledger.scan(empty, secret_ledger.Ledger(spark)).count() == 0
    assert secret_ledger.redact_documents(empty, secret_ledger.Ledger(spark)).columns == empty.columns
    assert prefix_join.link_components(empty).count() == 0 and prefix_join.keep_first(empty, 5, 80).count() == 0
    assert byte_bpe.digest_round_trip(empty, public_tokenizers.path(Q.TIKTOKEN_FILE)).count() == 0
    assert nnls_packing.pack(empty, public_tokenizers.path(Q.BPE_FILE)).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert additive_quality.score(empty, additive_quality.train(empty, labels)).count() == 0
    assert zstd_toxicity.score(empty, zstd_toxicity.train(empty, labels)).count() == 0


def test_secret_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    for r in Q.queries()["op3_secret_ledger"](spark, sf).collect():
        spans = spans_of(texts[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{e}" for k, a, e in spans)
        assert r["spans"] == line and r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for k, _, _ in spans) for x in ("assign", "access", "hex"))


# Tokens


def odd_texts():
    rng = random.Random(1)
    letters = "ab'stredvml  \n\t1٣!?é漢 ’\x1c\x85🙂"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(500)] + ["", None, "'", " ", "  a", "a" * 3000, " " * 2000 + "x", "<|endoftext|>", "we'll they're I'D 's's ''s !'s '"]


def reference_encoding():
    ranks = byte_bpe.Tokenizer(public_tokenizers.path(Q.TIKTOKEN_FILE)).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding(spark):
    texts = odd_texts()
    e = reference_encoding()
    got = {r["doc_id"]: r for r in byte_bpe.encode_texts(docs(spark, texts), public_tokenizers.path(Q.TIKTOKEN_FILE)).collect()}
    for i, t in enumerate(texts):
        ids = e.encode_ordinary(t or "")
        assert got[i]["ids"] == ids
        sizes = [len(e.decode_single_token_bytes(x)) for x in ids]
        assert got[i]["offsets"] == [sum(sizes[:k]) for k in range(len(sizes))] or len(ids) > 200


def test_token_query(spark, sf):
    e = reference_encoding()
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    for r in Q.queries()["op7_byte_bpe"](spark, sf).collect():
        t = texts[r["doc_id"]]
        ids = e.encode_ordinary(t)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_scan_across_blocks():
    text = "ab'll  c" * 100 + "\n"
    whole = byte_bpe.boundaries(np.append(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.uint32(0xFFFFFFFF)), 10_000).tolist()
    for width in (1, 3, 7, 64):
        assert byte_bpe.boundaries(np.append(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.uint32(0xFFFFFFFF)), width).tolist() == whole


# Packing


def check_packing(rows, texts):
    t = Tokenizer.from_file(public_tokenizers.path(Q.BPE_FILE))
    cover, sequences = {}, {}
    for r in rows:
        ids = np.array([*t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 0], "<u4")
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        cover.setdefault(r["doc_id"], []).append((r["start"], r["length"], len(ids)))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(cover) == set(texts)
    for parts in cover.values():
        at = 0
        for start, n, _ in sorted(parts):
            assert start == at
            at += n
        assert at == parts[0][2]
    pad = total = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= 1024
        total += at
        pad += 0 if at & (at - 1) == 0 else 1024 - at
    return pad / (total + pad)


def test_packing(spark):
    texts = dict(enumerate([None, "", "<|endoftext|>", LONG, *["same text here"] * 50, *[" ".join(["w"] * n) for n in range(1, 1500, 37)]]))
    rows = nnls_packing.pack(docs(spark, list(texts.values())).repartition(3), public_tokenizers.path(Q.BPE_FILE)).collect()
    assert check_packing(rows, texts) < 0.05


def test_added_tokens():
    texts = ["abc <|endoftext|> def", "<|endoftext|>", "a  <|endoftext|><|endoftext|>  b", "<|endoftext|", "x<|endoftext|>'s <|ENDOFTEXT|>", "   ", "", *[t or "" for t in odd_texts()]]
    texts += [f"{a}<|endoftext|>{b}" for a, b in zip(texts, texts[1:])]
    t = Tokenizer.from_file(public_tokenizers.path(Q.BPE_FILE))
    e = nnls_packing.encoder(public_tokenizers.path(Q.BPE_FILE))
    got = [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in texts] and got[0] == [39305, 220, 50256, 825]


def test_packing_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    assert check_packing(Q.queries()["op9_nnls_packing"](spark, sf).collect(), texts) < 0.03


@pytest.mark.parametrize("n", [0, 1, 40, 5000])
def test_plan_uses_every_piece(n):
    rng = np.random.default_rng(n)
    counts = np.bincount(rng.integers(1, 1025, n), minlength=1025)
    counts[700] += n // 3
    whole, cuts, kept = nnls_packing.plan(counts)
    used = np.zeros(1025, int)
    for combo, times in whole:
        assert sum(combo) <= 1024 and times > 0
        np.add.at(used, list(combo), times)
    assert (used == kept).all() and (kept <= counts).all()
    rest = np.zeros(1025, int)
    for v in np.flatnonzero(counts - kept):
        np.add.at(rest, nnls_packing.parts_of(int(v)), counts[v] - kept[v])
    for combo, times in cuts:
        assert sum(combo) <= 1024
        np.subtract.at(rest, list(combo), times)
    assert not rest.any()
    filled, sequences = (counts * np.arange(1025)).sum(), sum(t for _, t in whole + cuts)
    assert n < 1000 or sequences * 1024 < filled * 1.01


# Near copies


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def brute_components(texts, k, percent):
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if y < x and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5)))
    out = [None, "", " \t\n", "one two", "One  TWO", "one two three", "É é", "É é", "a b c d", LONG, LONG + " end"]
    passage = [word() for _ in range(60)]
    for _ in range(6):  # families of copies with more and more edits, of which chains of links arise
        base = [word() for _ in range(rng.randint(30, 160))]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, 7)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy += [word() for _ in range(rng.randint(1, 4))]
            out.append(" ".join(copy))
    out += [" ".join([*[word() for _ in range(30)], *passage, *[word() for _ in range(rng.randint(5, 40))]]) for _ in range(40)]
    return out + out[20:40]


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_components(spark, k, percent):
    texts = dict(enumerate(near_copies()))
    got = prefix_join.link_components(docs(spark, list(texts.values())).repartition(5), k, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(texts, k, percent)


@pytest.mark.parametrize("block", [1, 4, 16])
def test_frequent_shingles_are_split(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_join, "BLOCK", block)
    texts = dict(enumerate(near_copies()[:110]))
    got = prefix_join.link_components(docs(spark, list(texts.values())).repartition(3), 4, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(texts, 4, 85)


def test_keep_first(spark):
    texts = dict(enumerate(near_copies()))
    want = sorted(i for i, (_, c) in brute_components(texts, 5, 80).items() if i == c)
    kept = prefix_join.keep_first(docs(spark, list(texts.values())), 5, 80)
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == want and kept.columns == docs(spark, []).columns


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (None, "a b c d e"), (None, None)], "doc_id bigint, text string")
    got = prefix_join.link_components(df).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]
    # One of the equal texts stays, and the row without words, which links with nothing.
    assert [tuple(r) for r in prefix_join.keep_first(df, 4, 85).orderBy("doc_id").collect()] == [(None, None), (1, "a b c d e")]


def test_sets_that_share_a_node_are_told_apart(spark, monkeypatch):
    """With nodes of two bits all sets clash; their two hashes and size keep them apart."""
    plain, few = prefix_join.profiles, near_copies()[:60]
    monkeypatch.setattr(prefix_join, "profiles", lambda *a: plain(*a).withColumn("node", F.col("node") % 2))
    texts = dict(enumerate(few))
    got = prefix_join.link_components(docs(spark, few).repartition(3), 4, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(texts, 4, 85)


def test_one_row_of_each_group_stays(spark):
    text, other = "one two three four five six seven", "some quite different words stand in this text here"
    rows = [(1, text, "x")] * 50 + [(None, text, "x")] * 30 + [(2, text, "x")]
    kept = lambda rows: sorted(map(tuple, prefix_join.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string, _row string"), 5, 80).collect()), key=str)
    assert kept(rows) == [(1, text, "x")]
    assert kept([r for r in rows if r[0] is None]) == [(None, text, "x")]
    # A repeated id with texts of two groups, and one with texts that differ in white space only.
    assert kept(rows + [(1, other, "y"), (7, other, "y"), (7, other, "y")]) == [(1, text, "x"), (1, other, "y")]
    assert len(kept([(4, text, "x"), (4, "  " + text, "x"), (4, text.replace(" ", "  "), "x"), (5, text, "x")])) == 1
    near = " ".join(f"w{i}" for i in range(100))
    assert kept([(None, near, "x"), (9, near + " more", "x"), (9, near + " more", "x"), (3, near + " still", "x")]) == [(3, near + " still", "x")]


def test_component_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    got = Q.queries()["op4_prefix_join"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(texts, 4, 85)


# Models


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.mark.parametrize("name, label, least", [("op5_additive_quality", "quality", 0.9), ("op6_zstd_toxicity", "toxic", 0.9)])
def test_models_on_held_out_rows(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in Q.queries()[name](spark, sf).collect()}
    assert all(r["held_out"] == held_out(i) and 0 <= r["score"] <= 1 for i, r in got.items())
    truth = {r["doc_id"]: r[label] for r in table(spark, sf, "labels").collect() if held_out(r["doc_id"]) and r["doc_id"] in got}
    right = [got[i]["predicted"] == y for i, y in truth.items()]
    assert len(got) == table(spark, sf, "documents").count() and np.mean(right) >= least


@pytest.mark.parametrize("name, label, recall, precision", [("op5_additive_quality", "quality", 0.95, 0.95), ("op6_zstd_toxicity", "toxic", 0.85, 0.95)])
def test_recall_and_precision_on_held_out_rows(spark, name, label, recall, precision):
    sf = "/root/testdata/sf0.1"
    said = {r["doc_id"]: r["predicted"] for r in Q.queries()[name](spark, sf).filter("held_out").select("doc_id", "predicted").collect()}
    truth = {r["doc_id"]: r[label] for r in table(spark, sf, "labels").collect() if r["doc_id"] in said and r[label] is not None}
    hits = sum(said[i] == y == 1 for i, y in truth.items())
    assert hits >= recall * sum(truth.values()) and hits >= precision * sum(said[i] for i in truth)


def test_dictionaries_are_trained_on_their_class():
    rng = random.Random(6)
    plain = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randint(3, 7))) for _ in range(200)]
    text = lambda words: " ".join(rng.choice(words) for _ in range(120))
    texts = [text(plain) for _ in range(300)] + [text(plain + ["gruntlepug", "zwackelix"] * 10) for _ in range(60)]
    ordinary, toxic = zstd_toxicity.train_dictionaries(texts, np.repeat([0, 1], [300, 60]))
    assert len(ordinary) < len(toxic) <= len(ordinary) + zstd_toxicity.TOXIC_BYTES and toxic.endswith(ordinary)
    code = zstd_toxicity.Words.of(["gruntlepug zwackelix"])
    assert all(code.text(i)[12:28] in toxic and code.text(i)[12:28] not in ordinary for i in (0, 1))
    model = zstd_toxicity.Model(ordinary, toxic, 2, [(float("-inf"), 0.0), (4.0, 1.0)])
    assert model.score([text(plain), text(plain) + " gruntlepug zwackelix" * 3]).tolist() == [0.0, 1.0]


def test_toxicity_equals_windows_compressed_one_by_one():
    import zstandard

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeioustrnlgm") for _ in range(rng.randint(1, 9)))
    ordinary, toxic = (zstd_toxicity.Words.of([" ".join(word() for _ in range(300))]).codes for _ in range(2))
    model = zstd_toxicity.Model(ordinary, toxic + ordinary, 3, [(-np.inf, 0.1), (1.0, 0.5), (5.0, 0.9)])
    texts = [" ".join(word() for _ in range(n)) for n in (0, 1, 11, 12, 13, 200)] + ["", "!!", "É l'été " * 40]

    def alone(dictionary, data):
        d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=zstd_toxicity._params())
        return len(zstandard.ZstdCompressor(compression_params=zstd_toxicity._params(), dict_data=d).compress(data))

    for text, score in zip(texts, model.score(texts)):
        w = zstd_toxicity.Words.of([text])
        windows = list(w.windows(np.ones(len(w.whole), bool)))
        saved = [alone(model.ordinary, x) - alone(model.toxic, x) for x in windows]
        x = sum(v for v in saved if v >= 3) / max(1, len(windows)) ** 0.5
        assert score == max((p for at, p in model.steps if x >= at))


def test_additive_model_equals_slow_loops():
    rng = np.random.default_rng(12)
    x = rng.normal(0, 1, (300, len(additive_quality.FEATURES)))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    m = additive_quality.fit(x, y)
    for row, got in zip(x, m.margin(x)):
        bins = [sum(v >= c for c in cuts) for v, cuts in zip(row, m.cuts)]
        want = m.intercept + sum(t[b] for t, b in zip(m.tables, bins)) + sum(t[m.coarse[i][bins[i]], m.coarse[j][bins[j]]] for (i, j), t in zip(m.pairs, m.pair_tables))
        assert abs(got - want) < 1e-9
    assert ((m.score(x) > 0.5) == (y > 0)).mean() > 0.95
    for _ in range(200):
        n = int(rng.integers(1, 12))
        g, h = rng.normal(0, 1, n), rng.random(n) + 0.01
        worth = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 2.0)
        want = [0, n]
        for _ in range(2):
            gains = {k: worth(a, k) + worth(k, b) - worth(a, b) for a, b in zip(want, want[1:]) for k in range(a + 1, b)}
            if gains and max(gains.values()) > 1e-9:
                want = sorted([*want, max(gains, key=gains.get)])
        assert additive_quality._best_cuts(g, h) == want


def test_samples_that_fit_are_the_dictionary_whole():
    assert zstd_toxicity.trained([b"abc" * 9, b"xyz" * 9, b"abc" * 9], 100, 32) == b"abc" * 9 + b"xyz" * 9
    one = zstd_toxicity.trained([bytes(np.random.default_rng(1).integers(0, 256, 100_000, np.uint8))], 8192, 32)
    assert 0 < len(one) <= 8192


def test_training_reads_one_text_of_an_id_within_a_bound_of_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(zstd_toxicity, "fit", lambda texts, toxic: seen.append((texts, toxic.tolist())) or zstd_toxicity.Model())
    texts = [(i, f"text {i}") for i in range(20)] * 30 + [(20, LONG), (21, None), (None, "x")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(22)], "doc_id bigint, quality int, toxic int")
    zstd_toxicity.train(df, labels, max_bytes=10_000)
    kept = [i for i in range(22) if not held_out(i)]
    assert seen[0][0] == ["" if i == 21 else f"text {i}" for i in kept if i != 20] and seen[0][1] == [i % 2 for i in kept if i != 20]
    x = []
    monkeypatch.setattr(additive_quality, "fit", lambda m, y: x.append(len(m)) or additive_quality.Model())
    additive_quality.train(df, labels)
    assert x == [len(kept)]


def test_odd_texts_get_scores(spark):
    texts = [None, "", " ", "\n\n", "!!!", "é", LONG, "word " * 50, "word " * 50] * 3
    labels = spark.createDataFrame([(i, None if i == 4 else i % 2, i % 2) for i in range(len(texts))] + [(0, 1, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    for module, label in ((additive_quality, "quality"), (zstd_toxicity, "toxic")):
        df = docs(spark, texts)
        model = module.train(df, labels, label)
        got = {r["doc_id"]: r["score"] for r in module.score(df, model).collect()}
        assert len(got) == len(texts) and all(0 <= s <= 1 for s in got.values()) and got[7] == got[8] and got[0] == got[1]
        assert module.keep(df, model, 0.5).columns == df.columns
    one = labels.withColumns({"quality": F.lit(1), "toxic": F.lit(0)})
    assert all(r["score"] > 0.5 for r in additive_quality.score(df, additive_quality.train(df, one)).collect())
    assert all(r["score"] < 0.5 for r in zstd_toxicity.score(df, zstd_toxicity.train(df, one)).collect())
