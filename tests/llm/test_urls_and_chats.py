import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from spanloom.llm import chat_format, url_filter
from spanloom.llm import queries as Q

URLS = [
    "https://A.Example.NET/en/1", "http://example.net/de/", "http://net/x", "http://notnet/x", "http://x.net", "http://x.net?a/", "http://shop.example.com/de/a#b", "http://example.com/en/", "http://a.org/fr/x",
    "http://a.org/en/x", "http://a.org:80/fr/x", "no scheme", "", None, "://net/", "ftp://user@net/", "http://x.net/a://b.org/fr/", "http://É.net/", "HTTP://X.ORG/fr/?q#h", "http://example.net/en", "http://a\nb.net/x",
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id bigint, url string, host string, verdict string")


def judge(url, rules):
    """By the definition, rule by rule."""
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:end].translate(str.maketrans(url_filter.UPPER, url_filter.LOWER)), rest[end:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = []
    for action, r in rules:
        h, p = url_filter.split_rule(r)
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len(h + p), len(h), h + p, action))
    rule, action = max(fit)[2:] if fit else (None, "allow")
    return host, path, rule, action


def test_urls(spark):
    want = {i: judge(u, Q.URL_RULES) for i, u in enumerate(URLS)}
    got = url_filter.judge_urls(pages(spark, URLS), Q.URL_RULES)
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()} == want
    joined = url_filter.judge_by_join(pages(spark, URLS), spark.createDataFrame(Q.URL_RULES, "action string, rule string"))
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in joined.collect()} == want


def test_collisions_are_confirmed(monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda x: 7)
    array = url_filter.DigestArray(url_filter.build_index(Q.URL_RULES))
    assert array.judge(["a.org", "b.net", "c.com"], ["/fr/", "/", "/"]) == [("org/fr/", "allow"), ("net/", "block"), None]


def test_rules_at_odds():
    array = url_filter.DigestArray(url_filter.build_index([("allow", "a.b/"), ("block", "A.b/"), ("allow", "x")]))
    assert array.judge(["a.b", "y.x"], ["/", ""]) == [("a.b/", "block"), ("x", "allow")]
    assert url_filter.DigestArray(url_filter.build_index([])).judge(["a"], ["/"]) == [None]


def test_no_pages(spark):
    assert url_filter.judge_urls(pages(spark, []), Q.URL_RULES).count() == 0


CHATS = {
    1: [("user", "a"), ("user", "b<"), ("assistant", "\\l\\\\<text>"), ("assistant", "</turn>\n<turn>")],
    2: [("system", ""), ("assistant", None), (None, "x"), (None, "y")],
    3: [("assistant", "\ufeffbom 🙂"), ("user", "\\"), ("assistant", "\\\\")],
    4: [("user", "only")],
    5: [("<part>", "role"), ("a\\", "b")],
    6: [("assistant" if i % 3 else "user", f"turn {i} <" + "é" * (i % 7)) for i in range(700)],
}


def chats(spark, of=CHATS):
    rows = [(c, t, r, x, "clash", 0) for c, turns in of.items() for t, (r, x) in enumerate(turns)]
    return spark.createDataFrame(rows[::-1], "conv_id bigint, turn bigint, role string, text string, formatted string, t int")


def test_chats_round_trip(spark):
    out = chat_format.format_chats(chats(spark))
    got = out.select("conv_id", "formatted", "loss_spans", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(got) == len(CHATS)
    for r in got:
        turns = [(a or "", b or "") for a, b in CHATS[r["conv_id"]]]
        assert [tuple(x) for x in r["t"]] == turns
        assert r["loss"] == "".join(b for a, b in turns if a == "assistant")
        merged = 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert r["formatted"].count(chat_format.TURN) == merged
        assert len(r["loss_spans"]) == sum(a == "assistant" for a, _ in turns)


def test_equal_turns_and_null_conversation(spark):
    df = spark.createDataFrame([(None, 1, "user", "b"), (None, 1, "user", "a"), (None, None, "user", "z"), (1, 1, "user", "a"), (1, 1, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: [x["text"] for x in r["t"]] for r in chat_format.format_chats(df).select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t")).collect()}
    assert got == {None: ["z", "a", "b"], 1: ["a", "a"]}


def test_no_chats(spark):
    assert chat_format.format_chats(chats(spark, {})).count() == 0


@pytest.mark.parametrize("name, tables", [("op2_url_filter", ["pages"]), ("op8_chat_format", ["conversations"]), ("op10_ball_tree", ["embeddings"]), ("op4_prefix_join", ["documents"])])
def test_queries_match_sql(spark, sf, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(Q.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = Q.queries()[name](spark, sf).select(columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_planted_conversation(spark, sf):
    r = Q.queries()["op8_chat_format"](spark, sf).filter("conv_id = -7").first()
    x = Q.PLANTED_TEXT
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{x}\nassistant\n{x}\n".encode()).hexdigest() and r["loss_sha256"] == hashlib.sha256(x.encode()).hexdigest()


def test_starts_on_three_levels(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "BLOCK", 3)
    rows = [(n, [(7 * i + n) % 11 for i in range(n)]) for n in (0, 1, 2, 3, 4, 9, 10, 27, 28, 100)]
    got = spark.createDataFrame(rows, "n int, x array<bigint>").select("n", chat_format.starts_of(F.col("x")).alias("s")).collect()
    assert {r["n"]: r["s"] for r in got} == {n: [sum(x[:i]) for i in range(n)] for n, x in rows}
