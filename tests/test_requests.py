"""Requests for restored traces: what is checked, what is counted, and what an error is called."""

import json

from conftest import kvs, span

from spanloom.operators import archive, dedup, requests


def test_answers_and_counters(spark, spans_df, tmp_path):
    base = f"file://{tmp_path}"
    rows = [span(trace_id=f"{i:032x}", span_id=f"{i:016x}", start_ns=i * 60_000_000_000, attributes=kvs(gen_ai__system_instructions=c * 2000, session__id=f"s{i % 2}"), seq=i) for i, c in enumerate("abca")]
    lean, chunks = dedup.thin(spans_df(rows))
    a = archive.Archive(spark, f"{base}/archive")
    a.append(lean, 0)
    chunks.write.parquet(f"{base}/chunks")
    store = spark.read.parquet(f"{base}/chunks")
    service = requests.RestoreService(a, store)
    assert service.trace("0" * 31 + "2", f"{base}/one") == requests.Answer("ok", 1)
    got = json.loads(spark.read.json(f"{base}/one").first()["span"])
    assert got["attributes"][0]["value"]["s"] == "c" * 2000
    assert service.range("1970-01-01T00:01:00Z", "1970-01-01T00:03:00Z", f"{base}/many") == requests.Answer("ok", 3)
    assert service.range("1970-01-01T00:01:00Z", "1970-01-01T00:03:00Z", f"{base}/of", "s1").spans == 2
    assert service.range("1971-01-01T00:00:00Z", "1971-01-02T00:00:00Z", f"{base}/none") == requests.Answer("ok", 0)
    assert service.trace("f" * 32, f"{base}/x").status == "not_found"
    for frm, to in (("", ""), ("1970-01-01", "1970-01-02T00:00:00Z"), ("1970-01-02T00:00:00Z", "1970-01-01T00:00:00Z")):
        assert service.range(frm, to, f"{base}/x").status == "bad_request"
    broken = requests.RestoreService(a, store.filter("false"), service.metrics)
    assert broken.trace("0" * 31 + "2", f"{base}/x").status == "unresolved"
    m = service.metrics
    assert m.requests == {("single", "ok"): 1, ("range", "ok"): 3, ("single", "not_found"): 1, ("range", "bad_request"): 3, ("single", "unresolved"): 1}
    assert m.spans == {"single": 1, "range": 5} and m.ref_errors == 1 and sum(m.latency["range"]) == 6
    assert {r["name"] for r in m.rows(spark).collect()} == {"requests", "spans", "latency", "ref_errors"}
