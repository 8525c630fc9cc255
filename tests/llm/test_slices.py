"""Slices of op4's index give the same links as one shuffle of it."""

from test_texts import brute_components, docs, near_copies

from spanloom.llm import prefix_join


def test_slices_find_all_links(spark, monkeypatch):
    texts, labels = near_copies()[:80], []
    real = prefix_join.materialize
    monkeypatch.setattr(prefix_join, "materialize", lambda df, label, *a: labels.append(label) or real(df, label, *a))
    monkeypatch.setattr(prefix_join, "SLICE_ROWS", 700)
    monkeypatch.setattr(prefix_join, "BLOCK", 8)
    got = prefix_join.link_components(docs(spark, texts).repartition(3), 4, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(dict(enumerate(texts)), 4, 85)
    assert labels.count("group_pairs") > 2
