"""The pipeline's stages, each against what a plain reading of it gives."""

import corpus_pipeline as P
from pyspark.sql import functions as F
from test_texts import brute_components, check_packing, spans_of

from spanloom.llm import additive_quality, zstd_toxicity
from spanloom.llm.shared import materialize
from spanloom.session import table

SF = "/root/testdata/sf0.01"


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages(spark):
    docs = table(spark, SF, "documents").filter("doc_id < 300")
    columns = docs.columns
    labels = table(spark, SF, "labels")
    for name, stage in P.STAGES:
        out = materialize(stage(spark, docs, SF), name)
        before, after = ids(docs), ids(out)
        assert after <= before
        if name == "quality_classifier":
            score = additive_quality.score(docs, additive_quality.train(docs, labels))
            assert after == ids(score.filter(F.col("score") >= P.QUALITY_THRESHOLD))
        if name == "toxicity":
            score = zstd_toxicity.score(docs, zstd_toxicity.train(docs, labels))
            assert after == ids(score.filter(F.col("score") < P.TOXIC_THRESHOLD))
        if name == "ngram_jaccard_join":
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert after == {i for i, (_, c) in brute_components(texts, P.SHINGLE_WORDS, P.PERCENT).items() if i == c}
        if name == "secret_scans":
            assert after == before
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            for r in out.collect():
                assert (r["text"] == texts[r["doc_id"]]) == (not spans_of(texts[r["doc_id"]])) and r["n_chars"] == len(r["text"])
        if name == "packing":
            assert check_packing(out.collect(), {r["doc_id"]: r["text"] for r in docs.collect()}) < 0.05
        else:
            assert out.columns == columns
        docs = out


def test_empty_table(spark, tmp_path):
    for t in ("documents", "labels"):
        table(spark, SF, t).limit(0).write.parquet(f"file://{tmp_path}/{t}.parquet")
    assert P.run(spark, f"file://{tmp_path}").count() == 0


def test_run(spark, sf):
    assert P.run(spark, sf).count() > 0
