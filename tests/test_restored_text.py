"""Queries that restore show text that only the store holds."""

import hashlib

import pytest
from pyspark.sql import functions as F

from spanloom.operators import dedup
from spanloom.plans import registry


@pytest.mark.parametrize("name", ["restore_trace", "restore_range"])
def test_heavy_text_comes_out_of_the_store(spark, sf, monkeypatch, name):
    """The store gets other bytes under the same hashes; a query whose text never went through it wouldn't notice."""
    thin = dedup.thin

    def other_store(*args, **kwargs):
        lean, chunks = thin(*args, **kwargs)
        return lean, chunks.withColumn("data", F.lit(b"stored")).withColumn("crc", F.crc32("data"))

    monkeypatch.setattr(dedup, "thin", other_store)
    got = {r["doc_id"]: r["text_sha"] for r in registry.queries()[name](spark, sf).collect()}
    heavy = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").filter("octet_length(text) >= 1024").select("doc_id").collect()} & set(got)
    assert heavy and {got[i] for i in heavy} == {hashlib.sha256(b"stored").hexdigest()}
