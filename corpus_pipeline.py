"""From raw documents to packed training sequences, in five stages. Each is written and read again as the next one's input.

Every stage works on all documents that its predecessor kept, and all but the last return the columns of documents.
Of a group of near duplicates one row stays, whether or not its rows have ids. Empty tables pass through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import additive_quality, nnls_packing, prefix_join, secret_ledger, zstd_toxicity
from spanloom.llm.shared import materialize
from spanloom.session import table

#: A document stays with a quality score of at least the first and a toxicity score below the second.
QUALITY_THRESHOLD, TOXIC_THRESHOLD = 0.7, 0.3
#: Words of a shingle, and the similarity in hundredths from which on documents are near duplicates.
SHINGLE_WORDS, PERCENT = 5, 80
VOCABULARY = "byte_bpe_50k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model rejects go."""
    model = additive_quality.train(docs, table(spark, sf_dir, "labels"))
    return additive_quality.keep(docs, model, QUALITY_THRESHOLD)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance finds toxic go."""
    model = zstd_toxicity.train(docs, table(spark, sf_dir, "labels"))
    return zstd_toxicity.keep(docs, model, TOXIC_THRESHOLD)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates one row stays, one with the smallest id."""
    return prefix_join.keep_first(docs, SHINGLE_WORDS, PERCENT)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return secret_ledger.redact_documents(docs, secret_ledger.Ledger(spark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 ids."""
    return nnls_packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL expresses the models, the merges of a tokenizer and the packing; tests hold the stages against brute force.
ORACLE_SQL = None
