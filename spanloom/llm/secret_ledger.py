"""Secret scans over an incremental blob ledger (operator 3).

Every text is content-addressed by its SHA-256. The ledger holds the findings of each pair of blob and rule version that
has been scanned, in Parquet under a shared folder. A scan first asks, by digests alone, which of its pairs the ledger lacks;
only their texts move: one copy of each blob is kept (first in each partition, then over all) and scanned, the findings are
appended, and the findings of all blobs are joined back to every row with that content.

``scan_history`` does this for every historical version of every path, from rows ``path, version, text``: versions with the same
content share one scan, and what is found in it comes back with all paths and versions that hold it.

Spans are code points, end exclusive, of the whole match. Defined results: a null text counts as empty and has no findings.
Copies and repeated rows get the findings of their blob. Matches of one kind don't overlap; those of different kinds may.
Two scans into one ledger at once may both append a pair; readers take each pair once. Texts are scanned whole. Only the named
columns are read, whatever others are called. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, drop_path, in_arrow, new_path, small_or_shuffled

SPANS = "array<struct<kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, the group that must have a least length, and that length."""

    kind: str
    pattern: str
    group: int
    least: int


#: The base rules. Runs are matched whole, so a length in the pattern finds what filtering would keep.
BASE_RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
BASE_VERSION = "base-1"


class Scanner:
    def __init__(self, rules: Sequence[Rule]) -> None:
        self.rules = [(r, re.compile(r.pattern)) for r in rules]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """By start, then by the order of the rules."""
        found = [(m.start(), i, m.end()) for i, (r, p) in enumerate(self.rules) for m in p.finditer(text) if m.end(r.group) - m.start(r.group) >= r.least]
        return [(self.rules[i][0].kind, a, b) for a, i, b in sorted(found)]


def _first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each blob of the partition."""
    seen: set[bytes] = set()
    for b in batches:
        keep = []
        for x in b.column(0).to_pylist():
            keep.append(x not in seen)
            seen.add(x)
        yield b.filter(pa.array(keep, pa.bool_()))


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan_blobs(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """blobs: ``blob, text``, all rows of a blob in one partition. Returns ``blob, spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for b in _first_copies(batches):
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                rows = [[{"kind": kind, "start": a, "end": e} for kind, a, e in scanner.spans(t or "")] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))], names=["blob", "spans"])

    return in_arrow(blobs, run, f"blob binary, spans {SPANS}")


class Ledger:
    """Findings by blob and rule version, in a folder that scans append to. A scan that is repeated appends nothing."""

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path = spark, path or new_path(spark, "ledger")

    SCHEMA = f"rule_version string, blob binary, spans {SPANS}"

    def exists(self) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def findings(self, version: str) -> DataFrame:
        """``blob, spans`` of all blobs with findings, once each."""
        found = self.read().filter((F.col("rule_version") == version) & (F.size("spans") > 0))
        return found.groupBy("blob").agg(F.first("spans").alias("spans"))

    def append(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)

    def drop(self) -> None:
        drop_path(self.spark, self.path)


def extend(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = BASE_RULES, version: str = BASE_VERSION, text_col: str = "text") -> DataFrame:
    """Scan what the ledger lacks of the blobs of ``docs``; returns ``blob, spans`` of all its blobs with findings."""
    scratch = Scratch(ledger.spark)
    blobs = docs.select(blob_of(F.col(text_col)).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if ledger.exists():
        known = ledger.read().filter(F.col("rule_version") == version).select("blob")
        unseen = small_or_shuffled(blobs.select("blob").distinct().join(known, "blob", "left_anti"), "unseen", scratch)
        blobs = blobs.join(unseen, "blob", "left_semi") if unseen.limit(1).count() else None
    if blobs is not None:
        one = in_arrow(blobs.select("blob", "text"), _first_copies, "blob binary, text string").repartition(F.col("blob"))
        ledger.append(scan_blobs(one, rules).select(F.lit(version).alias("rule_version"), "blob", "spans"))
    scratch.clear()
    return ledger.findings(version)


def scan(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = BASE_RULES, version: str = BASE_VERSION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, blob, spans`` for every row of ``docs``. The ledger then knows all its blobs under this version."""
    findings = small_or_shuffled(extend(docs, ledger, rules, version, text_col), "findings")
    rows = docs.select(F.col(id_col), blob_of(F.col(text_col)).alias("blob"))
    return rows.join(findings, "blob", "left").select(id_col, "blob", F.coalesce("spans", F.expr(f"CAST(array() AS {SPANS})")).alias("spans"))


def redact_documents(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = BASE_RULES, version: str = BASE_VERSION, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents, with all their columns, with ``[SECRET]`` for each span; ``length_col``, if there is one, follows the text."""
    blob, spans = (_free(docs, x) for x in ("_blob", "_spans"))
    findings = small_or_shuffled(extend(docs, ledger, rules, version, text_col).select(F.col("blob").alias(blob), F.col("spans").alias(spans)), "findings")
    out = docs.withColumn(blob, blob_of(F.col(text_col))).join(findings, blob, "left")
    changed = F.col(spans).isNotNull()
    out = out.withColumn(text_col, F.when(changed, redact(F.col(text_col), F.col(spans))).otherwise(F.col(text_col)))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(changed, F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return out.select(docs.columns)


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def scan_history(history: DataFrame, ledger: Ledger, rules: Sequence[Rule] = BASE_RULES, rules_version: str = BASE_VERSION, path_col: str = "path", version_col: str = "version", text_col: str = "text") -> DataFrame:
    """``path_col, version_col, blob, kind, start, end``: each finding at every version of every path that holds it."""
    findings = small_or_shuffled(extend(history, ledger, rules, rules_version, text_col).select("blob", F.explode("spans").alias("s")), "findings")
    rows = history.select(F.col(path_col), F.col(version_col), blob_of(F.col(text_col)).alias("blob"))
    return rows.join(findings, "blob").select(path_col, version_col, "blob", "s.kind", "s.start", "s.end")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span, overlapping ones as one, replaced by ``[SECRET]``."""
    merged = F.aggregate(
        spans, F.expr("CAST(array() AS array<struct<start:int,end:int>>)"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["end"] >= s["start"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    # Each piece is what stands between the last span (or the start) and the next (or the end).
    with_ends = F.concat(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), merged, F.array(F.struct(F.length(text).alias("start"), F.lit(0).alias("end"))))
    pieces = F.transform(F.sequence(F.lit(1), F.size(with_ends) - 1), lambda i: F.substr(text, F.get(with_ends, i - 1)["end"] + 1, F.get(with_ends, i)["start"] - F.get(with_ends, i - 1)["end"]))
    return F.when(F.size(spans) == 0, text).otherwise(F.array_join(pieces, "[SECRET]"))
