"""Heavy text out of spans into a content-addressed store, and back."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import refs
from ..session import in_arrow
from .chunkers import chunker

#: Hashes that a partition remembers; then it starts anew, and a hash may leave it again.
REMEMBERED = 100_000


@dataclass(frozen=True)
class ExtractConfig:
    """Which values are candidates: attribute paths (``*`` is exactly one dot-separated segment), events, least bytes."""

    paths: tuple[str, ...] = (
        # The three content conventions, then fields of the domain.
        "gen_ai.system_instructions", "gen_ai.input.messages", "gen_ai.output.messages",
        "gen_ai.prompt.*.content", "gen_ai.completion.*.content",
        "greeting.text", "turn.input",
    )
    events: tuple[str, ...] = ("gen_ai.content.prompt", "gen_ai.content.completion")
    min_size: int = 1024

    def __post_init__(self) -> None:
        if self.min_size < 1:
            raise ValueError("an empty value has no chunks and so no reference: min_size must be 1 at least")

    def path_pattern(self) -> str:
        return "^(" + "|".join(r"[^.]*".join(map(re.escape, p.split("*"))) for p in self.paths) + ")$"


def candidates(spans: DataFrame, config: ExtractConfig = ExtractConfig()) -> DataFrame:
    """``trace_id, span_id, seq, event_index (-1: the span), attr_index, path, value`` of every candidate.

    The place of a value is its position, so that equal keys don't get in each other's way.
    """
    heavy = lambda a: F.octet_length(a["value"]["s"]) >= config.min_size
    place = lambda e, i, path, a: F.struct(F.lit(e).cast("int").alias("event_index") if isinstance(e, int) else e.cast("int").alias("event_index"), i.alias("attr_index"), path.alias("path"), a["value"]["s"].alias("value"), heavy(a).alias("heavy"))
    own = F.filter(F.transform("attributes", lambda a, i: F.struct(place(-1, i, a["key"], a).alias("c"), a["key"].rlike(config.path_pattern()).alias("ok"))), lambda x: x["ok"] & x["c"]["heavy"])
    of_events = F.flatten(
        F.transform(
            "events",
            lambda e, k: F.transform(
                e["attributes"],
                lambda a, i: F.struct(place(k, i, F.concat(F.lit("event:"), e["name"], F.lit(":"), a["key"]), a).alias("c"), e["name"].isin(*config.events).alias("ok")),
            ),
        )
    )
    found = F.concat(F.coalesce(own, F.array()), F.coalesce(F.filter(of_events, lambda x: x["ok"] & x["c"]["heavy"]), F.array()))
    return spans.select("trace_id", "span_id", "seq", F.explode(F.transform(found, lambda x: x["c"])).alias("c")).select("trace_id", "span_id", "seq", "c.event_index", "c.attr_index", "c.path", "c.value")


PLACE = ("trace_id", "span_id", "seq", "event_index", "attr_index")


def chunks_of(found: DataFrame, kind: str = "wholefield") -> DataFrame:
    """``PLACE, pos, hash, data`` for all candidates."""
    return chunker(kind)(found.select(*PLACE, F.encode("value", "UTF-8").alias("value")))


def new_chunks(chunks: DataFrame, store: DataFrame | None) -> DataFrame:
    """What the store lacks, once each: ``hash, data, raw_len, crc``.

    Each partition takes one copy of a chunk before anything moves, and one copy of each leaves it; the probe of the store follows on the same
    partitioning, so only the store's hashes are shuffled for it.
    """
    one = chunks.groupBy("hash").agg(F.first("data").alias("data"))
    return _stored(one.join(store.select("hash"), "hash", "left_anti") if store is not None else one)


def chunks_named(chunks: DataFrame, hashes: DataFrame) -> DataFrame:
    """The chunks of ``hashes``, once each, in the form of ``new_chunks``; one copy of each leaves a partition."""
    return _stored(chunks.groupBy("hash").agg(F.first("data").alias("data")).join(hashes.select("hash"), "hash", "left_semi"))


def _stored(one: DataFrame) -> DataFrame:
    return one.select("hash", "data", F.octet_length("data").alias("raw_len"), F.crc32("data").alias("crc"))


def once_a_partition(hashes: DataFrame) -> DataFrame:
    """``hash, len`` with a hash once in each partition, or in each ``REMEMBERED`` different ones of it, so that a frequent one isn't shuffled as often as it occurs."""
    most = REMEMBERED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for b in batches:
            new = []
            if len(seen) > most:
                seen.clear()
            for h in b.column(0).to_pylist():
                new.append(h not in seen)
                seen.add(h)
            yield b.filter(pa.array(new, pa.bool_()))

    return in_arrow(hashes.select("hash", "len"), run, "hash string, len bigint")


def refs_of(chunks: DataFrame) -> DataFrame:
    """``PLACE, ref`` for each candidate."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "hash")))
    return chunks.groupBy(*PLACE).agg(ordered.alias("h")).select(*PLACE, refs.make_ref(F.transform("h", lambda x: x["hash"])).alias("ref"))


def _replaced(by: Column, attrs: Column, event: Column) -> Column:
    """Attributes of which those listed in ``by`` (event_index, attr_index, text) get another string value."""
    hit = lambda i: F.get(F.filter(by, lambda r: (r["event_index"] == event) & (r["attr_index"] == i)), F.lit(0))["text"]
    return F.transform(attrs, lambda a, i: F.struct(a["key"].alias("key"), F.when(hit(i).isNotNull(), a["value"].withField("s", hit(i))).otherwise(a["value"]).alias("value")))


def with_texts(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """texts: ``PLACE, text``. Every span row is kept; those named in ``texts`` get the text at its place."""
    by = texts.groupBy("trace_id", "span_id", "seq").agg(F.collect_list(F.struct("event_index", "attr_index", "text")).alias("_by"))
    out = spans.join(by, ["trace_id", "span_id", "seq"], "left")
    b = F.coalesce("_by", F.array().cast("array<struct<event_index:int,attr_index:int,text:string>>"))
    changed = out.withColumns({
        "attributes": F.when(F.col("_by").isNull(), F.col("attributes")).otherwise(_replaced(b, F.col("attributes"), F.lit(-1))),
        "events": F.when(F.col("_by").isNull(), F.col("events")).otherwise(F.transform("events", lambda e, k: e.withField("attributes", _replaced(b, e["attributes"], k)))),
    })
    return changed.select(spans.columns)


def lean(spans: DataFrame, chunks: DataFrame, kind: str = "wholefield", config: ExtractConfig = ExtractConfig()) -> DataFrame:
    """Spans with references in place of their heavy values. chunks: of ``chunks_of``; the reference of a whole field is its own hash, so nothing is joined for it."""
    if kind != "wholefield":
        return with_texts(spans, refs_of(chunks).withColumnRenamed("ref", "text"))
    text = lambda a: a["value"]["s"]
    ref = lambda a: refs.make_ref(F.array(F.sha2(F.encode(text(a), "UTF-8"), 256)))
    put = lambda attrs, ok: F.transform(attrs, lambda a: F.when(ok(a) & (F.octet_length(text(a)) >= config.min_size), a.withField("value.s", ref(a))).otherwise(a))
    own = put(F.col("attributes"), lambda a: a["key"].rlike(config.path_pattern()))
    events = F.transform("events", lambda e: F.when(e["name"].isin(*config.events), e.withField("attributes", put(e["attributes"], lambda a: F.lit(True)))).otherwise(e))
    return spans.withColumns({"attributes": own, "events": events})


def thin(spans: DataFrame, kind: str = "wholefield", config: ExtractConfig = ExtractConfig(), store: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(thin spans, chunks that the store lacks). Write the chunks before the spans that point to them."""
    chunks = chunks_of(candidates(spans, config), kind)
    return lean(spans, chunks, kind, config), new_chunks(chunks, store)


def ref_places(spans: DataFrame) -> DataFrame:
    """``PLACE, pos, hash`` of every reference in top-level strings of spans and events."""
    place = lambda e, i, a: F.struct(e.cast("int").alias("event_index"), i.alias("attr_index"), a["value"]["s"].alias("s"))
    own = F.transform("attributes", lambda a, i: place(F.lit(-1), i, a))
    of_events = F.flatten(F.transform("events", lambda e, k: F.transform(e["attributes"], lambda a, i: place(k, i, a))))
    every = F.filter(F.concat(F.coalesce(own, F.array()), F.coalesce(of_events, F.array())), lambda x: refs.is_ref(x["s"]))
    one = spans.select("trace_id", "span_id", "seq", F.explode(every).alias("c"))
    return one.select("trace_id", "span_id", "seq", "c.event_index", "c.attr_index", F.posexplode(refs.parse_ref(F.col("c.s"))).alias("pos", "hash"))


def resolved(spans: DataFrame, store: DataFrame) -> DataFrame:
    """``PLACE, text, missing, damaged`` of every reference; each chunk is fetched by one join, however often it is used.

    Bytes are put together before they become text, as a cut may split a character. Texts move once after the join, to the place of their span,
    where both the pieces of a value and the values of a span meet.
    """
    s = store.select("hash", "data", (F.crc32("data") == F.col("crc")).alias("good"))
    parts = ref_places(spans).join(s, "hash", "left").repartition("trace_id", "span_id", "seq")
    got = parts.groupBy(*PLACE).agg(
        F.sort_array(F.collect_list(F.struct("pos", "data"))).alias("d"),
        F.count_if(F.col("data").isNull()).alias("missing"), F.count_if(~F.coalesce("good", F.lit(True))).alias("damaged"),
    )
    data = F.aggregate("d", F.lit(b""), lambda a, x: F.concat(a, F.coalesce(x["data"], F.lit(b""))))
    return got.select(*PLACE, F.decode(data, "UTF-8").alias("text"), "missing", "damaged")


def restore(spans: DataFrame, store: DataFrame, strict: bool = True) -> DataFrame:
    """Spans with every reference resolved. A missing or damaged chunk fails the query unless ``strict`` is off; then it stays a reference."""
    r = resolved(spans, store)
    bad = (F.col("missing") > 0) | (F.col("damaged") > 0)
    if strict:
        r = r.withColumn("text", F.when(bad, F.raise_error(F.concat(F.lit("chunks missing or damaged in span "), F.col("span_id")))).otherwise(F.col("text")))
    else:
        r = r.filter(~bad)
    return with_texts(spans, r.select(*PLACE, "text"))


def meter(found: DataFrame, kind: str) -> DataFrame:
    """What a chunker would save: fields, chunks, distinct chunks, bytes, saved bytes and per cent (0 without content)."""
    c = chunks_of(found, kind)
    size = F.octet_length("data").cast("long")
    per = c.groupBy("hash").agg(F.count("*").alias("uses"), F.max(size).alias("len"), F.count_if(F.col("pos") == 0).alias("fields"))
    out = per.agg(
        F.coalesce(F.sum("fields"), F.lit(0)).alias("fields"), F.coalesce(F.sum("uses"), F.lit(0)).alias("chunks"), F.count("*").alias("unique_chunks"),
        F.coalesce(F.sum(F.col("uses") * F.col("len")), F.lit(0)).alias("content_bytes"), F.coalesce(F.sum("len"), F.lit(0)).alias("unique_bytes"),
    )
    saved = F.col("content_bytes") - F.col("unique_bytes")
    return out.select(F.lit(kind).alias("chunker"), "*", saved.alias("saved_bytes"), F.coalesce(F.try_divide(saved * 100.0, F.col("content_bytes")), F.lit(0.0)).alias("saved_pct"))


def compare(base: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of ``meter``, each with ``delta_bytes``: what it saves beyond the first."""
    rows = base
    for o in others:
        rows = rows.unionByName(o)
    return rows.crossJoin(F.broadcast(base.select(F.col("saved_bytes").alias("_base")))).withColumn("delta_bytes", F.col("saved_bytes") - F.col("_base")).drop("_base")  # one row each


def first_seen(chunks: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """Hit or miss of each chunk, by ``PLACE, pos, hash, len``: a miss is the first of a hash, in order of arrival, that the store lacks.

    The first place of each hash is a minimum that partitions take on their own, so a chunk that all spans share gathers in no task.
    """
    place = F.struct("seq", "event_index", "attr_index", "pos", "trace_id", "span_id")
    c = chunks.select(*PLACE, "pos", "hash", F.octet_length("data").cast("long").alias("len"))
    first = c.groupBy("hash").agg(F.min(place).alias("first"))
    if store is not None:
        first = first.join(store.select("hash"), "hash", "left_anti")
    first = first.select("hash", F.col("first").alias("_first"))
    return c.join(first, "hash", "left").withColumn("miss", F.coalesce(place == F.col("_first"), F.lit(False))).drop("_first")


def dedup_stats(spans: DataFrame, kind: str = "wholefield", config: ExtractConfig = ExtractConfig(), store: DataFrame | None = None) -> DataFrame:
    """One row of counters for a batch of spans."""
    seen = first_seen(chunks_of(candidates(spans, config), kind), store)
    size = F.col("len")
    c = seen.agg(
        F.count("*").alias("chunks"), F.count_if("miss").alias("misses"), F.count_if(~F.col("miss")).alias("hits"), F.count_if(F.col("pos") == 0).alias("candidates"),
        F.coalesce(F.sum(size), F.lit(0)).alias("content_bytes"), F.coalesce(F.sum(F.when(F.col("miss"), size)), F.lit(0)).alias("stored_bytes"),
    )
    # A reference is its prefix and 64 letters for each hash, with commas between.
    ref_bytes = len(refs.PREFIX) * F.col("candidates") + 65 * F.col("chunks") - F.col("candidates")
    return spans.agg(F.count("*").alias("spans")).crossJoin(F.broadcast(c)).withColumn("ref_bytes", ref_bytes)
