"""The same processors over streams and over archive windows; deliveries that repeat replace themselves.

A processor maps spans to rows by table name. Every batch writes each table to a folder of its own (``batch_id=n``), in
overwrite mode, before the stream's offsets are committed: data before pointer, and a replayed batch leaves no second copy.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.archive import Archive
from ..operators.dedup import ExtractConfig, candidates, chunks_named, chunks_of, lean, once_a_partition, restore
from ..sources import thin
from .tables import Tables as Tables

Processor = Callable[[DataFrame], dict[str, DataFrame]]


#: Bytes of files that a task of a batch reads at most. Unpacked and decoded they are several times as many, and a task that reads the kept batch reads all of its part.
FILE_BYTES = 16 << 20
#: The same of lines, of which a consumer's batch keeps the text: a few times as many bytes unpacked.
LINE_BYTES = 8 << 20
FILE_SETTING = "spark.sql.files.maxPartitionBytes"


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, every: str | None, most: int | None = None) -> StreamingQuery:
    spark, most = stream.sparkSession, most or FILE_BYTES
    # Files of a batch are dealt to tasks when it is planned, by the session's settings of that time, so this one stays.
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(FILE_SETTING)) > most:
        spark.conf.set(FILE_SETTING, str(most))
    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def run_stream(lines: DataFrame, processor: Processor, sink: Tables, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """lines: a stream of ``value, seq`` of thin spans. Lines that hold no span go to ``poison``; an error in the processor stops the query.

    ``every``: a trigger interval; without one the query takes what is there and ends.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            sink.write("poison", thin.poison(batch), batch_id)
            sink.write_all(processor(thin.decode(batch)), batch_id)
        finally:
            batch.unpersist()

    return _start(lines, each, checkpoint, every, LINE_BYTES)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def run_dedup(spans: DataFrame, sink: Tables, checkpoint: str, kind: str = "wholefield", config: ExtractConfig = ExtractConfig(), every: str | None = None, known: DataFrame | None = None) -> StreamingQuery:
    """Raw spans to chunks and thin spans; chunks of a batch are stored before the spans that point to them.

    Which hashes are stored is the stream's own state, by hash, in RocksDB and the checkpoint: a batch reads no chunk or hash of an earlier one. Only hashes
    go through the state, once from each partition. A replayed batch finds the state that it began with. ``known``: ``hash`` of chunks
    that are stored elsewhere. The spans of ``otlp.decode_all`` bring bad messages along, which go to ``quarantine``; these two branches of
    the stream each decode. ``metrics.DedupMetrics`` reads the counters that the plan takes on its way.
    """
    spark = spans.sparkSession
    chunks = chunks_of(candidates(spans, config), kind).select("hash", "pos", F.octet_length("data").cast("long").alias("len"))
    chunks = chunks.observe("chunks", F.count("*").alias("chunks"), F.count_if(F.col("pos") == 0).alias("candidates"), F.sum("len").alias("content_bytes"))
    fresh = once_a_partition(chunks).dropDuplicates(["hash"])
    if known is not None:
        fresh = fresh.join(known.select("hash"), "hash", "left_anti")
    fresh = fresh.observe("fresh", F.count("*").alias("misses"), F.sum("len").alias("stored_bytes"))
    good = F.col("bad").isNull() if "bad" in spans.columns else F.lit(True)
    counted = spans.observe("spans", F.count_if(good).alias("spans"), F.count_if(~good).alias("bad"))
    whole = counted.select(F.struct(*spans.columns).alias("span"), F.lit(None).cast("string").alias("hash"))
    rows = whole.unionByName(fresh.select(F.lit(None).cast(whole.schema["span"].dataType).alias("span"), "hash"))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            own = batch.filter("span IS NOT NULL").select("span.*")
            if "bad" in own.columns:
                sink.write("quarantine", own.filter("bad IS NOT NULL").select(F.col("bad").alias("value"), "seq"), batch_id)
                own = own.filter("bad IS NULL").drop("bad")
            chunks = chunks_of(candidates(own, config), kind)
            sink.write("chunks", chunks_named(chunks, batch.filter("hash IS NOT NULL")), batch_id)
            sink.write("thin", thin.encode(lean(own, chunks, kind, config)), batch_id)
        finally:
            batch.unpersist()

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a query keeps the settings that it starts with
    try:
        return _start(rows, each, checkpoint, every)
    finally:
        spark.conf.set(STATE_STORE, before)


def run_archive(lines: DataFrame, archive: Archive, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Thin spans to the archive, each to the hour of its event."""
    return _start(lines, lambda batch, batch_id: archive.append(thin.decode(batch), batch_id), checkpoint, every, LINE_BYTES)


def run_batch(archive: Archive, processor: Processor, frm: datetime, to: datetime, store: DataFrame | None = None, session_id: str | None = None, expand_sessions: bool = False) -> dict[str, DataFrame]:
    """A processor over a window of the archive, text resolved when there is a store."""
    spans = archive.load_range(frm, to, session_id, expand_sessions).drop("date", "hour", "batch_id")
    return processor(restore(spans, store) if store is not None else spans)


def per_session(spans: DataFrame, function: Callable, schema: str) -> DataFrame:
    """For logic that expressions can't hold: a function over the spans of one session, as a pandas frame in order of start.

    A session is handed over whole, so it must fit one worker; the empty session, which isn't one, is left out.
    """
    import pandas as pd

    from ..functions import attrs as A

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return function(frame.sort_values(["start_ns", "seq"], kind="stable"))

    return spans.withColumn("session", A.session_id()).filter("session != ''").groupBy("session").applyInPandas(run, schema)
