"""The engine's tables in a catalogue, and how rows get into them. Creating them again changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of the chunk store: joins on the hash, window after window, find it dealt already. Changing the number needs a new table.
BUCKETS = 64
#: Columns, partition, and bucketing of each table.
DDL = {
    "tf_spans": (
        "trace_id STRING, span_id STRING, session_id STRING, ts TIMESTAMP, service STRING, span_name STRING, version STRING, model STRING, provider STRING, latency_ms BIGINT, "
        "input_tokens BIGINT, output_tokens BIGINT, temperature FLOAT, finish_reason STRING, status_code STRING, intent STRING, scam_type STRING, greeting_template STRING, seq BIGINT, inserted_at TIMESTAMP, date DATE",
        "date", "",
    ),
    "user_sessions": ("user_id STRING, session_id STRING, trace_id STRING, seq BIGINT, inserted_at TIMESTAMP, date DATE", "date", ""),
    "session_end_reason": ("session_id STRING, end_reason STRING, turns BIGINT, seq BIGINT, classified_at TIMESTAMP, date DATE", "date", ""),
    "archive_index": ("trace_id STRING, hour INT, session_id STRING, ts TIMESTAMP, spans BIGINT, bytes BIGINT, batch_id BIGINT, date DATE", "date", ""),
    "cas_chunks": ("hash STRING, data BINARY, raw_len INT, crc BIGINT, batch_id BIGINT", "batch_id", f"CLUSTERED BY (hash) SORTED BY (hash) INTO {BUCKETS} BUCKETS"),
}
#: Columns that say when a row was written; they are filled in where the rows lack them.
WRITTEN_AT = ("inserted_at", "classified_at")


def create(spark: SparkSession, database: str = "default") -> list[str]:
    """Creates what is missing; returns the names of all tables."""
    for name, (columns, partition, buckets) in DDL.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet PARTITIONED BY ({partition}) {buckets}")
    return sorted(DDL)


def append(rows: DataFrame, name: str, database: str = "default", replace_batch: bool = False) -> None:
    """Add rows to a table by the names of their columns. Columns that the rows lack are null, when they were written is now, and a date is that of ``ts``.

    ``replace_batch``: the partitions that the rows fall into are overwritten, so that a batch that is repeated replaces itself.
    """
    if name not in DDL:
        raise ValueError(f"no table {name!r}")
    spark = rows.sparkSession
    target = spark.table(f"{database}.{name}")

    def column(c: str, kind) -> F.Column:
        if c in rows.columns:
            return F.col(c).cast(kind).alias(c)
        if c in WRITTEN_AT:
            return F.current_timestamp().alias(c)
        if c == "date" and "ts" in rows.columns:
            return F.to_date("ts").alias(c)
        return F.lit(None).cast(kind).alias(c)

    out = rows.select(*[column(f.name, f.dataType) for f in target.schema.fields])
    if DDL[name][2]:
        out = out.repartition(BUCKETS, "hash")  # a task holds whole buckets, so that each gets one file
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic" if replace_batch else before)
    try:
        out.write.insertInto(f"{database}.{name}", overwrite=replace_batch)
    finally:
        spark.conf.set(mode, before)


def truncate(spark: SparkSession, name: str, database: str = "default") -> None:
    """Empties one table; only ever on an explicit call."""
    if name not in DDL:
        raise ValueError(f"no table {name!r}")
    spark.sql(f"TRUNCATE TABLE {database}.{name}")
