"""Where raw messages come from: a broker, or files that land in a folder. The format is a parameter, as clients are add-ons."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = "value binary, seq bigint"
#: Offsets repeat from one partition of a topic to the next; between partitions there is no order of arrival. The key of a topic keeps a trace in one.
TOPIC = ("value", "offset AS seq", "partition", "timestamp")


def raw_stream(spark: SparkSession, fmt: str, where: str | None = None, schema: str = MESSAGE, **options: str) -> DataFrame:
    """An endless source, from its start on. ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger`` among the options bounds a batch."""
    r = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        options.setdefault("startingOffsets", "earliest")
        return r.options(**options).load().selectExpr(*TOPIC)
    return r.schema(schema).load(where)


def raw_batch(
    spark: SparkSession, fmt: str, where: str | None = None, schema: str = MESSAGE, limit: int | None = None, since: datetime | None = None, until: datetime | None = None, **options: str
) -> DataFrame:
    """All that is there, or its first ``limit`` messages in order; of messages with a ``timestamp``, those from ``since`` on and before ``until``.

    A topic finds the bounds by its own index of times, before a message is read; of files they are a filter on the scan.
    """
    millis = lambda t: str(int(t.timestamp() * 1000))
    r = spark.read.format(fmt)
    if fmt == "kafka":
        bounds = {"startingTimestamp": millis(since)} if since else {"startingOffsets": "earliest"}
        bounds |= {"endingTimestamp": millis(until)} if until else {"endingOffsets": "latest"}
        df = r.options(**(bounds | options)).load().selectExpr(*TOPIC)
    else:
        df = r.options(**options).schema(schema).load(where)
        for bound, ok in ((since, lambda t: F.col("timestamp") >= t), (until, lambda t: F.col("timestamp") < t)):
            if bound is not None:
                df = df.filter(ok(F.lit(bound)))
    order = [c for c in ("seq", "partition") if c in df.columns]
    return df.orderBy(*order).limit(limit) if limit is not None else df
