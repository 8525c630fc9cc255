"""Checks of raw traffic and of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import attrs as A
from ..functions import content as C


def raw_audit(spans: DataFrame, min_size: int = 1024) -> DataFrame:
    """One row over raw spans: counts, coverage, repeated system prompts, and what whole-field storage would save."""
    system = C.system_prompt()
    base = spans.agg(
        F.count_distinct("trace_id").alias("messages"), F.count("*").alias("spans"), F.count_if(A.session_id() != "").alias("with_session"), F.count_distinct("service").alias("services"),
        F.count_if(system != "").alias("system_prompts"), F.count_distinct(F.nullif(system, F.lit(""))).alias("unique_system_prompts"),
    )
    heavy = spans.select(F.explode(F.filter(F.transform("attributes", lambda a: a["value"]["s"]), lambda s: F.octet_length(s) >= min_size)).alias("s"))
    per = heavy.groupBy(F.sha2("s", 256).alias("h")).agg(F.count("*").alias("n"), F.max(F.octet_length("s").cast("long")).alias("len"))
    saved = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("heavy_fields"), F.coalesce(F.sum(F.col("n") * F.col("len")), F.lit(0)).alias("heavy_bytes"), F.coalesce(F.sum("len"), F.lit(0)).alias("unique_bytes")
    )
    pct = lambda a, b: F.coalesce(F.try_divide(100.0 * a, b), F.lit(0.0))
    return base.crossJoin(F.broadcast(saved)).withColumns({
        "session_pct": pct(F.col("with_session"), F.col("spans")),
        "system_dup_pct": pct(F.col("system_prompts") - F.col("unique_system_prompts"), F.col("system_prompts")),
        "saved_pct": pct(F.col("heavy_bytes") - F.col("unique_bytes"), F.col("heavy_bytes")),
    })


def smoke_asserts(audit: DataFrame) -> DataFrame:
    return audit.select(
        (F.col("messages") > 0).alias("has_messages"), (F.col("with_session") == F.col("spans")).alias("all_in_sessions"),
        (F.col("services") >= 3).alias("three_services"), (F.col("system_dup_pct") > 80).alias("system_prompts_repeat"),
    )


def store_inspect(store: DataFrame) -> DataFrame:
    return store.agg(F.count("*").alias("chunks"), F.coalesce(F.sum("raw_len"), F.lit(0)).cast("long").alias("bytes"), F.bround(F.avg("raw_len"), 3).alias("avg_bytes"))


def top_segments(store: DataFrame, n: int = 5) -> DataFrame:
    """The fullest segments; a segment is a prefix of the hash."""
    return store.groupBy(F.substring("hash", 1, 2).alias("segment")).agg(F.count("*").alias("chunks"), F.sum("raw_len").cast("long").alias("bytes")).orderBy(F.desc("chunks"), "segment").limit(n)


def index_inspect(frames: DataFrame) -> DataFrame:
    return frames.groupBy("date").agg(F.count("*").alias("frames"), F.count_distinct("trace_id").alias("traces"), F.count_distinct("hour").alias("bundles"))


def human_bytes(n: int) -> str:
    """For reports: binary units with one decimal."""
    x, units = float(n), ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]
    while x >= 1024 and len(units) > 1:
        x /= 1024
        units.pop(0)
    return f"{int(n)} B" if units[0] == "B" else f"{x:.1f} {units[0]}"
