"""The seven marts, over the latest rows of facts. Each takes DataFrames and leaves the physical plan to the optimiser.

``any`` value of a group is its largest, rounding is half to even, percentiles are exact and interpolated, and a share of
nothing is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _holds(spans: DataFrame) -> DataFrame:
    """Sessions with how long they held the line; a later span extends its session, whenever it comes."""
    return spans.filter("session_id != ''").groupBy("session_id").agg(
        F.max("version").alias("version"), F.min("ts").alias("first"), (F.unix_millis(F.max("ts")) - F.unix_millis(F.min("ts"))).alias("hold_ms")
    )


#: Distinct whole numbers of a stretch: no window below holds more rows of one group.
STRETCH = 1 << 16


def _tallied(rows: DataFrame, keys: tuple[str, ...], value: str, shares: dict[str, float], *more: str) -> DataFrame:
    """By ``keys``: ``n``, ``avg_<column>`` of ``value`` and ``more``, and exact percentiles of the whole numbers in ``value``.

    Rows are counted by value before they move. Stretches of values are counted next, which says in which of them the ranks lie; only
    there the values themselves are looked at. So however many rows or values a group has, a window holds no more rows of it than it
    has stretches, or a stretch has numbers.
    """
    columns = (value, *more)
    parts = [f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("sum", F.sum), ("count", F.count))]
    stretch = F.floor(F.col(value) / STRETCH).alias("_stretch")
    by = rows.groupBy(*keys, stretch, value).agg(F.count("*").alias("_rows"), *parts)
    found, sums = F.col(f"_count_{value}"), [f"_{n}_{c}" for c in columns for n in ("sum", "count")]
    coarse = by.groupBy(*keys, "_stretch").agg(F.sum("_rows").alias("_rows"), *[F.sum(c).alias(c) for c in sums])
    w = Window.partitionBy(*keys)
    coarse = coarse.withColumns({"_upto": F.sum(found).over(w.orderBy("_stretch")), "_all": F.sum(found).over(w)})
    # Ranks count from 0; between two of them percentiles are interpolated.
    at = {n: p * (F.col("_all") - 1) for n, p in shares.items()}
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in at.values()])))
    here = F.exists(ranks, lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - found))
    wanted = coarse.filter(here).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_stretch").alias("_s"), (F.col("_upto") - found).alias("_before"), "_all")
    same = F.col("_stretch") == F.col("_s")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    fine = by.join(wanted, same).withColumn("_upto", F.col("_before") + F.sum(found).over(Window.partitionBy(*keys, "_stretch").orderBy(value)))
    sides = [F.min(F.when(F.col("_upto") > f(x), F.col(value))).alias(f"_{side}_{n}") for n, x in at.items() for side, f in (("lo", F.floor), ("hi", F.ceil))]
    of_ranks = fine.groupBy(*keys).agg(*sides).withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    out = coarse.groupBy(*keys).agg(F.sum("_rows").alias("n"), F.max("_all").alias("_all"), *[F.try_divide(F.sum(f"_sum_{c}").cast("double"), F.sum(f"_count_{c}")).alias(f"avg_{c}") for c in columns])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = out.join(of_ranks, same, "left")

    def between(n: str) -> F.Column:
        lo, hi, x = F.col(f"_lo_{n}"), F.col(f"_hi_{n}"), at[n]
        return F.when(lo == hi, lo.cast("double")).otherwise((F.ceil(x) - x) * lo + (x - F.floor(x)) * hi)

    return out.select(*keys, "n", *[f"avg_{c}" for c in columns], *[between(n).alias(n) for n in shares])


def end_reason_by_version(end_reasons: DataFrame, spans: DataFrame) -> DataFrame:
    versions = spans.filter("session_id != '' AND version != ''").groupBy("session_id").agg(F.max("version").alias("version"))
    return end_reasons.join(versions, "session_id").groupBy("version", "end_reason").agg(F.count("*").alias("sessions")).orderBy("version", F.desc("sessions"), "end_reason")


def hold_time_by_version(spans: DataFrame) -> DataFrame:
    t = _tallied(_holds(spans), ("version",), "hold_ms", {"p50": 0.5, "p90": 0.9})
    return t.select("version", F.col("n").alias("sessions"), F.bround("avg_hold_ms").alias("avg_ms"), F.bround("p50").alias("p50_ms"), F.bround("p90").alias("p90_ms")).orderBy("version")


def hold_time_by_day(spans: DataFrame) -> DataFrame:
    return _holds(spans).groupBy(F.to_date("first").cast("string").alias("day")).agg(F.count("*").alias("sessions"), F.bround(F.avg("hold_ms")).alias("avg_hold_ms")).orderBy("day")


def dialog_funnel(end_reasons: DataFrame) -> DataFrame:
    """The window runs over one row for each number of turns, which is few."""
    by = end_reasons.groupBy("turns").agg(F.count("*").alias("sessions"))
    return by.withColumn("reached_at_least", F.sum("sessions").over(Window.orderBy(F.desc("turns")))).orderBy("turns")


def latency_tokens(spans: DataFrame) -> DataFrame:
    t = _tallied(spans.filter("model != ''"), ("model", "version"), "latency_ms", {"p90": 0.9}, "input_tokens", "output_tokens")
    return t.select(
        "model", "version", F.col("n").alias("spans"), F.bround("avg_latency_ms").alias("avg_latency_ms"), F.bround("p90").alias("p90_latency_ms"),
        F.bround("avg_input_tokens").alias("avg_in_tok"), F.bround("avg_output_tokens").alias("avg_out_tok"),
    ).orderBy("model", "version")


def user_contacts(user_sessions: DataFrame, as_of: str, days: int = 3, top: int = 15) -> DataFrame:
    recent = user_sessions.filter(F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    return recent.groupBy("user_id").agg(F.count_distinct("session_id").alias("sessions"), F.count_distinct("trace_id").alias("traces")).orderBy(F.desc("sessions"), "user_id").limit(top)


def data_quality(spans: DataFrame) -> DataFrame:
    share = lambda a, b: F.bround(F.try_divide(100 * a, b), 1)
    chat = F.col("span_name").like("chat%")
    full = chat & (F.col("model") != "") & (F.col("input_tokens") > 0) & (F.col("output_tokens") > 0)
    return spans.agg(
        share(F.count_if(F.col("session_id") != ""), F.count("*")).alias("session_id_coverage_pct"), share(F.count_if(F.col("version") != ""), F.count("*")).alias("version_coverage_pct"),
        share(F.count_if(full), F.count_if(chat)).alias("gen_ai_full_on_chat_pct"), F.count("*").alias("total_spans"),
    )
