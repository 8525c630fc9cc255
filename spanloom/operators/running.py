"""Sums over all rows before a row, in one order, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def running(df: DataFrame, by: list[str], order: list[str], sums: dict[str, str | Column]) -> tuple[DataFrame, str]:
    """``df`` with, for each name in ``sums``, the sum of that column over the rows before, among rows of equal ``by`` in ``order``; and the path of a table that the result reads.

    Rows are dealt to ranges of (by, order) and written, so that both passes see the same ranges. Each range adds up its own rows; only what the ranges before hold of the
    one group that runs on into a range is carried over, a row for each range at most. ``order`` should tell rows apart: of equal ones either may come first.
    Other windows over a group would put all its rows, however many, into one task.
    """
    keys = [*by, *order]
    dealt = df.withColumns({f"_add_{n}": F.col(c) if isinstance(c, str) else c for n, c in sums.items()}).repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    parts, path = written(dealt, "ranges")
    total = parts.groupBy("_range", *by).agg(*[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in sums])
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range of a group
    carried = total.select("_range", *by, *[F.sum(f"_sum_{n}").over(earlier).alias(f"_carry_{n}") for n in sums], F.count("*").over(earlier).alias("_ranges"))
    carried = carried.filter("_ranges > 0").drop("_ranges").withColumnsRenamed({c: f"_c_{c}" for c in ["_range", *by]})
    same = parts["_range"] == F.col("_c__range")
    for c in by:
        same = same & parts[c].eqNullSafe(F.col(f"_c_{c}"))
    # At most one group runs on into a range, so there are no more rows than ranges.
    joined = parts.join(F.broadcast(carried), same, "left")
    before = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = joined.withColumns({n: zero(F.col(f"_carry_{n}")) + zero(F.sum(f"_add_{n}").over(before)) for n in sums})
    return out.select(*df.columns, *sums), path
