"""Latest row of each key: idempotence on read over tables that are only appended to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import Table


def latest(df: DataFrame, key: tuple[str, ...], version: tuple[str, ...]) -> DataFrame:
    """One shuffle on the key. Filters that aren't on the key must come after, or an older row would resurface."""
    w = Window.partitionBy(*key).orderBy(*[F.col(v).desc() for v in version])
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def latest_of(df: DataFrame, table: Table) -> DataFrame:
    return latest(df, table.key, tuple(v for v in table.version if v in df.columns))
