"""The folder that all machines share, and tables written there to cut lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.session import drop_path as drop_path
from spanloom.session import file_system
from spanloom.session import give_back as give_back
from spanloom.session import in_arrow as in_arrow
from spanloom.session import new_path as new_path
from spanloom.session import written as written


def materialize(df: DataFrame, label: str, scratch: Scratch | None = None) -> DataFrame:
    """``df`` from Parquet in the shared folder, whose path ``scratch`` keeps until it is cleared."""
    out, path = written(df, label)
    if scratch is not None:
        scratch.paths.append(path)
    return out


class Scratch:
    """Tables that an operator has written and that its result doesn't read."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def clear(self) -> None:
        while self.paths:
            drop_path(self.spark, self.paths.pop())


#: Rows of a table of ids or the like that may be broadcast, and bytes of its files; larger ones are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 250_000, 16 << 20


def small_or_shuffled(df: DataFrame, label: str, scratch: Scratch | None = None) -> DataFrame:
    """``df`` written to the shared folder, with the hint to broadcast it if it is proven to be small."""
    spark = df.sparkSession
    df, path = written(df, label)
    if scratch is not None:
        scratch.paths.append(path)
    store, p = file_system(spark, path)
    size = store.getContentSummary(p).getLength()
    return F.broadcast(df) if size <= BROADCAST_BYTES and df.count() <= BROADCAST_ROWS else df


def keep_rows(docs: DataFrame, judge: Callable[[list[str]], np.ndarray], text_col: str, rows: int = 1024) -> DataFrame:
    """The rows of ``docs``, whole, whose texts (null as empty) ``judge`` calls true."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, rows):
                part = b.slice(k, rows)
                yield part.filter(pa.array(judge([t or "" for t in part.column(at).to_pylist()]), pa.bool_()))

    return in_arrow(docs, run, docs.schema)
