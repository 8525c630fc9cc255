"""The content-addressed store on disk: laid out by hash for point reads, packed into segments, or bucketed for joins.

``ChunkStore`` keeps chunks in folders by the first ``PREFIX`` letters of their hash, each file sorted by hash, in small row groups with
bloom filters. A look-up of some hashes opens the folders that they fall into and reads the row groups that may hold them; everything else is skipped by
folder names, statistics and bloom filters. Batches append; a batch that is repeated replaces its own files.

``segments`` packs chunks one after another into segments of bounded size and gives an index of (hash, segment, offset, length, checksum).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, file_system
from .running import running

#: Letters of a hash that name a folder; bytes of a row group; hashes that a point read names in its filter, more become a join.
PREFIX, ROW_GROUP, NAMED = 2, 8 << 20, 1_000
#: Compressed bytes from which on a segment is full.
SEGMENT_BYTES = 96 << 20
CHUNK = "hash string, data binary, raw_len int, crc bigint"


class ChunkStore:
    """Chunks (``hash, data, raw_len, crc``) under ``path``."""

    def __init__(self, spark: SparkSession, path: str, row_group: int = ROW_GROUP) -> None:
        self.spark, self.path, self.row_group = spark, path.rstrip("/"), row_group

    def append(self, chunks: DataFrame, batch_id: int) -> None:
        """Write the chunks of a batch; the same batch again replaces its first attempt."""
        rows = chunks.select("hash", "data", "raw_len", "crc", F.substring("hash", 1, PREFIX).alias("prefix"), F.lit(batch_id).cast("long").alias("batch_id"))
        # A range of hashes goes to a task, so that a folder is written by one or two, however the chunks were dealt.
        rows = rows.repartitionByRange("prefix", "hash").sortWithinPartitions("prefix", "hash")
        w = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "prefix")
        w = w.option("parquet.block.size", self.row_group).option("parquet.bloom.filter.enabled#hash", "true")
        drop_path(self.spark, f"{self.path}/batch_id={batch_id}")  # a repeated batch may fill other folders
        w.parquet(self.path)

    def exists(self) -> bool:
        store, p = file_system(self.spark, self.path)
        return store.exists(p)

    def read(self) -> DataFrame:
        """All chunks; one of those that two writers stored at once."""
        return self._files().drop("prefix", "batch_id")

    def _files(self) -> DataFrame:
        return self.spark.read.schema(CHUNK + ", batch_id bigint, prefix string").parquet(self.path)

    def lookup(self, hashes: DataFrame) -> DataFrame:
        """The chunks of ``hash``, each once. A few hashes are named in the filter of the scan; of more, their folders are, and the rest is a join."""
        wanted = hashes.select("hash").filter(F.col("hash").isNotNull()).distinct()
        few = [r["hash"] for r in wanted.limit(NAMED + 1).collect()]
        if len(few) <= NAMED:
            found = self._files().filter(F.col("prefix").isin(sorted({h[:PREFIX] for h in few})) & F.col("hash").isin(sorted(few)))
        else:
            found = self._files().join(wanted.withColumn("prefix", F.substring("hash", 1, PREFIX)), ["prefix", "hash"], "left_semi")
        return found.select("hash", "data", "raw_len", "crc").dropDuplicates(["hash"])


def packed(chunks: DataFrame) -> DataFrame:
    """``hash, frame, raw_len, crc``: each chunk as a zstd frame of its own, which can be read alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        c = zstandard.ZstdCompressor()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.compress(x.as_buffer()) for x in b.column(1)], pa.binary()), b.column(2), b.column(3)], names=["hash", "frame", "raw_len", "crc"])

    return chunks.select("hash", "data", "raw_len", "crc").mapInArrow(run, "hash string, frame binary, raw_len int, crc bigint")


def segments(sized: DataFrame, full: int = SEGMENT_BYTES, order: tuple[str, ...] = ("hash",), size: str = "len") -> tuple[DataFrame, str]:
    """``sized`` with ``segment`` and ``offset``, and the path of a table that the result reads.

    Chunks follow one another in ``order``; a segment starts with the first chunk that begins at or beyond a multiple of ``full`` bytes of all of them, so it
    holds less than ``full`` bytes and one chunk. Its number is that multiple, so numbers of segments that a huge chunk covers are left out. Sums go over all rows without a task that sees them all.
    """
    rows, path = running(sized, [], list(order), {"_at": size})
    segment = F.floor(F.col("_at") / full).cast("long")
    out = rows.withColumn("segment", segment)
    # The first offset of a segment is the least; a row for each segment, so it may be large and isn't broadcast by hint.
    first = out.groupBy("segment").agg(F.min("_at").alias("_first"))
    return out.join(first, "segment").withColumn("offset", F.col("_at") - F.col("_first")).select(*sized.columns, "segment", "offset"), path


def unpacked(frames: DataFrame, strict: bool = True) -> DataFrame:
    """``hash, data`` of frames; a frame whose checksum isn't that of its bytes fails the query, or is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import zstandard

        d = zstandard.ZstdDecompressor()
        for b in batches:
            hashes, data = [], []
            for h, frame, crc in zip(*(c.to_pylist() for c in b.columns)):
                raw = d.decompress(frame)
                if zlib.crc32(raw) == crc:
                    hashes.append(h)
                    data.append(raw)
                elif strict:
                    raise ValueError(f"the checksum of chunk {h} is wrong")
            yield pa.record_batch({"hash": pa.array(hashes, pa.string()), "data": pa.array(data, pa.binary())})

    return frames.select("hash", "frame", "crc").mapInArrow(run, "hash string, data binary")
