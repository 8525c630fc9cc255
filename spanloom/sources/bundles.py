"""Bundles: files of concatenated zstd frames, each frame the JSON lines of one trace in one hour.

Two data sources: ``FORMAT`` writes frames through Spark's own commit, and reads them by offset and length.

Writing: each task puts its frames into files of a staging folder, a new file for each hour and whenever one is full, and next to each a small
Parquet file that says where its frames lie. Only when the job commits do the files of the attempts that won move to their
place, indexes last, so that a reader never sees a frame that isn't there; an attempt that fails, or a job that does, leaves nothing. Nothing but file names comes to the driver.

Reading: a partition of the scan is some index files; a task reads these, and of the bundles only the ranges of bytes of the frames that it wants. Filters on trace, date,
hour and session reach the index files by ``pushFilters``; bundles of other hours are left out by their folders before a task starts.

Foreign bundles that have no index are read whole by ``read_lines``. A path without a scheme is one of the local machine, as elsewhere in Python; give a scheme on a cluster.
"""

from __future__ import annotations

import io
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

FORMAT = "spanloom_bundles"
#: Compressed bytes from which on a bundle is full; index files in a partition of a scan.
BUNDLE_BYTES, INDEXES = 32 << 20, 16
FRAME = "date string, hour int, trace_id string, session_id string, frame binary"
LINES = "value string, seq bigint, trace_id string, session_id string, date string, hour int, path string, offset bigint"
INDEX = pa.schema([("trace_id", pa.string()), ("session_id", pa.string()), ("date", pa.string()), ("hour", pa.int32()), ("path", pa.string()), ("offset", pa.int64()), ("len", pa.int64())])


def _store(path: str):
    """(file system of a path, the path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """What a task has put into staging, bundles relative to the root."""

    bundles: list[str] = field(default_factory=list)


class BundleWriter(DataSourceArrowWriter):
    def __init__(self, path: str, most: int, overwrite: bool, batch: str = "") -> None:
        self.path, self.most, self.overwrite, self.batch = path.rstrip("/"), most, overwrite, batch and f"{batch}-"
        self.staging = f"_staging/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        store, base = _store(self.path)
        done, out, now, rows, size = Written(), None, None, [], 0
        name = ""

        def close() -> None:
            nonlocal out
            if out is None:
                return
            out.close()
            out = None
            target = f"{base}/{self.staging}/index/{name}.parquet"
            store.create_dir(posixpath.dirname(target), recursive=True)
            with store.open_output_stream(target) as f:
                pq.write_table(pa.Table.from_pylist(rows, INDEX), f)
            done.bundles.append(name)

        # A name of its own for each file keeps attempts of a task apart.
        for b in iterator:
            for date, hour, trace, session, frame in zip(*(b.column(c).to_pylist() for c in ("date", "hour", "trace_id", "session_id", "frame"))):
                if out is None or (date, hour) != now or size >= self.most:
                    close()
                    now, rows, size = (date, hour), [], 0
                    name = f"date={date}/hour={hour}/{self.batch}{uuid.uuid4().hex}.jsonl.zst"
                    store.create_dir(posixpath.dirname(f"{base}/{self.staging}/{name}"), recursive=True)
                    out = store.open_output_stream(f"{base}/{self.staging}/{name}", compression=None)
                rows.append({"trace_id": trace, "session_id": session, "date": date, "hour": hour, "path": name, "offset": size, "len": len(frame)})
                out.write(frame)
                size += len(frame)
        close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        store, base = _store(self.path)
        made = [name for m in messages if m is not None for name in m.bundles]
        old = _indexes(self.path) if self.overwrite or self.batch else []
        if not self.overwrite:
            old = [n for n in old if posixpath.basename(n).startswith(self.batch)]  # a batch that is repeated replaces its files
        for name, index in [(n, False) for n in made] + [(n, True) for n in made]:
            rel = f"index/{name}.parquet" if index else name
            store.create_dir(posixpath.dirname(f"{base}/{rel}"), recursive=True)
            store.move(f"{base}/{self.staging}/{rel}", f"{base}/{rel}")
        for rel in old:
            store.delete_file(f"{base}/{rel}")
            store.delete_file(f"{base}/{rel.removeprefix('index/').removesuffix('.parquet')}")
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow import fs

        store, base = _store(self.path)
        if store.get_file_info(f"{base}/{self.staging}").type == fs.FileType.Directory:
            store.delete_dir(f"{base}/{self.staging}")


def _indexes(path: str) -> list[str]:
    """Index files under a root, relative to it."""
    from pyarrow import fs

    store, base = _store(path.rstrip("/"))
    found = store.get_file_info(fs.FileSelector(f"{base}/index", recursive=True, allow_not_found=True))
    return sorted(posixpath.relpath(f.path, base) for f in found if f.type == fs.FileType.File and f.path.endswith(".parquet"))


@dataclass
class Bundles(InputPartition):
    indexes: list[str]


class BundleReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path, self.wanted = path.rstrip("/"), {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what an index file answers exactly: one of some values of a column."""
        for f in filters:
            values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else None
            if values is not None and len(f.attribute) == 1 and f.attribute[0] in ("trace_id", "session_id", "date", "hour"):
                known = self.wanted.get(f.attribute[0])
                self.wanted[f.attribute[0]] = set(values) if known is None else known & set(values)
            else:
                yield f

    def partitions(self) -> list[Bundles]:
        def here(rel: str) -> bool:
            parts = dict(p.split("=", 1) for p in rel.split("/") if "=" in p)
            return all(c not in self.wanted or parts.get(c) in {str(v) for v in self.wanted[c]} for c in ("date", "hour"))

        names = [n for n in _indexes(self.path) if here(n)]
        return [Bundles(names[i : i + INDEXES]) for i in range(0, len(names), INDEXES)] or [Bundles([])]

    def read(self, partition: Bundles) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        store, base = _store(self.path)
        filters = [(c, "in", v) for c, v in self.wanted.items()]
        if any(not v for v in self.wanted.values()):
            return
        for rel in partition.indexes:
            index = pq.read_table(f"{base}/{rel}", filesystem=store, filters=filters or None, partitioning=None)
            if index.num_rows:
                yield from frames_of(store, base, index.sort_by("offset").to_pylist())


def frames_of(store, base: str, rows: list[dict]) -> Iterator[pa.RecordBatch]:
    """The lines of some frames of one bundle, of which no other byte is read."""
    import zstandard

    d = zstandard.ZstdDecompressor()
    with store.open_input_file(f"{base}/{rows[0]['path']}") as f:
        for r in rows:
            f.seek(r["offset"])
            raw = f.read(r["len"])
            if len(raw) != r["len"]:
                raise OSError(f"{r['path']} ends before the frame at {r['offset']} does")
            lines = [x for x in d.decompressobj().decompress(raw).decode().split("\n") if x]
            n = len(lines)
            same = lambda v, t: pa.array([v] * n, t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines, pa.string()), pa.array(range(n), pa.int64()), same(r["trace_id"], pa.string()), same(r["session_id"], pa.string()), same(r["date"], pa.string()), same(r["hour"], pa.int32()), same(r["path"], pa.string()), same(r["offset"], pa.int64())],
                names=["value", "seq", "trace_id", "session_id", "date", "hour", "path", "offset"],
            )


class BundleSource(DataSource):
    """Options: ``path``; for writing ``bundleBytes``, and ``batch``, a name whose earlier files are replaced."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> BundleReader:
        return BundleReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> BundleWriter:
        return BundleWriter(self.options["path"], int(self.options.get("bundlebytes", BUNDLE_BYTES)), overwrite, self.options.get("batch", ""))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BundleSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def pack(lines: DataFrame) -> DataFrame:
    """lines: ``trace_id, session_id, value, seq, date, hour``. ``date, hour, trace_id, session_id, frame``: one frame for each trace and hour; its session is the first that isn't empty."""

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        c = zstandard.ZstdCompressor()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([c.compress(x.encode()) for x in b.column(b.num_columns - 1).to_pylist()], pa.binary())], names=[*b.schema.names[:-1], "frame"])

    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "value"))), lambda r: F.concat(r["value"], F.lit("\n"))), "")
    session = F.coalesce(F.min_by("session_id", F.when(F.col("session_id") != "", F.col("seq"))), F.lit(""))
    per = lines.groupBy("date", "hour", "trace_id").agg(text.alias("text"), session.alias("session_id")).withColumn("date", F.col("date").cast("string"))
    return per.select("date", "hour", "trace_id", "session_id", "text").mapInArrow(frame, FRAME)


def write(frames: DataFrame, path: str, bundle_bytes: int = BUNDLE_BYTES, batch: str = "") -> None:
    """The frames of ``pack`` as bundles and their index. Hours are dealt by their measured size: a busy one is written by several tasks. ``batch``: writing it again replaces it."""
    register(frames.sparkSession)
    dealt = frames.hint("rebalance", "date", "hour").sortWithinPartitions("date", "hour", "trace_id")
    dealt.write.format(FORMAT).option("bundleBytes", bundle_bytes).option("batch", batch).mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``LINES`` of all frames; filters on trace, session, date and hour decide what is read."""
    register(spark)
    return spark.read.format(FORMAT).load(path)


def index(spark: SparkSession, path: str) -> DataFrame:
    """``trace_id, session_id, date, hour, path, offset, len`` of all frames."""
    kinds = "trace_id string, session_id string, date string, hour int, path string, offset bigint, len bigint"
    return spark.read.schema(kinds).option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}/index")


def read_frames(places: DataFrame, path: str) -> DataFrame:
    """``LINES`` of the frames that ``places``, rows of ``index``, name: for selections that are themselves queries. A task reads the ranges of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(path.rstrip("/"))
        for b in batches:
            for row in b.to_pylist():
                yield from frames_of(store, base, [row])

    return places.select(*INDEX.names).mapInArrow(run, LINES)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, seq, path``: all lines of all bundles under a path, whatever store it is in, with or without an index. A file is read as a stream of frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                lines = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True), encoding="utf-8", newline="\n")
                rows: list[str] = []
                n = 0
                for line in lines:
                    if line := line.rstrip("\n"):
                        rows.append(line)
                    if len(rows) == 10_000:
                        yield _batch(name, rows, n)
                        n, rows = n + len(rows), []
                if rows:
                    yield _batch(name, rows, n)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zst").load(path)
    return files.select("path", "content").mapInArrow(run, "value string, seq bigint, path string")


def _batch(name: str, rows: list[str], first: int) -> pa.RecordBatch:
    return pa.record_batch({"value": pa.array(rows, pa.string()), "seq": pa.array(range(first, first + len(rows)), pa.int64()), "path": pa.array([name] * len(rows), pa.string())})
