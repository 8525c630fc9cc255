"""Session defaults and input helpers shared by all queries."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app: str = "spanloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the engine expects: UTC, ANSI, adaptive plans."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


ROOT = str(Path(__file__).resolve().parent.parent)


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it (on a cluster it is installed or shipped with the job)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. Timestamps without zone are read as UTC instants (the session runs in UTC)."""
    let_workers_import(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local master may go without: it gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + tempfile.mkdtemp(prefix="spanloom-")
    return _local[app]


_local: dict[str, str] = {}


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Spark's setting that deletes the shuffle files of an action when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` from Parquet in the shared folder, and the path there: a lost executor costs no recomputation above it.

    Its shuffle files go with the write. They would else stay until the driver collects its garbage, those of all earlier steps at once.
    """
    spark, schema = df.sparkSession, df.schema
    path = new_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before is not None else spark.conf.unset(SHUFFLE_CLEANUP)
    return spark.read.schema(schema).parquet(path), path


@contextmanager
def kept(spark: SparkSession, key: str) -> Iterator[None]:
    """A setting of the session is afterwards what it was before."""
    before = spark.conf.get(key)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def file_system(spark: SparkSession, path: str):
    """(Hadoop's store of a path, the path in it)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def files_of(spark: SparkSession, path: str, suffix: str = ".parquet") -> int:
    """How many files of a table lie under a path."""
    store, p = file_system(spark, path)
    found, n = store.listFiles(p, True), 0
    while found.hasNext():
        n += found.next().getPath().getName().endswith(suffix)
    return n


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder once nothing reads it any more."""
    store, p = file_system(spark, path)
    store.delete(p, True)


#: Rows, and bytes about, that Spark hands to a Python worker at once: the usual ten thousand rows or 64 MB of long texts, which
#: the JVM, Arrow and the worker each hold a copy of, are too much for a small executor.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20


def give_back() -> None:
    """Return freed memory to the system, so that a worker that goes on to the next task starts small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which has no such call
        pass


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with modest batches, by workers that give memory back at the end of a partition."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(lean, schema)
