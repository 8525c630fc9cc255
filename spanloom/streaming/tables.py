"""Tables in folders: batches are appended, and compaction keeps the latest row of each key in storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest
from ..schemas import Table
from ..session import drop_path, file_system

#: Bytes of the batches since a compaction whose keys are broadcast to the compacted rows; of larger ones they are shuffled.
FRESH_BYTES = 16 << 20


class Tables:
    """Tables under a path. A table is a folder of batches (``batch_id=n``) and of compactions (``_compact/upto=n``)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, name: str, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")

    def write_all(self, results: dict[str, DataFrame], batch_id: int) -> None:
        for name in sorted(results):
            self.write(name, results[name], batch_id)

    def exists(self, name: str) -> bool:
        store, p = file_system(self.spark, f"{self.path}/{name}")
        return store.exists(p)

    def read(self, name: str) -> DataFrame:
        """All rows of all batches that are still there."""
        return self.spark.read.parquet(f"{self.path}/{name}")

    def reset(self, name: str) -> None:
        """Remove a table; only ever on an explicit call."""
        drop_path(self.spark, f"{self.path}/{name}")

    def _numbers(self, path: str, prefix: str, finished: bool = False) -> list[int]:
        """The numbers of the folders under a path, ``finished``: of those whose job has committed."""
        store, p = file_system(self.spark, path)
        if not store.exists(p):
            return []
        names = [s.getPath().getName() for s in store.listStatus(p) if s.isDirectory()]
        found = [n for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit()]
        if finished:
            found = [n for n in found if store.exists(file_system(self.spark, f"{path}/{n}/_SUCCESS")[1])]
        return sorted(int(n[len(prefix) :]) for n in found)

    def batches(self, name: str) -> list[int]:
        return self._numbers(f"{self.path}/{name}", "batch_id=")

    def compactions(self, name: str) -> list[int]:
        return self._numbers(f"{self.path}/{name}/_compact", "upto=", finished=True)

    def _of(self, name: str, batches: list[int]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{name}/batch_id={n}" for n in batches])

    def compact(self, table: Table) -> int | None:
        """Write the latest row of each key of all batches so far; returns the last of them, or None where nothing is new.

        The pointer is the mark that Spark sets when the job has committed: readers take the last compaction that has one, so they see the old rows or the new ones and
        never a part. Rows of one key lie together, sorted by it, in files of the size that adaptive plans aim at.
        """
        done, all_batches = self.compactions(table.name), self.batches(table.name)
        if not all_batches or (done and done[-1] >= all_batches[-1]):
            return None
        upto = all_batches[-1]
        rows = self.read_latest(table)
        rows.sortWithinPartitions(*table.key).write.mode("overwrite").parquet(f"{self.path}/{table.name}/_compact/upto={upto}")
        return upto

    def read_latest(self, table: Table) -> DataFrame:
        """The latest row of each key. What is compacted is only merged with the rows that came since; its other keys pass through as they are."""
        done = self.compactions(table.name)
        since = [n for n in self.batches(table.name) if not done or n > done[-1]]
        base = self.spark.read.parquet(f"{self.path}/{table.name}/_compact/upto={done[-1]}") if done else None
        if not since:
            return base if base is not None else self.read(table.name)
        fresh = self._of(table.name, since)
        version = tuple(v for v in table.version if v in fresh.columns)
        if base is None:
            return latest(fresh, table.key, version)
        keys = fresh.select(*[F.col(k).alias(f"_k_{k}") for k in table.key]).distinct()
        if sum(self._size(table.name, n) for n in since) <= FRESH_BYTES:
            keys = F.broadcast(keys)
        same = F.lit(True)
        for k in table.key:
            same = same & base[k].eqNullSafe(keys[f"_k_{k}"])
        met = base.join(keys, same, "left_semi")
        return base.join(keys, same, "left_anti").unionByName(latest(met.unionByName(fresh, allowMissingColumns=True), table.key, version), allowMissingColumns=True)

    def _size(self, name: str, batch_id: int) -> int:
        store, p = file_system(self.spark, f"{self.path}/{name}/batch_id={batch_id}")
        return store.getContentSummary(p).getLength()

    def vacuum(self, name: str) -> None:
        """Remove batches that are compacted and older compactions; only ever on an explicit call, when no reader began before the last compaction."""
        done = self.compactions(name)
        for n in self.batches(name):
            if done and n <= done[-1]:
                drop_path(self.spark, f"{self.path}/{name}/batch_id={n}")
        for n in done[:-1]:
            drop_path(self.spark, f"{self.path}/{name}/_compact/upto={n}")
