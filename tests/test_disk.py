"""Files of shuffles on the executors' disks."""

from pathlib import Path

from spanloom.session import SHUFFLE_CLEANUP, written


def shuffle_files(spark):
    # Block folders of this application, wherever its local folder is.
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {p for d in manager.localDirsString() for p in Path(d).rglob("shuffle_*.data")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, conf = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    df, _ = written(spark.range(1000).repartition(7, "id").groupBy("id").count(), "t")
    assert not shuffle_files(spark) - before
    assert df.count() == 1000 and spark.conf.get(SHUFFLE_CLEANUP, None) == conf
