"""Session builder and the shared folder for staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
WAREHOUSE_KEY = "spark.sql.warehouse.dir"

# Settings every job relies on. Shuffle parallelism is left to the cluster: adaptive execution
# merges small partitions and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(name: str = "tallyloom", master: str | None = None, **settings: str) -> SparkSession:
    """Get or create a session; pass extra settings with underscores for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset, one in the warehouse, which
    driver and executors share as well. Never a temporary folder of one machine."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.conf.get(WAREHOUSE_KEY) + "/_staged"
    return folder.rstrip("/")


_staged: list[str] = []
_tables: list[str] = []
_clearings = [0]

#: Shuffle files of a write are deleted when it has ended: a staged table is read from its own files.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def unique_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted by `clear_staged`."""
    path = f"{shared_folder(spark)}/staged/{label}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage: each later pass scans columnar files, and a lost executor costs a re-read rather
    than a recomputation of everything upstream. The folder stays until `clear_staged`.
    """
    return stage_at(df, label)[0]


def stage_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As `stage`, with the table's path, by which `unstage` deletes it."""
    path = unique_path(df.sparkSession, label)
    with _shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_KEY) if before is None else spark.conf.set(CLEANUP_KEY, before)


def unstage(spark: SparkSession, path: str) -> None:
    """Delete one staged table, which nothing reads any more."""
    if path in _staged:
        _staged.remove(path)
        _delete(spark, path)


def clearings() -> int:
    """How often staged tables have been cleared: what was staged at another count is gone."""
    return _clearings[0]


def stage_buckets(df: DataFrame, label: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """As `stage`, dealt to buckets by a key: joins and groupings by it do not shuffle the table again.
    Say `dealt` when rows of a key lie in one task already."""
    path, spark = unique_path(df.sparkSession, label), df.sparkSession
    name = f"staged_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(buckets, key)
    with _shuffles_deleted(spark):
        rows.write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    _tables.append(name)
    return spark.table(name)


def clear_staged(spark: SparkSession) -> None:
    """Delete all that this process has staged. Call it when no result that reads it is needed."""
    _clearings[0] += 1
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    while _staged:
        _delete(spark, _staged.pop())


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
