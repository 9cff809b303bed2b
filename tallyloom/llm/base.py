"""What the operators share: row keys, Arrow helpers, staging, registration."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Rows of text handed to Python at a time; texts of a batch are held in memory together.
BATCH_ROWS = 512


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that gives the same rows."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def small_batches(spark: SparkSession) -> None:
    """Bound the texts of a batch, and let workers import this package from where the driver has it.

    The path helps a session started from another folder; on a cluster the package is shipped with
    --py-files or installed, and the path is simply not there.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Number the rows, so that repeated rows stay apart and a row has the same key in every job.

    Rows read from Parquet files are known by file (a hash of its path) and place in the file, however
    the scan is split and whatever executors there are. Rows from elsewhere are numbered by partition
    and place; these must give the same rows in the same partitions when computed again.
    """
    try:
        file = df.metadataColumn("_metadata")
        key = F.struct(F.xxhash64(file["file_path"]).alias("file"), file["row_index"].alias("row"))
        return df.withColumn(name, key)
    except AnalysisException:
        return df.withColumn(name, F.monotonically_increasing_id())


def fresh(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of df has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def extended(schema: StructType, ddl: str) -> StructType:
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def crc_fold(doc_id: Column, folds: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo `folds`; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII text."""
    step = "lambda x, k: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {step})"
    codes = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {byte}), 4294967295)"


def bounded_sample(df: DataFrame, by: str, bound: int, seed: int = 17) -> DataFrame:
    """At most `bound` rows of each value of `by`, chosen by a hash of doc_id, whatever the size.

    A threshold on the hash cuts each value to about twice the bound before anything is ordered, so
    the exact cut sorts few rows. `by` must have few values (they are counted on the driver); rows
    without one are left out. For fitting models only.
    """
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)), F.lit(1 << 30))
    known = df.where(F.col(by).isNotNull())
    counts = known.groupBy(by).count().collect()
    if not counts:
        return df.limit(0)
    limit = F.create_map(
        *(F.lit(x) for r in counts for x in (r[by], int(2 * bound / r["count"] * (1 << 30)) + 1))
    )
    order = Window.partitionBy(by).orderBy("_place", "doc_id")
    return (
        known.withColumn("_place", place)
        .where(F.col("_place") < limit[F.col(by)])
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= bound)
        .drop("_place", "_rank")
    )
