"""Readers and writers.

CSV is the exchange format at the edges; everything between stages is Parquet with named columns,
so projection and predicate pushdown work and a column can never be read under another's name.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.ml.util import JavaMLReadable, MLWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string


def read_strings(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Header CSV (a file, a folder or a pattern) with every column as text.

    The first file's header names the columns. A file whose header differs raises an error when it
    is read: without that check its cells would land under other names.
    """
    reader = spark.read.option("header", True).option("multiLine", multiline)
    reader = reader.option("quote", '"').option("escape", '"')
    return reader.schema(reader.csv(path).schema).option("enforceSchema", False).csv(path)


def header_groups(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a folder or pattern by their header. One line of each file is read."""
    files = spark.read.format("binaryFile").load(path).select("path").distinct().collect()
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    groups: dict[tuple[str, ...], list[str]] = {}
    for name in sorted(row["path"] for row in files):
        groups.setdefault(tuple(reader.csv(_literal(name)).columns), []).append(name)
    return groups


def _literal(path: str) -> str:
    """A path that is read as it is, though readers take patterns."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def read_by_header(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Header CSV files of which each has its own columns in its own order, all as text.

    Files are read together by header, each group under its own names, and the groups are put
    together by name: a column that a file lacks is null in its rows. Names that differ in case are
    one column. Files without any line have no rows.
    """
    parts = []
    for names, files in header_groups(spark, path).items():
        if not names:
            continue
        reader = spark.read.option("header", True).option("multiLine", multiline).option("enforceSchema", False)
        schema = StructType([StructField(name, StringType()) for name in names])
        parts.append(reader.option("quote", '"').option("escape", '"').schema(schema).csv([_literal(f) for f in files]))
    if not parts:
        raise ValueError(f"no file with a header at {path}")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    header: bool = True,
    multiline: bool = False,
    escape: str = '"',
) -> DataFrame:
    """CSV file, folder or glob under a declared schema.

    The schema is positional and wins over the header; a cell that does not parse becomes null.
    A multiline file is one task, so keep a large corpus as many files and land it as Parquet once
    (`write_table`); every later job then reads the splittable copy.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", escape)
        .option("mode", "PERMISSIVE")
        .csv(paths)
    )


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def rows_table(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """Small constants as a DataFrame.

    Handed over as an Arrow table they become a local relation: its size is known to the planner,
    and no Python worker is started to read it.
    """
    fields = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) or [()] * len(fields)
    arrow = to_arrow_schema(fields)
    arrays = [pa.array(column, field.type) for column, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), fields)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Overwrite a table folder. `fmt="csv"` writes text with a header."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)


def write_report(df: DataFrame, path: str, order_by: Sequence[Column | str] = ()) -> None:
    """Overwrite a CSV report folder.

    With `order_by` the rows are sorted across the part files, read in the order of their names.
    Without it the rebalance hint lets adaptive execution pick the file count from the real output
    size. Either way a report is one file, and a large table many.
    """
    write_table(df.orderBy(*order_by) if order_by else df.hint("rebalance"), path, fmt="csv")


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(kind: type[JavaMLReadable], path: str):
    """`kind` is the model class, for example `BisectingKMeansModel`."""
    return kind.load(path)
