"""Table profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    NumericType,
    StructField,
    StructType,
    VariantType,
)

from tallyloom.operators.shaping import col


#: Longer values are counted by their digest.
DIGEST_ABOVE = 64


def _ordered(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _ordered(kind.elementType)
    if isinstance(kind, StructType):
        return all(_ordered(field.dataType) for field in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def _cell(field: StructField) -> Column:
    value = col(field.name)
    text = F.map_entries(value).cast("string") if isinstance(field.dataType, MapType) else value.cast("string")
    return F.when(F.length(text) > DIGEST_ABOVE, F.sha2(text, 256)).otherwise(text)


def profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row per column: (column, type, rows, nulls, distinct_values, min, max, mean, stddev).

    Everything but the exact distinct count is one aggregation. Distinct values are counted from
    (column, value) pairs folded on the map side, where a value of over DIGEST_ABOVE characters is
    its digest, so texts are not shuffled; `approx` uses a sketch in the first pass instead. Mean
    and deviation are null for columns that are not numeric, least and largest value for columns
    that have no order (maps).
    """
    null_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    entries = []
    for field in df.schema.fields:
        c = col(field.name)
        numeric = isinstance(field.dataType, NumericType)
        entries.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.count("*").alias("rows"),
                (F.count("*") - F.count(c)).alias("nulls"),
                (F.min(c).cast("string") if _ordered(field.dataType) else no_text).alias("min"),
                (F.max(c).cast("string") if _ordered(field.dataType) else no_text).alias("max"),
                (F.avg(c) if numeric else null_number).alias("mean"),
                (F.stddev_samp(c) if numeric else null_number).alias("stddev"),
                *([F.approx_count_distinct(c).alias("distinct_values")] if approx else []),
            )
        )
    summary = df.agg(F.array(*entries).alias("p")).select(F.explode("p").alias("e")).select("e.*")
    if not approx:
        cells = F.array(
            *[
                F.struct(F.lit(field.name).alias("column"), _cell(field).alias("value"))
                for field in df.schema.fields
            ]
        )
        distinct = (
            df.select(F.explode(cells).alias("e"))
            .select("e.*")
            .distinct()
            .groupBy("column")
            .agg(F.count("value").alias("distinct_values"))
        )
        summary = summary.join(distinct, "column", "left").fillna(0, subset=["distinct_values"])
    return summary.select(
        "column", "type", "rows", "nulls", "distinct_values", "min", "max", "mean", "stddev"
    )
