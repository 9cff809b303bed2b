"""Stored sketches of days: distinct counts and quantiles of any range of days without its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.shaping import col, require

#: 2^12 registers: a relative standard deviation of about 0.016.
DISTINCT_LOG = 12
#: Size of a quantile sketch: a rank error of about 0.013 (single rank, 99 % sure).
QUANTILE_SIZE = 200


def day_sketches(df: DataFrame, by: Sequence[str], date: str, distinct: str, measure: str) -> DataFrame:
    """One row per key and day: by, day, n (rows), known (rows with a measure), authors, measures.

    `authors` sketches the distinct values of `distinct`, `measures` the values of `measure`; both
    are bytes of bounded size, whatever the day holds, and combine on the map side. Nulls are left
    out of the sketches; rows without a date are under a null day. A new day's rows are sketched
    alone and appended to the stored table.
    """
    require(df, [*by, date, distinct, measure])
    value = col(measure).cast("double")
    return df.groupBy(*(col(x) for x in by), F.to_date(col(date)).alias("day")).agg(
        F.count("*").alias("n"),
        F.count(value).alias("known"),
        F.hll_sketch_agg(col(distinct), DISTINCT_LOG).alias("authors"),
        F.kll_sketch_agg_double(value, QUANTILE_SIZE).alias("measures"),
    )


def merged_sketches(sketches: DataFrame, by: Sequence[Column | str], start=None, end=None) -> DataFrame:
    """Sketches of the days from `start` to `end` (both included, either open) put together by key.

    The filter on days reaches the scan of a stored table; only sketches are moved. The result has
    the columns of `day_sketches` but for the day, so it can be stored and merged again.
    """
    if start is not None:
        sketches = sketches.where(F.col("day") >= F.lit(start).cast("date"))
    if end is not None:
        sketches = sketches.where(F.col("day") <= F.lit(end).cast("date"))
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("known").alias("known"),
        F.hll_union_agg("authors").alias("authors"),
        F.kll_merge_agg_double("measures").alias("measures"),
    )


def read_sketches(sketches: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Distinct counts and quantiles of sketches: `unique_authors` and `quantiles` (null if no measure
    is known) in place of the sketches."""
    wanted = F.array(*(F.lit(float(r)) for r in ranks))
    quantiles = F.kll_sketch_get_quantile_double(F.when(F.col("known") > 0, F.col("measures")), wanted)
    return sketches.withColumns(
        {"unique_authors": F.hll_sketch_estimate("authors"), "quantiles": quantiles}
    ).drop("authors", "measures")
