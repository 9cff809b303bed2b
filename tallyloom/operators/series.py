"""Posts beside an outside series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import period_start
from tallyloom.operators.shaping import col, require


def period_totals(
    df: DataFrame, date: str, value: str | None, grain: str, to: str, by: Sequence[str] = ()
) -> DataFrame:
    """Total of a value (or number of rows) per period: (by, period, to)."""
    require(df, [date, *by])
    total = F.count("*") if value is None else F.sum(col(value))
    return df.groupBy(*[col(name) for name in by], period_start(col(date), grain).alias("period")).agg(
        total.alias(to)
    )


def align_series(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "outer",
    fill: float | None = None,
) -> DataFrame:
    """Join two series on their period; `fill` replaces numbers missing on either side."""
    joined = left.join(right, list(on), how)
    return joined if fill is None else joined.fillna(fill)


def series_correlation(
    left: DataFrame, right: DataFrame, on: Sequence[str], x: str, y: str, by: Sequence[str] = ()
) -> DataFrame:
    """Pearson correlation of two series over their shared periods: (by, correlation)."""
    joined = align_series(left, right, on, "inner")
    return joined.groupBy(*[col(name) for name in by]).agg(
        F.corr(col(x).cast("double"), col(y).cast("double")).alias("correlation")
    )
