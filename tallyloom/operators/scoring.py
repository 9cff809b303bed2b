"""Decile scores and composite indices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.cleaning import is_present
from tallyloom.operators.ordering import decile_values
from tallyloom.operators.shaping import col, require

STEP = 0.11


def decile_score(
    df: DataFrame,
    measures: Sequence[str],
    thresholds: Mapping[str, Sequence[float]] | None = None,
    exact: bool = True,
) -> DataFrame:
    """Add `<measure>_score`: 0.11 for each decile strictly below the value, so 0.00 to 0.99.

    Fill nulls first (`fill_unreported`) so that unreported rows take part in the deciles; a value
    still null scores 0. `thresholds` is the result of `ordering.decile_values`, which is taken
    from the table itself if not given; the scores are then plain comparisons with nine numbers.
    """
    require(df, measures)
    cuts = decile_values(df, measures, exact) if thresholds is None else thresholds

    def score(name: str) -> Column:
        above = [F.when(col(name) > cut, 1).otherwise(0) for cut in cuts[name]]
        return F.round(reduce(lambda a, b: a + b, above, F.lit(0)) * F.lit(STEP), 2)

    return df.withColumns({f"{name}_score": score(name) for name in measures})


def total_score(df: DataFrame, columns: Sequence[str], to: str) -> DataFrame:
    """Add the sum of score columns."""
    require(df, columns)
    return df.withColumn(to, reduce(lambda a, b: a + b, [col(name) for name in columns]))


def count_present(df: DataFrame, flags: Sequence[str], to: str) -> DataFrame:
    """Add the number of flags that are not null."""
    require(df, flags)
    return df.withColumn(to, reduce(lambda a, b: a + b, [is_present(col(name)) for name in flags]))


def composite_index(
    parts: Sequence[DataFrame], on: str, scores: Sequence[str], to: str = "total_score"
) -> DataFrame:
    """Inner-join score tables on one key and add the sum of their scores.

    Tables already partitioned by the key are not shuffled again.
    """
    joined = reduce(lambda a, b: a.join(b, on), parts)
    return total_score(joined, scores, to)


def fill_unreported(df: DataFrame, measures: Sequence[str], value: float = -1.0) -> DataFrame:
    """Sentinel for unreported measures, as the deciles expect."""
    filled: Mapping[str, float] = {name: value for name in measures}
    return df.fillna(dict(filled))
