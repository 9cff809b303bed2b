"""Dimension and fact builders driven by small specs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import in_years
from tallyloom.operators.shaping import (
    Cleaner,
    col,
    drop_null_measures,
    drop_outliers,
    rename_strict,
    require,
)


@dataclass(frozen=True)
class DimSpec:
    """Columns of a dimension in order, a cleaner for some, and a new name for some."""

    name: str
    columns: Sequence[str]
    cleaners: Mapping[str, Cleaner] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)


def build_dim(df: DataFrame, spec: DimSpec) -> DataFrame:
    """Select, clean and rename in one projection."""
    require(df, list(spec.columns))
    unknown = {*spec.cleaners, *spec.renames} - set(spec.columns)
    if unknown:
        raise ValueError(f"{spec.name}: not among the selected columns: {sorted(unknown)}")
    return df.select(
        *[
            spec.cleaners.get(name, lambda c: c)(col(name)).alias(spec.renames.get(name, name))
            for name in spec.columns
        ]
    )


@dataclass(frozen=True)
class IndicatorSpec:
    """An indicator table: which column holds the year and the code, and what each measure is called.

    `measures` maps raw to final names. Rows are dropped when a measure of `bounded` is null or
    above `bound`, and when a measure of `required` is null (both use final names).
    """

    name: str
    measures: Mapping[str, str]
    code: str = "Code"
    year: str | None = "Year"
    years: tuple[int, int] | None = (1990, 2023)
    fixed_year: int | None = None
    bounded: Sequence[str] = ()
    bound: float = 100
    required: Sequence[str] = ()


def build_indicator_fact(
    df: DataFrame, dim: DataFrame, spec: IndicatorSpec, how: str = "inner"
) -> DataFrame:
    """Filter, type and conform an indicator table.

    `dim` is the entity table (country_name, country_code, un_region). The result has its columns,
    `year` and the measures as doubles. Filters run before the join.
    """
    renamed = rename_strict(df, spec.measures)
    if spec.year is None:
        renamed = renamed.withColumn("year", F.lit(spec.fixed_year))
    else:
        renamed = rename_strict(renamed, {spec.year: "year"})
    names = list(spec.measures.values())
    rows = renamed.select(
        col(spec.code).alias("_code"),
        "year",
        *[col(name).try_cast("double").alias(name) for name in names],
    )
    if spec.years is not None:
        rows = rows.where(in_years(F.col("year"), *spec.years))
    if spec.bounded:
        rows = drop_outliers(rows, spec.bounded, spec.bound)
    if spec.required:
        rows = drop_null_measures(rows, spec.required)
    joined = rows.join(dim, F.col("_code") == F.col("country_code"), how)
    return joined.select(
        "country_name",
        "country_code",
        "un_region",
        F.col("year").cast("int").alias("year"),
        *[col(name) for name in names],
    )
