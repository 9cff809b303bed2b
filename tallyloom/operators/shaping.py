"""Column-level table operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Cleaner = Callable[[Column], Column]


def col(name: str) -> Column:
    """Column by its exact name, which may hold dots, blanks or signs."""
    return F.col(f"`{name}`")


def require(df: DataFrame, names: Sequence[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"no such column: {missing}; have {df.columns}")


def rename_strict(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; an unknown name is an error, not a silent no-op."""
    require(df, list(mapping))
    return df.withColumnsRenamed(dict(mapping))


def clean_columns(df: DataFrame, cleaners: Mapping[str, Cleaner]) -> DataFrame:
    """Apply one cleaner per column in a single projection."""
    require(df, list(cleaners))
    return df.withColumns({name: clean(col(name)) for name, clean in cleaners.items()})


def fill_sentinels(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls by a per-column sentinel such as -1 or `no_info`."""
    require(df, list(values))
    return df.fillna(dict(values))


def drop_outliers(df: DataFrame, measures: Sequence[str], bound: float = 100) -> DataFrame:
    """Keep rows whose measures are all known and at most `bound`.

    A row with a null (or unparsable) measure is dropped: whether it exceeds the bound is unknown.
    """
    require(df, measures)
    over = [col(name).try_cast("double") > bound for name in measures]
    return df.where(~reduce(lambda a, b: a | b, over))


def drop_null_measures(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    require(df, measures)
    return df.dropna(subset=list(measures))


def exclude(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose column is none of the values; rows with a null column go too."""
    require(df, [column])
    return df.where(~col(column).isin(*values))


def enrich(
    df: DataFrame, dim: DataFrame, on: Sequence[str], cols: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Add dimension columns by an equi-join on shared key names.

    No broadcast hint: Catalyst broadcasts a dimension below the session's threshold and otherwise
    sorts and merges, with skewed partitions split at run time.
    """
    require(dim, [*on, *cols])
    return df.join(dim.select(*[col(name) for name in [*on, *cols]]), list(on), how)


def unmapped_labels(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Labels that got no code: (column, label, rows).

    `pairs` maps the raw column to the coded one.
    """
    require(df, [*pairs, *pairs.values()])
    entries = [
        F.struct(
            F.lit(raw).alias("column"),
            F.when(col(coded).isNull(), col(raw).cast("string")).alias("label"),
        )
        for raw, coded in pairs.items()
    ]
    return (
        df.select(F.explode(F.array(*entries)).alias("entry"))
        .select("entry.*")
        .where("label is not null")
        .groupBy("column", "label")
        .agg(F.count("*").alias("rows"))
    )
