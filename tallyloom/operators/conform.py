"""Conforming entity names through a dictionary, and converting money."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.shaping import col, require


def conform(
    df: DataFrame,
    name: str,
    dictionary: DataFrame,
    entry: str,
    add: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Look up the raw name in a dictionary and add the columns it gives.

    The raw name stays. `entry` is the dictionary's name column and must not repeat, as facts would
    be multiplied. `how` is `left` to keep rows without an entry, `inner` to drop them, `right` to
    keep every dictionary entry: entries without a row are added to the inner join, whose dictionary
    side Spark can broadcast, as it cannot in a right join; only distinct names are looked up for it.
    """
    require(df, [name])
    require(dictionary, [entry, *add])
    repeated = dictionary.groupBy(col(entry)).agg(F.count("*").alias("n")).where("n > 1").head(3)
    if repeated:
        raise ValueError(f"dictionary names that repeat: {[row[0] for row in repeated]}")
    right = dictionary.select(col(entry).alias("_entry"), *[col(c) for c in add])
    if how != "right":
        return df.join(right, col(name) == F.col("_entry"), how).drop("_entry")
    found = df.join(right, col(name) == F.col("_entry")).drop("_entry")
    names = df.select(col(name).alias("_name")).distinct()
    missing = right.join(names, F.col("_entry") == F.col("_name"), "left_anti").drop("_entry")
    return found.unionByName(missing, allowMissingColumns=True)


def name_list(df: DataFrame, name: str) -> DataFrame:
    """Distinct raw names with their rows: the draft of a new dictionary."""
    return df.groupBy(col(name)).agg(F.count("*").alias("rows"))


def unmatched(df: DataFrame, name: str, dictionary: DataFrame, entry: str) -> DataFrame:
    """Raw names the dictionary lacks, with their rows. Names are counted before the join."""
    return name_list(df, name).join(
        dictionary.select(col(entry).alias("_entry")), col(name) == F.col("_entry"), "left_anti"
    )


def overlap(df: DataFrame, name: str, dictionary: DataFrame, entry: str, code: str) -> DataFrame:
    """One row: names, names with an entry, rows, rows with an entry, distinct codes reached."""
    known = dictionary.select(col(entry).alias("_entry"), col(code).alias("_code"))
    joined = name_list(df, name).join(known, col(name) == F.col("_entry"), "left")
    hit = F.col("_entry").isNotNull()
    return joined.agg(
        F.countDistinct(col(name)).alias("names"),
        F.countDistinct(F.when(hit, col(name))).alias("matched_names"),
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(hit, F.col("rows"))), F.lit(0)).alias("matched_rows"),
        F.countDistinct("_code").alias("codes"),
    )


def convert_currency(
    df: DataFrame,
    amount: str,
    currency: str,
    rates: DataFrame,
    target: str,
    to: str,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add `to`: amount / rate of its currency * rate of the target currency.

    `rates` has `currency` and `rate` (units per base unit). An unknown currency gives null. The
    target rate is a scalar subquery on the rate table, so it does not depend on the data rows.
    """
    names = {"currency": "currency", "rate": "rate", **(columns or {})}
    table = rates.select(
        col(names["currency"]).alias("_currency"),
        col(names["rate"]).try_cast("double").alias("_rate"),
    )
    goal = table.where(F.col("_currency") == target).agg(F.max("_rate").alias("rate")).scalar()
    joined = df.join(table, col(currency) == F.col("_currency"), "left")
    value = F.try_divide(col(amount), F.col("_rate")) * goal
    return joined.withColumn(to, value).drop("_currency", "_rate")
