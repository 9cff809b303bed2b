"""Posting activity: who posts where, when and how much.

Every operator folds rows by community, author or period on the map side first, so one community
with a third of all posts costs no more than any other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import in_dates, month_key, period_start
from tallyloom.operators.ordering import top_k
from tallyloom.operators.shaping import col, require

Days = tuple[dt.date, dt.date]


def _posts(post: str | None) -> Column:
    """Row count, or count of the known values of a column."""
    return F.count("*") if post is None else F.count(col(post))


def activity_share(df: DataFrame, community: str) -> DataFrame:
    """Posts per community and percent of all: (community, posts, percentage)."""
    counts = df.groupBy(col(community)).agg(F.count("*").alias("posts"))
    total = counts.agg(F.sum("posts").alias("n")).scalar()
    return counts.withColumn("percentage", F.col("posts") * 100.0 / total)


def activity_counts(
    df: DataFrame, date: str, grain: str, by: Sequence[str] = (), post: str | None = None
) -> DataFrame:
    """Posts per period and group: (by, period columns, posts).

    Period columns: `day` gives date; `month` gives month (`yyyy-MM`); `year_month` gives year and
    month numbers; `year` gives year; `week` gives calendar year and ISO week number.
    """
    require(df, [date, *by])
    keys = [col(name) for name in by]
    when = col(date)
    if grain == "week":
        periods = [F.year(when).alias("year"), F.weekofyear(when).alias("week")]
        return df.groupBy(*keys, *periods).agg(_posts(post).alias("posts"))
    unit = "month" if grain == "year_month" else grain
    counted = df.groupBy(*keys, period_start(when, unit).alias("_period")).agg(
        _posts(post).alias("posts")
    )
    shown = {
        "day": [F.col("_period").alias("date")],
        "month": [month_key(F.col("_period")).alias("month")],
        "year": [F.year("_period").alias("year")],
        "year_month": [F.year("_period").alias("year"), F.month("_period").alias("month")],
    }[grain]
    return counted.select(*keys, *shown, "posts")


def before_after_change(
    df: DataFrame,
    date: str,
    before: Days,
    after: Days,
    by: Sequence[str] = (),
    grain: str = "month",
    post: str | None = None,
) -> DataFrame:
    """Mean posts per period before and after, and the change in percent:
    (by, avg_before, avg_after, percentage_increase).

    A period belongs to a span when its first day does. Groups missing on either side are left out.
    """
    require(df, [date, *by])
    keys = [col(name) for name in by]
    period = F.col("_period")
    counts = (
        df.where(in_dates(col(date), *before) | in_dates(col(date), *after))
        .groupBy(*keys, period_start(col(date), grain).alias("_period"))
        .agg(_posts(post).alias("_posts"))
    )
    means = counts.groupBy(*keys).agg(
        F.avg(F.when(in_dates(period, *before), F.col("_posts"))).alias("avg_before"),
        F.avg(F.when(in_dates(period, *after), F.col("_posts"))).alias("avg_after"),
    )
    change = F.try_divide(F.col("avg_after") - F.col("avg_before"), F.col("avg_before")) * 100
    return means.dropna(subset=["avg_before", "avg_after"]).withColumn(
        "percentage_increase", change
    )


def seasonal_pattern(df: DataFrame, date: str, post: str | None = None) -> DataFrame:
    """Mean posts by calendar month over the years: (month, monthly_avg_posts)."""
    monthly = activity_counts(df, date, "year_month", post=post)
    return monthly.groupBy("month").agg(F.avg("posts").alias("monthly_avg_posts"))


def weekday_counts(df: DataFrame, date: str, community: str) -> DataFrame:
    """Posts by community and day of week (1 is Sunday)."""
    return df.groupBy(col(community), F.dayofweek(col(date)).alias("day_of_week")).agg(
        F.count("*").alias("posts")
    )


def unique_authors(
    df: DataFrame, community: str, author: str, approx: bool = False
) -> DataFrame:
    """Distinct authors per community: (community, unique_authors).

    The exact count first reduces to distinct (community, author) pairs, spread over all tasks;
    `approx` keeps a sketch of fixed size per community instead.
    """
    count = F.approx_count_distinct if approx else F.countDistinct
    return df.groupBy(col(community)).agg(count(col(author)).alias("unique_authors"))


def breadth(df: DataFrame, author: str, community: str) -> DataFrame:
    """Number of communities each author posts in: (author, communities)."""
    return df.groupBy(col(author)).agg(F.countDistinct(col(community)).alias("communities"))


def breadth_distribution(df: DataFrame, author: str, community: str) -> DataFrame:
    """How many authors post in 1, 2, .. communities: (communities, authors)."""
    return (
        breadth(df, author, community).groupBy("communities").agg(F.count("*").alias("authors"))
    )


def leaderboard(df: DataFrame, author: str, k: int = 10) -> DataFrame:
    """The k authors with the most posts: (author, posts)."""
    counts = df.groupBy(col(author)).agg(F.count("*").alias("posts"))
    return top_k(counts, "posts", author, k)


def mean_length(df: DataFrame, community: str, text: str) -> DataFrame:
    """Mean characters per post: (community, avg_length)."""
    return df.groupBy(col(community)).agg(F.avg(F.length(col(text))).alias("avg_length"))


def pivot_counts(
    df: DataFrame, row: Column, column: str, values: Sequence[str], row_name: str, fill: int = 0
) -> DataFrame:
    """Post counts with one column per community, missing cells filled.

    Give the communities: an open pivot would run a job only to find them.
    """
    require(df, [column])
    counts = df.groupBy(row.alias(row_name)).pivot(column, list(values)).agg(F.count(F.lit(1)))
    return counts.fillna(fill, subset=list(values))


def unpivot_counts(
    wide: DataFrame, keys: Sequence[str], values: Sequence[str], name: str, count: str = "posts"
) -> DataFrame:
    """Back to one row per key and community."""
    return wide.unpivot(list(keys), list(values), name, count)
