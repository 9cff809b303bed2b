"""Posting activity: events (30 days) and orders (years) as posts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyloom.functions.dates import in_dates, month_key, padded_month
from tallyloom.operators import activity
from tallyloom.operators.series import align_series, period_totals, series_correlation
from tallyloom.operators.sketches import day_sketches, merged_sketches, read_sketches
from tallyloom.session import stage
from workload.registry import query, rounded, table

TYPES = ["signup", "purchase", "view", "click", "error"]
BEFORE = (dt.date(1995, 1, 1), dt.date(1996, 12, 31))
AFTER = (dt.date(1999, 1, 1), dt.date(1999, 12, 31))


def _events(spark, sf):
    return table(spark, sf, "events")


def _orders(spark, sf):
    return table(spark, sf, "orders")


@query("""SELECT event_type, count(*) AS posts, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
    FROM events GROUP BY 1""")
def posts_by_community(spark, sf):
    return rounded(activity.activity_share(_events(spark, sf), "event_type"), ["percentage"])


@query("""SELECT o_orderpriority, count(*) AS posts, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
    FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1""")
def posts_by_community_in_year(spark, sf):
    year = _orders(spark, sf).where(
        in_dates(F.col("o_orderdate"), dt.date(1997, 1, 1), dt.date(1997, 12, 31))
    )
    return rounded(activity.activity_share(year, "o_orderpriority"), ["percentage"])


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS posts FROM orders GROUP BY 1")
def posts_by_month(spark, sf):
    return activity.activity_counts(_orders(spark, sf), "o_orderdate", "month")


@query("""SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    count(nullif(o_orderstatus, 'P')) AS posts FROM orders GROUP BY 1, 2, 3""")
def posts_by_community_and_month(spark, sf):
    """Counts known posts only; status P stands for a missing text."""
    df = _orders(spark, sf).withColumn("post", F.expr("nullif(o_orderstatus, 'P')"))
    return activity.activity_counts(df, "o_orderdate", "year_month", ["o_orderpriority"], "post")


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS posts FROM orders GROUP BY 1")
def posts_by_year(spark, sf):
    return activity.activity_counts(_orders(spark, sf), "o_orderdate", "year")


@query("SELECT event_type, CAST(ts AS DATE) AS date, count(*) AS posts FROM events GROUP BY 1, 2")
def posts_by_community_and_day(spark, sf):
    return activity.activity_counts(_events(spark, sf), "ts", "day", ["event_type"])


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(weekofyear(o_orderdate) AS INTEGER) AS week,
    count(*) AS posts FROM orders GROUP BY 1, 2""")
def posts_by_week(spark, sf):
    return activity.activity_counts(_orders(spark, sf), "o_orderdate", "week")


@query("""SELECT concat(year(o_orderdate), '-', lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')) AS month, count(*) AS posts
    FROM orders GROUP BY 1""")
def posts_by_padded_month(spark, sf):
    counts = activity.activity_counts(_orders(spark, sf), "o_orderdate", "year_month")
    return counts.select(padded_month(F.col("year"), F.col("month")).alias("month"), "posts")


SPANS = "(o_orderdate >= '1995-01-01' AND o_orderdate < '1997-01-01') OR (o_orderdate >= '1999-01-01' AND o_orderdate < '2000-01-01')"
CHANGE = """round(avg(n) FILTER (WHERE m < '1997-01-01'), 6) AS avg_before, round(avg(n) FILTER (WHERE m >= '1999-01-01'), 6) AS avg_after,
    round((avg(n) FILTER (WHERE m >= '1999-01-01') - avg(n) FILTER (WHERE m < '1997-01-01'))
    / avg(n) FILTER (WHERE m < '1997-01-01') * 100, 6) AS percentage_increase"""
CHANGES = ["avg_before", "avg_after", "percentage_increase"]


@query(f"""SELECT {CHANGE} FROM (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders
    WHERE {SPANS} GROUP BY 1)""")
def change_overall(spark, sf):
    df = activity.before_after_change(_orders(spark, sf), "o_orderdate", BEFORE, AFTER)
    return rounded(df, CHANGES)


@query(f"""SELECT o_orderpriority, {CHANGE} FROM (SELECT o_orderpriority, date_trunc('month', o_orderdate) AS m,
    count(*) AS n FROM orders WHERE {SPANS} GROUP BY 1, 2) GROUP BY 1""")
def change_by_community(spark, sf):
    df = activity.before_after_change(
        _orders(spark, sf), "o_orderdate", BEFORE, AFTER, ["o_orderpriority"]
    )
    return rounded(df, CHANGES)


DAY_CHANGE = CHANGE.replace("1997-01-01", "2024-01-16").replace("1999-01-01", "2024-01-16")


@query(f"""SELECT event_type, {DAY_CHANGE} FROM (SELECT event_type, CAST(ts AS DATE) AS m, count(*) AS n
    FROM events WHERE ts >= '2024-01-01' AND ts < '2024-01-31' GROUP BY 1, 2) GROUP BY 1""")
def daily_change_by_community(spark, sf):
    df = activity.before_after_change(
        _events(spark, sf),
        "ts",
        (dt.date(2024, 1, 1), dt.date(2024, 1, 15)),
        (dt.date(2024, 1, 16), dt.date(2024, 1, 30)),
        ["event_type"],
        "day",
    )
    return rounded(df, CHANGES)


@query("""SELECT CAST(m AS INTEGER) AS month, round(avg(n), 6) AS monthly_avg_posts FROM (SELECT year(o_orderdate) AS y,
    month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""")
def seasonal_pattern(spark, sf):
    df = activity.seasonal_pattern(_orders(spark, sf), "o_orderdate")
    return rounded(df, ["monthly_avg_posts"])


def _monthly(spark, sf, by=()):
    return period_totals(_orders(spark, sf), "o_orderdate", None, "month", "num_posts", by)


def _cases(spark, sf, grain="month"):
    return period_totals(table(spark, sf, "lineitem"), "l_shipdate", "l_quantity", grain, "total_cases")


POSTS = "posts AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS num_posts FROM orders GROUP BY 1)"
POSTS_BY = """posts AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS num_posts
    FROM orders GROUP BY 1, 2)"""
CASES = "cases AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, sum(l_quantity) AS total_cases FROM lineitem GROUP BY 1)"


@query(f"WITH {POSTS}, {CASES} SELECT round(corr(num_posts, total_cases), 6) AS correlation FROM posts JOIN cases USING (period)")
def case_correlation(spark, sf):
    df = series_correlation(
        _monthly(spark, sf), _cases(spark, sf), ["period"], "num_posts", "total_cases"
    )
    return rounded(df, ["correlation"])


@query(f"""WITH {POSTS_BY}, {CASES} SELECT o_orderpriority, round(corr(num_posts, total_cases), 6) AS correlation
    FROM posts JOIN cases USING (period) GROUP BY 1""")
def case_correlation_by_community(spark, sf):
    by = ["o_orderpriority"]
    df = series_correlation(
        _monthly(spark, sf, by), _cases(spark, sf), ["period"], "num_posts", "total_cases", by
    )
    return rounded(df, ["correlation"])


@query(f"""WITH {POSTS}, {CASES} SELECT period, coalesce(num_posts, 0) AS num_posts, coalesce(total_cases, 0) AS total_cases
    FROM posts FULL JOIN cases USING (period) WHERE period >= '2001-01-01'""")
def posts_and_cases_by_month(spark, sf):
    # Whole months, filtered by date before they are summed: the filters reach both scans.
    posts = _orders(spark, sf).where("o_orderdate >= '2001-01-01'")
    cases = table(spark, sf, "lineitem").where("l_shipdate >= '2001-01-01'")
    return align_series(
        period_totals(posts, "o_orderdate", None, "month", "num_posts"),
        period_totals(cases, "l_shipdate", "l_quantity", "month", "total_cases"),
        ["period"],
        "outer",
        0,
    )


@query("""SELECT o_orderpriority, period, num_posts, total_cases FROM (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS period,
    count(*) AS num_posts FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1, 2)
    JOIN (SELECT CAST(l_shipdate AS DATE) AS period, sum(l_quantity) AS total_cases FROM lineitem GROUP BY 1) USING (period)""")
def posts_and_cases_by_day(spark, sf):
    span = (dt.date(1998, 1, 1), dt.date(1998, 12, 31))
    posts = _orders(spark, sf).where(in_dates(F.col("o_orderdate"), *span))
    cases = table(spark, sf, "lineitem").where(in_dates(F.col("l_shipdate"), *span))
    return align_series(
        period_totals(posts, "o_orderdate", None, "day", "num_posts", ["o_orderpriority"]),
        period_totals(cases, "l_shipdate", "l_quantity", "day", "total_cases"),
        ["period"],
        "inner",
    )


@query("SELECT event_type, count(DISTINCT user_id) AS unique_authors FROM events GROUP BY 1")
def unique_authors(spark, sf):
    return activity.unique_authors(_events(spark, sf), "event_type", "user_id")


@query("SELECT event_type, true AS within FROM events GROUP BY 1")
def unique_authors_approximate(spark, sf):
    """Whether the sketch is within three times its stated deviation of 0.05 of the exact count."""
    events = _events(spark, sf)
    exact = activity.unique_authors(events, "event_type", "user_id")
    rough = activity.unique_authors(events, "event_type", "user_id", approx=True)
    both = exact.join(rough.withColumnRenamed("unique_authors", "rough"), "event_type")
    error = F.abs(F.col("rough") - F.col("unique_authors"))
    return both.select("event_type", (error <= 0.15 * F.col("unique_authors")).alias("within"))


@query("""SELECT communities, count(*) AS authors FROM (SELECT o_custkey, count(DISTINCT o_orderpriority) AS communities
    FROM orders GROUP BY 1) GROUP BY 1""")
def communities_per_author(spark, sf):
    return activity.breadth_distribution(_orders(spark, sf), "o_custkey", "o_orderpriority")


@query("""SELECT o_custkey, count(*) AS posts FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1
    ORDER BY posts DESC, o_custkey LIMIT 10""")
def author_leaderboard(spark, sf):
    year = _orders(spark, sf).where(
        in_dates(F.col("o_orderdate"), dt.date(1997, 1, 1), dt.date(1997, 12, 31))
    )
    return activity.leaderboard(year, "o_custkey", 10)


@query("SELECT event_type, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, count(*) AS posts FROM events GROUP BY 1, 2")
def weekday_activity(spark, sf):
    return activity.weekday_counts(_events(spark, sf), "ts", "event_type")


WIDE = ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in TYPES)


def _wide(spark, sf):
    return activity.pivot_counts(
        _events(spark, sf), F.col("ts").cast("date"), "event_type", TYPES, "date"
    )


@query(f"SELECT CAST(ts AS DATE) AS date, {WIDE} FROM events GROUP BY 1")
def daily_trend_wide(spark, sf):
    return _wide(spark, sf)


@query(f"""SELECT date, event_type, posts FROM (SELECT CAST(ts AS DATE) AS date, {WIDE} FROM events GROUP BY 1)
    UNPIVOT (posts FOR event_type IN ({', '.join(TYPES)}))""")
def daily_trend_long(spark, sf):
    return activity.unpivot_counts(_wide(spark, sf), ["date"], TYPES, "event_type")


MONTHS = [f"{year}-{month:02d}" for year in range(1992, 2003) for month in range(1, 13)]


@query(f"""SELECT o_orderpriority, {', '.join(f"""count(*) FILTER (WHERE strftime(o_orderdate, '%Y-%m') = '{m}') AS "{m}\"""" for m in MONTHS)}
    FROM orders GROUP BY 1""")
def community_month_matrix(spark, sf):
    df = _orders(spark, sf).withColumn("month", month_key(F.col("o_orderdate")))
    return activity.pivot_counts(
        df, F.col("o_orderpriority"), "month", MONTHS, "o_orderpriority"
    )


@query("SELECT lang, round(avg(length(text)), 6) AS avg_length FROM documents GROUP BY 1")
def mean_post_length(spark, sf):
    return rounded(
        activity.mean_length(table(spark, sf, "documents"), "lang", "text"), ["avg_length"]
    )


@query("""SELECT event_type, count(*) AS n, true AS authors_within, true AS quantiles_within FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' GROUP BY 1""")
def merged_day_sketches(spark, sf):
    """Distinct users and quartiles of a range of days, from stored sketches of the days.

    Held against the exact ones: users within three times the stated deviation of 0.016, quartiles
    within three times the stated rank error of 0.013.
    """
    first, last = dt.date(2024, 1, 3), dt.date(2024, 1, 20)
    events, ranks = _events(spark, sf), (0.25, 0.5, 0.75)
    stored = stage(day_sketches(events, ["event_type"], "ts", "user_id", "value"), "day-sketches")
    rough = read_sketches(merged_sketches(stored, ["event_type"], first, last), ranks)
    days = events.where(in_dates(F.col("ts"), first, last))
    joined = days.join(rough, "event_type")
    value, known = F.col("value"), F.count("value")
    within = F.lit(True)
    for i, rank in enumerate(ranks):
        cut = F.col("quantiles")[i]
        below, at = F.count_if(value < cut), F.count_if(value <= cut)
        within = within & (below <= (rank + 0.04) * known + 1) & (at >= (rank - 0.04) * known - 1)
    exact = F.countDistinct("user_id")
    return joined.groupBy("event_type", "n", "unique_authors").agg(
        (F.abs(F.col("unique_authors") - exact) <= 0.05 * exact + 1).alias("authors_within"), within.alias("quantiles_within")
    ).drop("unique_authors")
