"""Reports on the forum posts: activity, engagement and words."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.dates import in_dates, in_season, month_key, parse_date
from tallyloom.functions.lexicons import (
    CLOUD_STOP_WORDS,
    COMMUNITY_KEYWORDS,
    CRISIS_INDICATORS,
    EXTRA_STOP_WORDS,
    KEYWORD_COMMUNITIES,
    PANDEMIC_WORDS,
    STIGMA_WORDS,
)
from tallyloom.operators import activity, words
from tallyloom.operators.profile import profile
from tallyloom.operators.series import align_series, period_totals, series_correlation
from tallyloom.operators.shaping import exclude
from tallyloom.sources import schemas
from tallyloom.sources.catalog import Catalog
from tallyloom.sources.tables import read_by_header, read_strings, rows_table

COMMUNITY, AUTHOR, DATE, POST = "subreddit", "author", "date", "post"
#: Key given to posts when they are landed.
KEY = "post_id"

# The studied season and years, and the community that does not cover them.
SEASON = (1, 4, [2018, 2019, 2020])
BEFORE = (dt.date(2018, 1, 1), dt.date(2019, 4, 30))
AFTER = (dt.date(2020, 1, 1), dt.date(2020, 4, 30))
ENGAGEMENT = (dt.date(2019, 1, 1), dt.date(2019, 12, 31))
UNEVEN = ["EDAnonymous"]


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """The corpus with typed dates. Files may have their columns in any order, and further ones, which
    are ignored; a column that a file lacks is null, one that all lack is an error."""
    raw = read_by_header(spark, path, multiline=True)
    posts = raw.select(*[F.col(f.name).cast(f.dataType) for f in schemas.POSTS])
    return posts.withColumn(DATE, parse_date(F.col(DATE)))


def with_key(posts: DataFrame) -> DataFrame:
    """Posts carry no key, and equal ones are posts of their own: they are numbered as they are landed.
    Only the written table keeps the numbers; read from the source again, rows may be numbered otherwise."""
    return posts.withColumn(KEY, F.monotonically_increasing_id())


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    raw = read_strings(spark, path, multiline=True)
    return raw.select(
        parse_date(F.col("date"), "yyyy-MM-dd").alias("date"),
        F.col("cases").try_cast("double").alias("cases"),
    )


def run(spark: SparkSession, catalog: Catalog, posts_path: str, cases_path: str | None = None) -> None:
    """Land the posts as Parquet once, then write every report from that copy."""
    catalog.save(with_key(read_posts(spark, posts_path)), "posts")
    everything = catalog.table(spark, "posts")
    posts = exclude(everything, COMMUNITY, UNEVEN)
    season = posts.where(in_season(F.col(DATE), *SEASON))
    year = posts.where(in_dates(F.col(DATE), *ENGAGEMENT))

    reports = {
        "profile": profile(everything.drop(KEY)),
        "posts_by_community": activity.activity_share(posts, COMMUNITY),
        "posts_by_month": activity.activity_counts(posts, DATE, "month", post=POST),
        "season_by_month": activity.activity_counts(season, DATE, "year_month", post=POST),
        "change": activity.before_after_change(season, DATE, BEFORE, AFTER, post=POST),
        "change_by_community": activity.before_after_change(
            season, DATE, BEFORE, AFTER, [COMMUNITY], post=POST
        ),
        "seasonal_pattern": activity.seasonal_pattern(season, DATE, POST),
        "authors_by_community": activity.unique_authors(everything, COMMUNITY, AUTHOR),
        "communities_per_author": activity.breadth_distribution(posts, AUTHOR, COMMUNITY),
        "engagement_authors": activity.leaderboard(year, AUTHOR),
        "engagement_months": activity.activity_counts(year, DATE, "month"),
        "engagement_community_months": activity.activity_counts(year, DATE, "month", [COMMUNITY]),
        "engagement_communities": activity.activity_share(year, COMMUNITY),
        "weekdays": activity.weekday_counts(posts, DATE, COMMUNITY),
        "community_months": activity.activity_counts(everything, DATE, "year_month", [COMMUNITY]),
        "years": activity.activity_counts(everything, DATE, "year", post=POST),
        "days": activity.activity_counts(everything, DATE, "day"),
        "weeks": activity.activity_counts(everything, DATE, "week"),
        "community_days": activity.activity_counts(everything, DATE, "day", [COMMUNITY]),
        "community_month_matrix": month_matrix(posts),
        "daily_trend": daily_trend(posts),
        "health_cloud": words.word_counts(
            _in(posts, "healthanxiety"), POST, EXTRA_STOP_WORDS + CLOUD_STOP_WORDS
        ),
        "community_keywords": words.community_lexicon_matches(
            posts.where(F.col(COMMUNITY).isin(*KEYWORD_COMMUNITIES)), COMMUNITY, POST, keywords(spark)
        ),
        "post_length": activity.mean_length(posts, COMMUNITY, POST),
        "crisis_words": words.lexicon_counts(
            _in(posts, "suicidewatch"), POST, CRISIS_INDICATORS
        ),
        "crisis_phrases": words.lexicon_counts(
            _in(posts, "suicidewatch"), POST, CRISIS_INDICATORS, mode="phrase"
        ),
        "stigma_words": words.lexicon_counts(_in(posts, "depression"), POST, STIGMA_WORDS),
        "pandemic_hits": words.lexicon_hits(
            _in(posts, "healthanxiety"), POST, PANDEMIC_WORDS, [COMMUNITY, DATE, POST]
        ),
        "anxiety_words": words.word_counts(_in(posts, "anxiety"), POST),
        "worthless_share": words.term_share(_in(posts, "depression"), POST, "worthless"),
        "help_share": words.term_share(_in(posts, "suicidewatch"), POST, "help"),
    }
    sorted_by = orders()
    for name, report in reports.items():
        catalog.report(report, f"posts/{name}", sorted_by.get(name, ()))
    if cases_path is not None:
        for name, report in case_reports(season, read_cases(spark, cases_path)).items():
            catalog.report(report, f"posts/{name}")


def orders() -> dict[str, list]:
    """Order of the rows of a report, for those that have one."""
    return {
        "posts_by_community": [F.desc("posts"), COMMUNITY],
        "posts_by_month": ["month"],
        "season_by_month": ["year", "month"],
        "seasonal_pattern": ["month"],
        "engagement_authors": [F.desc("posts"), AUTHOR],
        "engagement_months": ["month"],
        "engagement_community_months": [COMMUNITY, "month"],
        "engagement_communities": [F.desc("posts"), COMMUNITY],
        "pandemic_hits": [DATE],
        "health_cloud": [F.desc("counts"), "word"],
        "anxiety_words": [F.desc("counts"), "word"],
        "community_month_matrix": [COMMUNITY],
        "daily_trend": [DATE],
    }


def keywords(spark: SparkSession) -> DataFrame:
    return rows_table(spark, COMMUNITY_KEYWORDS.items(), f"{COMMUNITY} string, keywords array<string>")


def month_matrix(posts: DataFrame) -> DataFrame:
    """Posts of each community, with one column per yyyy-MM."""
    months = posts.select(month_key(F.col(DATE)).alias("m")).where("m is not null").distinct()
    names = sorted(r["m"] for r in months.collect())  # as many as the corpus has months
    dated = posts.withColumn("month", month_key(F.col(DATE)))
    return activity.pivot_counts(dated, F.col(COMMUNITY), "month", names, COMMUNITY)


def daily_trend(posts: DataFrame) -> DataFrame:
    """Posts of each day, with one column per community."""
    found = posts.select(COMMUNITY).where(F.col(COMMUNITY).isNotNull()).distinct()
    names = sorted(r[COMMUNITY] for r in found.collect())  # communities become columns
    return activity.pivot_counts(posts, F.col(DATE), COMMUNITY, names, DATE)


def _in(posts: DataFrame, community: str) -> DataFrame:
    return posts.where(F.col(COMMUNITY) == community)


def case_reports(season: DataFrame, cases: DataFrame) -> dict[str, DataFrame]:
    """Posts beside case numbers, by month and by day."""
    by = [COMMUNITY]
    after, cases_after = season.where(in_dates(F.col(DATE), *AFTER)), cases.where(in_dates(F.col("date"), *AFTER))
    # AFTER is whole months, so filtering the dates keeps the months' sums and reaches the scans.
    monthly = period_totals(after, DATE, None, "month", "num_posts")
    cases_monthly = period_totals(cases_after, "date", "cases", "month", "total_cases")
    monthly_by = period_totals(season, DATE, None, "month", "num_posts", by)
    cases_all = period_totals(cases, "date", "cases", "month", "total_cases")
    in_season_cases = cases.where(in_season(F.col("date"), *SEASON))
    cases_season = period_totals(in_season_cases, "date", "cases", "month", "total_cases")
    daily = period_totals(after, DATE, None, "day", "num_posts", by)
    cases_daily = period_totals(cases_after, "date", "cases", "day", "total_cases")
    return {
        "case_correlation": series_correlation(
            monthly_by, cases_all, ["period"], "num_posts", "total_cases"
        ),
        "case_correlation_by_community": series_correlation(
            monthly_by, cases_season, ["period"], "num_posts", "total_cases", by
        ),
        "cases_by_month": align_series(monthly, cases_monthly, ["period"], "outer", 0),
        "cases_by_day": align_series(daily, cases_daily, ["period"], "inner"),
    }
