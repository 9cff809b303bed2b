"""Declared schemas of the inputs that come without usable headers, and of the post corpus."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def texts(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


COUNTRY_DICTIONARY = texts("country", "country_name", "country_code", "un_region")
CODE_DICTIONARY = texts("country", "country_code")
# The file's header says `country`, but the column holds currency codes.
RATES = texts("currency", "rate")
POSTS = texts("subreddit", "author", "date", "post")
CASES = texts("date", "cases", "deaths")
