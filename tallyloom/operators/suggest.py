"""Drafts of dictionary entries: for each name the entries written almost alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.shaping import col, require
from tallyloom.session import stage


def _segment(length: Column, i: Column, parts: int) -> tuple[Column, Column]:
    """Begin (from 0) and size of segment i of a text cut into `parts` nearly equal ones."""
    size, longer = F.floor(length / parts), length % parts
    late = F.greatest(i - (parts - longer), F.lit(0))
    return i * size + late, size + F.when(i >= parts - longer, 1).otherwise(0)


def suggest_entries(
    names: DataFrame, name: str, dictionary: DataFrame, entry: str, distance: int = 2
) -> DataFrame:
    """All pairs of a name and an entry at most `distance` edits apart: (name, entry, edits, rank).

    Names and entries are compared in lower case without blanks at their ends; those that are null or
    then empty are left out, and repeats count once. `rank` orders a name's entries by edits, then
    text. No pair is lost: an entry is cut into `distance` + 1 segments, of which so many edits leave
    one untouched, shifted by `distance` places at most; so both texts are joined on segments under the
    entry's length and the segment's number, and the edits are counted within the join.
    """
    require(names, [name])
    require(dictionary, [entry])
    parts = distance + 1
    span = lambda low, high: F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    tidy = lambda x: F.lower(F.trim(col(x)))

    left = names.select(col(name).alias("name"), tidy(name).alias("n")).where("n <> ''").distinct()
    right = dictionary.select(col(entry).alias("entry"), tidy(entry).alias("e")).where("e <> ''").distinct()
    numbers = [F.lit(i) for i in range(parts)]

    def cut(i: Column) -> Column:
        length = F.length("e")
        begin, size = _segment(length, i, parts)
        piece = F.substring(F.col("e"), (begin + 1).cast("int"), size.cast("int"))
        return F.struct(length.alias("length"), i.alias("part"), piece.alias("piece"))

    right = right.select("entry", "e", F.explode(F.array(*(cut(i) for i in numbers))).alias("key"))

    long = F.length("n")
    left = left.withColumn("length", F.explode(span(F.greatest(long - distance, F.lit(1)), long + distance)))
    left = left.withColumn("part", F.explode(F.array(*numbers)))
    begin, size = _segment(F.col("length"), F.col("part"), parts)
    left = left.withColumns({"begin": begin.cast("int"), "size": size.cast("int")})
    first = F.greatest(F.col("begin") - distance, F.lit(0))
    last = F.least(F.col("begin") + distance, long - F.col("size"))
    left = left.withColumn("place", F.explode(span(first, last)))
    key = F.struct("length", "part", F.substring(F.col("n"), F.col("place") + 1, F.col("size")).alias("piece"))
    left = left.select("name", "n", key.alias("key")).distinct()

    # Sides that come out of an aggregation are staged, so that a frequent segment can be split.
    left, right = stage(left, "name-pieces"), stage(right, "entry-pieces")
    near = F.levenshtein("n", "e", distance)
    pairs = left.join(right, (left["key"] == right["key"]) & (near >= 0)).select("name", "entry", near.alias("edits"))
    pairs = pairs.distinct()
    listed = pairs.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("edits", "entry"))).alias("found"))
    found = listed.select("name", F.posexplode("found").alias("place", "f"))
    return found.select("name", "f.entry", "f.edits", (F.col("place") + 1).alias("rank"))
