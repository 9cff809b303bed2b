"""Top, bottom, rank and quantiles without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.joins import join_by_frequency
from tallyloom.operators.shaping import col, require
from tallyloom.session import stage
from tallyloom.sources.tables import rows_table

DECILES = tuple(range(1, 10))
#: Distinct values ordered together in one task.
PART_ROWS = 1_000_000


def top_k(df: DataFrame, measure: str, key: str | Sequence[str], k: int) -> DataFrame:
    """The k largest rows, nulls last, ties broken by ascending key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(col(measure).desc_nulls_last(), *[col(name).asc() for name in keys]).limit(k)


def bottom_k(df: DataFrame, measure: str, key: str | Sequence[str], k: int) -> DataFrame:
    """The last k rows of the order of `top_k`: a null measure counts as lowest."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(col(measure).asc_nulls_first(), *[col(name).desc() for name in keys]).limit(k)


def smallest_k(df: DataFrame, measure: str, key: str | Sequence[str], k: int) -> DataFrame:
    """The k smallest rows, nulls first, ties broken by ascending key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(col(measure).asc_nulls_first(), *[col(name).asc() for name in keys]).limit(k)


def top_bottom(df: DataFrame, measure: str, key: str, k: int = 5) -> DataFrame:
    """Top k then bottom k, one below the other; below 2k rows some appear twice."""
    return top_k(df, measure, key, k).unionByName(bottom_k(df, measure, key, k))


def leading_key(df: DataFrame, measure: str, key: str) -> DataFrame:
    """One row with the key of the largest measure."""
    return top_k(df, measure, key, 1).select(col(key))


def rank_top_bottom(
    counts: DataFrame, item: str, measure: str, k: int = 20, method: str = "rank"
) -> DataFrame:
    """Top and bottom items by descending measure: (item, measure, rank, side).

    `rank` numbers ties alike and leaves gaps: top is rank <= k, bottom is rank > items - k, so a
    tie group that straddles the bottom boundary is left out whole. `row_number` breaks ties by
    item and gives exactly k rows on each side when there are enough.

    Only the k most extreme distinct measures can take part, so ranks come from a frequency table
    cut to k rows rather than from a window over all items.
    """
    require(counts, [item, measure])
    base = counts.select(col(item), col(measure)).where(col(measure).isNotNull())
    total = base.agg(F.count("*").alias("n")).scalar()
    if method == "row_number":
        first = top_k(base, measure, item, k)
        last = bottom_k(base, measure, item, k)
        down = Window.orderBy(col(measure).desc(), col(item).asc())
        up = Window.orderBy(col(measure).asc(), col(item).desc())
        top = first.withColumn("rank", F.row_number().over(down).cast("bigint"))
        bottom = last.withColumn("rank", total - F.row_number().over(up) + 1)
    elif method == "rank":
        steps = base.groupBy(col(measure)).agg(F.count("*").alias("items"))
        down = Window.orderBy(col(measure).desc()).rowsBetween(Window.unboundedPreceding, -1)
        up = Window.orderBy(col(measure).asc()).rowsBetween(Window.unboundedPreceding, 0)
        above = F.coalesce(F.sum("items").over(down), F.lit(0))
        top_steps = (
            steps.orderBy(col(measure).desc())
            .limit(k)
            .select(col(measure), (above + 1).alias("rank"))
            .where(F.col("rank") <= k)
        )
        bottom_steps = (
            steps.orderBy(col(measure).asc())
            .limit(k)
            .select(col(measure), (total - F.sum("items").over(up) + 1).alias("rank"))
            .where(F.col("rank") > total - k)
        )
        # At most k rows on the right of each join.
        top = base.join(F.broadcast(top_steps), measure)
        bottom = base.join(F.broadcast(bottom_steps), measure)
    else:
        raise ValueError("method must be 'rank' or 'row_number'")
    columns = [col(item), col(measure), "rank"]
    return top.select(*columns, F.lit("top").alias("side")).unionByName(
        bottom.select(*columns, F.lit("bottom").alias("side"))
    )


def sorted_frequencies(
    df: DataFrame, measure: str, part_rows: int = PART_ROWS
) -> tuple[DataFrame, dict[int, int], int]:
    """Distinct known values of a measure in order, with their rows.

    Returns (value, rows, part), the rows before each part, and all known rows. Values keep their
    own type. Repeated values are folded before the shuffle; the number of parts follows from the
    number of distinct values, so no part outgrows about `part_rows` of them, and only one number
    per part reaches the driver. The table is staged: its parts must not change between passes.
    """
    require(df, [measure])
    known = df.select(col(measure).alias("value")).where("value is not null")
    counts = stage(known.groupBy("value").agg(F.count("*").alias("rows")), "frequencies")
    parts = max(1, -(-counts.count() // part_rows))
    dealt = counts.repartitionByRange(parts, "value").withColumn("part", F.spark_partition_id())
    table = stage(dealt, "sorted-frequencies")
    totals = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.sum("rows").alias("n")).collect()}
    before, seen = {}, 0
    for part in sorted(totals):
        before[part] = seen
        seen += totals[part]
    return table, before, seen


def _reached(table: DataFrame, before: dict[int, int]) -> DataFrame:
    """Add `reached`: the rows at or below each value. Windows stay inside a part of bounded size."""
    offsets = rows_table(table.sparkSession, before.items(), "part int, before bigint")
    inside = Window.partitionBy("part").orderBy("value")
    return table.join(offsets, "part").withColumn("reached", F.col("before") + F.sum("rows").over(inside))


def decile_ranks(total: int) -> list[int]:
    """Ranks of the nine deciles: ceil(i * total / 10)."""
    return [-(-i * total // 10) for i in DECILES] if total else []


def _exact_deciles(df: DataFrame, measure: str) -> list:
    table, before, total = sorted_frequencies(df, measure)
    ranks = decile_ranks(total)
    if not ranks:
        return []
    starts = sorted(before.items(), key=lambda item: item[1])
    wanted = {[part for part, n in starts if n < rank][-1] for rank in ranks}
    chosen = table.where(F.col("part").isin(*wanted))  # at most nine parts
    hit = F.exists(
        F.array(*[F.lit(rank) for rank in ranks]),
        lambda rank: (rank <= F.col("reached")) & (rank > F.col("reached") - F.col("rows")),
    )
    steps = _reached(chosen, before).where(hit).select("reached", "value").collect()  # at most nine
    return [min((s for s in steps if s["reached"] >= rank), key=lambda s: s["reached"])["value"] for rank in ranks]


def decile_values(df: DataFrame, measures: Sequence[str], exact: bool = True) -> dict[str, list]:
    """The nine values at or below which lie 10, 20 .. 90 percent of the known rows of a measure.

    Runs at once, as `approxQuantile` does, and gives nine values per measure in the measure's own
    type (none if all are null). `exact` selects by rank from the sorted distinct values; otherwise
    a sketch with relative error 0.001 is used, which compares doubles.
    """
    require(df, measures)
    if exact:
        return {name: _exact_deciles(df, name) for name in measures}
    shares = F.array(*[F.lit(i / 10) for i in DECILES])
    row = df.agg(
        *[
            F.percentile_approx(col(name).cast("double"), shares, F.lit(1000)).alias(name)
            for name in measures
        ]
    ).first()
    return {name: list(row[name] or []) for name in measures}


def deciles(df: DataFrame, measures: Sequence[str], exact: bool = True) -> DataFrame:
    """`decile_values` as a table: (measure, deciles). The deciles have the measures' type if they
    share one, else double."""
    values = decile_values(df, measures, exact)
    types = {df.schema[name].dataType.simpleString() for name in measures}
    kind = types.pop() if exact and len(types) == 1 else "double"
    number = (lambda v: v) if kind != "double" else float
    rows = [(name, [number(v) for v in found]) for name, found in values.items()]
    return rows_table(df.sparkSession, rows, f"measure string, deciles array<{kind}>")


def global_rank(df: DataFrame, measure: str) -> DataFrame:
    """Add `rank`: 1 + number of rows with a larger measure, ties alike, nulls last and alike.

    Ranks are made once per distinct value, inside ordered parts, and joined back; values shared by
    many rows go through the broadcast side of `join_by_frequency`. Values are compared in their own
    type.
    """
    table, before, total = sorted_frequencies(df, measure)
    ranked = _reached(table, before).select(
        F.col("value").alias("_value"),
        F.col("rows").alias("_rows"),
        (total + 1 - F.col("reached")).alias("rank"),
    )
    valued = df.withColumn("_value", col(measure))
    joined = join_by_frequency(valued, ranked, "_value", "_rows", F.lit(total))
    unknown = df.where(col(measure).isNull()).withColumn("rank", F.lit(total + 1).cast("bigint"))
    return joined.drop("_value", "_rows").unionByName(unknown)
