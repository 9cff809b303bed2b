"""Analytics on an entity x time panel of measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordering import bottom_k, smallest_k, top_k
from tallyloom.operators.shaping import col, require


def group_means(panel: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    require(panel, [*keys, *measures])
    return panel.groupBy(*[col(key) for key in keys]).agg(
        *[F.avg(col(name)).alias(name) for name in measures]
    )


def top_bottom_with_mean(
    panel: DataFrame, entity: str, time: str, measure: str, k: int = 5, mean_name: str = "Mean"
) -> DataFrame:
    """Series of the k entities with the largest and the k with the smallest overall mean, plus a
    `Mean` pseudo-entity with the mean over all entities at each time.

    The chosen entities are at most 2k rows, so joining them back is a bounded broadcast.
    """
    require(panel, [entity, time, measure])
    overall = group_means(panel, [entity], [measure])
    chosen = (
        top_k(overall, measure, entity, k)
        .unionByName(bottom_k(overall, measure, entity, k))
        .select(col(entity))
        .distinct()
    )
    rows = panel.select(col(time), col(entity), col(measure))
    means = group_means(panel, [time], [measure]).select(
        col(time), F.lit(mean_name).alias(entity), col(measure)
    )
    return rows.join(F.broadcast(chosen), entity, "left_semi").unionByName(means)


def worst_group_drilldown(panel: DataFrame, group: str, entity: str, measure: str) -> DataFrame:
    """(group, entity, mean) inside the group with the largest mean.

    One aggregation by group and entity serves both steps; the group means are put together from
    its sums and counts, so the panel is not scanned again.
    """
    require(panel, [group, entity, measure])
    parts = panel.groupBy(col(group), col(entity)).agg(
        F.sum(col(measure)).alias("_sum"), F.count(col(measure)).alias("_n")
    )
    by_group = parts.groupBy(col(group)).agg(
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("_mean")
    )
    worst = top_k(by_group, "_mean", group, 1).select(col(group))
    return parts.join(F.broadcast(worst), group).select(
        col(group), col(entity), F.try_divide(F.col("_sum"), F.col("_n")).alias(measure)
    )


def growth_between(
    panel: DataFrame, group: str, time: str, measures: Sequence[str], first, last
) -> DataFrame:
    """Mean at `last` minus mean at `first`, per group seen at both times.

    Both times are read in one aggregation. Result columns are named `<Measure> growth`.
    """
    require(panel, [group, time, *measures])
    at_first, at_last = col(time) == first, col(time) == last
    means = [
        (
            F.avg(F.when(at_last, col(name))) - F.avg(F.when(at_first, col(name)))
        ).alias(f"{name.capitalize()} growth")
        for name in measures
    ]
    return (
        panel.where((at_first | at_last) & col(group).isNotNull())
        .groupBy(col(group))
        .agg(*means, F.count_if(at_first).alias("_first"), F.count_if(at_last).alias("_last"))
        .where((F.col("_first") > 0) & (F.col("_last") > 0))
        .drop("_first", "_last")
    )


def correlation_matrix(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Pearson correlations in long form (a, b, r), over rows where both are known.

    All pairs come from one aggregation that combines on the map side.
    """
    require(df, measures)
    cells = {
        (a, b): F.corr(col(a).cast("double"), col(b).cast("double"))
        for a, b in combinations(measures, 2)
    }
    cells.update({(a, a): F.when(F.count(col(a)) > 1, F.lit(1.0)) for a in measures})
    entries = []
    for (a, b), value in cells.items():
        entries += [
            F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), value.alias("r"))
            for x, y in {(a, b), (b, a)}
        ]
    return df.agg(F.array(*entries).alias("m")).select(F.explode("m").alias("e")).select("e.*")


def top_bottom_union(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], k: int = 5
) -> DataFrame:
    """Mean of the measures by keys; then the k largest and k smallest rows by each, without repeats."""
    means = group_means(df, keys, measures)
    picks = [top_k(means, name, keys, k) for name in measures]
    picks += [smallest_k(means, name, keys, k) for name in measures]
    union = picks[0]
    for pick in picks[1:]:
        union = union.unionByName(pick)
    return union.dropDuplicates()


def split_by_presence(
    df: DataFrame, flag: str, entity: str, measures: Sequence[str], k: int = 5
) -> DataFrame:
    """Entities with the k largest values of each measure, where the flag is present and where not:
    (present, entity, measures), without repeats inside a side."""
    require(df, [flag, entity, *measures])
    rows = df.select(
        col(flag).isNotNull().alias("present"), col(entity), *[col(name) for name in measures]
    )
    sides = []
    for side in (True, False):
        part = rows.where(F.col("present") == side)
        picks = [top_k(part, name, entity, k) for name in measures]
        union = picks[0]
        for pick in picks[1:]:
            union = union.unionByName(pick)
        sides.append(union.dropDuplicates())
    return sides[0].unionByName(sides[1])


def mean_by_presence(
    df: DataFrame, flag: str, measures: Sequence[str], present: str, absent: str
) -> DataFrame:
    """Mean measures by whether the flag is present: (status, measures)."""
    status = F.when(col(flag).isNotNull(), present).otherwise(absent).alias("status")
    return df.groupBy(status).agg(*[F.avg(col(name)).alias(name) for name in measures])


def entity_panel(
    facts: DataFrame,
    key: str,
    time: Column,
    measures: Mapping[str, str],
    dim: DataFrame,
    dim_key: str,
    entity: Sequence[str],
    time_name: str = "year",
) -> DataFrame:
    """Mean measures by entity and time, where the entity hangs on a key of the facts.

    Facts are folded to sums and counts by key and time before the join, so a key with a third of
    the rows reaches the join as one row per time, and the join moves keys, not facts.
    `measures` maps result names to fact columns.
    """
    require(facts, [key, *measures.values()])
    require(dim, [dim_key, *entity])
    sums = {name: F.sum(col(source)).alias(f"_s_{name}") for name, source in measures.items()}
    counts = {name: F.count(col(source)).alias(f"_n_{name}") for name, source in measures.items()}
    folded = facts.groupBy(col(key).alias("_key"), time.alias(time_name)).agg(
        *sums.values(), *counts.values()
    )
    keyed = dim.select(col(dim_key).alias("_key"), *[col(name) for name in entity])
    means = [
        F.try_divide(F.sum(f"_s_{name}"), F.sum(f"_n_{name}")).alias(name) for name in measures
    ]
    return folded.join(keyed, "_key").groupBy(*[col(name) for name in entity], time_name).agg(*means)
