"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the mix has the point frac(i x golden ratio); the source whose stretch of the cumulative
targets holds the point fills the slot. Such points are spread so evenly that every source is within
a few slots of its target at any time. Each source's documents, in shuffled order, form a tape of
blocks of equally many words, run through at most `repeats` times; its r-th slot takes its r-th block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.base import column, extended, query, table, with_row_key
from tallyloom.session import stage
from tallyloom.sources.tables import rows_table

WORD = r"[^\x20\x09-\x0D]+"
REPEATS = 3
BLOCK_WORDS = 4096
#: Smaller tables get smaller blocks, so that a source has about this many slots.
SLOTS_PER_SOURCE = 1000
ROWS_PER_PART = 250_000

_GOLDEN = 0x9E3779B97F4A7C15  # 2^64 / golden ratio


def targets(sizes: list[int], weights: list[float], repeats: int = REPEATS) -> list[float]:
    """Shares of the total by weight; what exceeds `repeats` times a source's size is shared again
    by weight among the others until none exceeds it."""
    result = [0.0] * len(sizes)
    open_, rest = [i for i, s in enumerate(sizes)], float(sum(sizes))
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if rest * weights[i] / weight > repeats * sizes[i]]
        if not over:
            for i in open_:
                result[i] = rest * weights[i] / weight
            break
        for i in over:
            result[i] = float(repeats * sizes[i])
            rest -= result[i]
        open_ = [i for i in open_ if i not in over]
    return result


def running_sums(ordered: DataFrame, group: str, value: str, label: str) -> DataFrame:
    """Add `before`: the sum of `value` over the earlier rows of the same group.

    Earlier means in a lower partition or above in the same one. Partitions sum for themselves; only
    one total per partition and group is ordered across partitions.
    """
    keys = ordered.columns

    def rows(batches):
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            groups = column(batch, group).to_numpy(zero_copy_only=False)
            values = column(batch, value).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.empty(len(values), np.int64)
            order = np.argsort(groups, kind="stable")
            edges = np.flatnonzero(np.diff(groups[order])) + 1
            for at in np.split(order, edges):
                if len(at):
                    g = int(groups[at[0]])
                    ends = np.cumsum(values[at]) + seen.get(g, 0)
                    before[at], seen[g] = ends - values[at], int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    *(column(batch, k) for k in keys),
                    pa.array(np.full(len(values), part, np.int32)),
                    pa.array(before),
                ],
                names=[*keys, "_part", "_before"],
            )

    local = stage(ordered.mapInArrow(rows, extended(ordered.schema, "_part int, _before long")), label)
    totals = local.groupBy("_part", group).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", group, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")
    )
    return local.join(offsets, ["_part", group]).select(
        *keys, (F.col("_before") + F.col("_offset")).alias("before")
    )


def schedule(spark, shares: list[float], n_slots: int) -> DataFrame:
    """The slots: slot, source (index of the share), rank among the slots of the source."""
    total = sum(shares) or 1.0
    bounds = np.array(
        [min(int(x / total * 2**64), 2**64 - 1) for x in np.cumsum(shares)[:-1]], np.uint64
    )

    def rows(batches):
        for batch in batches:
            slot = column(batch, "slot").to_numpy()
            point = (slot.astype(np.uint64) + np.uint64(1)) * np.uint64(_GOLDEN)
            source = np.searchsorted(bounds, point, "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "slot"), pa.array(source), pa.array(np.ones(len(slot), np.int64))],
                names=["slot", "source", "one"],
            )

    parts = max(1, -(-n_slots // ROWS_PER_PART))
    slots = spark.range(0, n_slots, 1, parts).withColumnRenamed("id", "slot")
    placed = slots.mapInArrow(rows, "slot long, source int, one long")
    return running_sums(placed, "source", "one", "slots").select(
        "slot", "source", F.col("before").alias("rank")
    )


def whole_words(target: float) -> int:
    """The words a target stands for: to the nearest one, halves down."""
    return int(target + 0.499999)


def _slots(spark, goals: list[float], block: int) -> DataFrame:
    """The schedule with exactly the blocks that each source's target takes, the last one begun.

    The points give a source its share to within a few slots; a source that has too few gets the
    rest behind the last slot, one that has too many leaves some unused.
    """
    wanted = [-(-whole_words(g) // block) for g in goals]
    n_slots = sum(wanted)
    needs = rows_table(spark, enumerate(wanted), "source int, wanted bigint")
    given = stage(schedule(spark, goals, n_slots).join(needs, "source").where(F.col("rank") < F.col("wanted")), "schedule")
    counts = {r["source"]: r["n"] for r in given.groupBy("source").agg(F.count("*").alias("n")).collect()}
    rest, last = [], n_slots
    for source, want in enumerate(wanted):
        missing = want - counts.get(source, 0)
        if missing:
            rest.append((source, want - missing, want - 1, last))
            last += missing
    late = rows_table(spark, rest, "source int, low bigint, high bigint, first bigint")
    late = late.withColumn("rank", F.explode(F.sequence("low", "high")))
    late = late.select((F.col("first") + F.col("rank") - F.col("low")).alias("slot"), "source", "rank")
    return given.select("slot", "source", "rank").union(late)


def mix(documents: DataFrame, weights=(1, 2, 3), repeats: int = REPEATS, seed: int = 11):
    """Mix the documents: (documents with size, source_size, target and taken; the segments).

    Sources are ordered by code point with null last and weigh `weights` in turn; one total per
    source is held by the driver. Segments say which words each slot takes: slot, row_key, pass_,
    skipped (words of the document before them) and words. `taken` is their sum per document.
    A null or empty text has size 0 and is never taken. Repeated rows are rows of their own. The
    order of a tape is a hash of doc_id (then of the text), so reruns agree; rows that agree in both
    have equal shares in any order. A source's last block is cut at its target, so every source's
    taken words are its target to the nearest word, however small. An empty table gives empty results.
    """
    spark = documents.sparkSession
    measured = stage(
        with_row_key(documents.select("doc_id", "source", "text")).select(
            "row_key",
            "doc_id",
            F.col("source").cast("string").alias("name"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")), 256).alias("key"),
            F.xxhash64("text").alias("tie"),
        ),
        "sizes",
    )
    stats = measured.groupBy("name").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    stats.sort(key=lambda r: (r["name"] is None, (r["name"] or "").encode()))
    sizes = [r["size"] for r in stats]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], repeats)
    total = sum(sizes)
    block = max(1, min(BLOCK_WORDS, total // (SLOTS_PER_SOURCE * max(1, len(sizes)))))
    # Spark knows the size of this table: few sources are broadcast, many are joined with skew split.
    sources = rows_table(
        spark,
        [(r["name"], i, s, g, whole_words(g)) for i, (r, s, g) in enumerate(zip(stats, sizes, goals))],
        "name string, source int, source_size bigint, target double, reach bigint",
    )
    known = measured.join(sources, measured["name"].eqNullSafe(sources["name"])).select(
        "row_key", "doc_id", "source", "size", "source_size", "target", "reach", "key", "tie"
    )
    slots = stage(_slots(spark, goals, block), "slots")

    parts = max(1, sum(r["n"] for r in stats) // ROWS_PER_PART, spark.sparkContext.defaultParallelism)
    order = ["source", "key", "tie", "row_key"]
    tape = running_sums(
        known.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("row_key", "source", "size", "source_size", "reach"),
        "source",
        "size",
        "tape",
    )
    # Only stretches before the words at which the source's target ends.
    reached = tape.where("size > 0")
    start = F.col("pass_") * F.col("source_size") + F.col("before")
    last = F.floor((F.least(F.col("start") + F.col("size"), "reach") - 1) / F.lit(block)).cast("long")
    stretches = (
        reached.withColumn("pass_", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn("start", start)
        .where("start < reach")
        .withColumn("block", F.floor(F.col("start") / F.lit(block)).cast("long"))
        .withColumn("last", last)
        .withColumn("rank", F.explode(F.sequence("block", "last")))
    )
    begin = F.greatest("start", F.col("rank") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("rank") + 1) * block, "reach")
    segments = stretches.join(slots, ["source", "rank"]).select(
        "slot",
        "row_key",
        "pass_",
        (begin - F.col("start")).alias("skipped"),
        (end - begin).alias("words"),
    )
    taken = segments.select("row_key", "words").union(known.select("row_key", F.lit(0).cast("long")))
    per_row = taken.groupBy("row_key").agg(F.sum("words").alias("taken"))
    mixed = known.select("row_key", "doc_id", "size", "source_size", "target").join(per_row, "row_key")
    return mixed, segments


#: A source's blocks are taken in order up to its target, so what a document gives is what its stretch
#: of the tape has in common with the source's first words up to the target, over all passes.
_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    sha256('11:' || doc_id) AS key FROM documents),
s AS (SELECT source, sum(size) AS ss, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY 1),
w AS (SELECT *, 1 + i % 3 AS w, {REPEATS} * ss AS cap, sum(ss) OVER () AS total FROM s),
r AS (SELECT *, total - coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl FROM w),
o AS (SELECT *, rest * w > cap * wl AS over FROM r),
f AS (SELECT max(total) - coalesce(sum(cap) FILTER (over), 0) AS rest, sum(w) FILTER (NOT over) AS wl FROM o),
t AS (SELECT source, i, ss, CASE WHEN over THEN cap::DOUBLE ELSE f.rest::DOUBLE * w / f.wl END AS target FROM o, f),
p AS (SELECT d.doc_id, d.size, t.ss, t.target, floor(t.target + 0.499999)::BIGINT AS reach,
    sum(size) OVER (PARTITION BY t.i ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(ss AS BIGINT) AS source_size, target, CAST({
    " + ".join(f"greatest(0, least(before + size + {e} * ss, reach) - before - {e} * ss)" for e in range(REPEATS))
} AS BIGINT) AS taken FROM p"""


@query(_SQL)
def op8_mixing(spark, sf_dir):
    mixed, _ = mix(table(spark, sf_dir, "documents"))
    return mixed.drop("row_key")
