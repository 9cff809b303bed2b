"""Text of a group as one addressable string, in chunks of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.shaping import col, require
from tallyloom.session import stage

#: Characters of a chunk.
CHUNK = 1 << 20


def ordered_text(
    df: DataFrame, by: str, id: str, text: str, separator: str = " ", chunk: int = CHUNK
) -> DataFrame:
    """All texts of each group in id order, joined by the separator: (by, chunk, offset, text).

    Chunks put together in order are the group's string; `offset` is a chunk's first character, and
    every chunk but the last has `chunk` characters, so any place is found by division. Rows are
    sorted by range; where each text begins comes from sums per part, so no group meets in one task.
    A group's null texts are left out; one without characters has no chunks. Ids should be unique:
    texts of one id are ordered by themselves.
    """
    require(df, [by, id, text])
    rows = df.where(col(text).isNotNull()).select(col(by).alias("by"), col(id).alias("id"), col(text).alias("text"))
    order = ["by", "id", "text"]
    rows = rows.repartitionByRange("by", "id").sortWithinPartitions(*order)
    rows = stage(rows.withColumn("place", F.monotonically_increasing_id()), "ordered")
    # Every text is led by a separator; the first character of a group is cut off in the end.
    size = F.char_length("text") + len(separator)
    rows = rows.withColumn("part", F.shiftright("place", 33)).withColumn("size", size.cast("long"))
    sums = rows.groupBy("by", "part").agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy("by").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("by").alias("of"), F.col("part").alias("at"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("part", "by").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(stage(starts, "starts"), F.col("by").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at")))
    begin = F.col("start") + F.col("inside") - len(separator)
    led = F.concat(F.lit(separator), F.col("text"))
    cut = joined.select("by", begin.alias("begin"), led.alias("led")).select(
        "by",
        F.greatest("begin", F.lit(0)).alias("begin"),
        F.when(F.col("begin") < 0, F.substring("led", len(separator) + 1, F.lit(1 << 30))).otherwise(F.col("led")).alias("led"),
    )
    last = F.floor((F.col("begin") + F.char_length("led") - 1) / chunk)
    first = F.floor(F.col("begin") / chunk)
    pieces = cut.where(F.char_length("led") > 0).select(
        "by", "begin", "led", F.explode(F.sequence(first, last)).alias("chunk")
    )
    skip = F.greatest(F.col("chunk") * chunk - F.col("begin"), F.lit(0))
    take = (F.col("chunk") + 1) * chunk - F.greatest("begin", F.col("chunk") * chunk)
    piece = F.substring("led", (skip + 1).cast("int"), take.cast("int"))
    entry = F.struct((F.col("begin") + skip).alias("begin"), piece.alias("piece"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["piece"]), "")
    return pieces.groupBy("by", "chunk").agg(whole.alias("text")).select(
        F.col("by").alias(by), "chunk", (F.col("chunk") * chunk).alias("offset"), "text"
    )
