"""Benchmark decontamination by winnowing.

Of every window of `window` words the smallest hash of its `gram`-word grams is kept. A window that
occurs in both tables keeps the same gram in both, so joining the kept grams misses no shared span
of `window` words or more. A hit is then extended to the whole windows that chose the gram, which
must equal a benchmark window word by word.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import bytewords as bw
from tallyloom.llm.base import column, extended, query, table, with_row_key
from tallyloom.session import stage

WINDOW = 13
GRAM = 6
#: The benchmark's grams as a bit field of fixed size (1 MiB): it spares the join most grams that
#: cannot match. With a benchmark so large that it fills up, it merely stops sparing.
FIELD_BITS = 1 << 23

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SPANS = (
    "n_words long, "
    "spans array<struct<size: int, gram: long, first: long, windows: int, words: string>>"
)
_SPAN = pa.list_(
    pa.struct(
        [
            ("size", pa.int32()),
            ("gram", pa.int64()),
            ("first", pa.int64()),
            ("windows", pa.int32()),
            ("words", pa.string()),
        ]
    )
)


def _spans(words: bw.Words, hashes: np.ndarray, size: int, gram: int, field):
    """Runs of windows that keep the same gram: text row, gram, first window, number of windows."""
    k = min(gram, size)
    grams = bw.roll(hashes, k)
    kept = bw.rightmost_minimum(grams, size - k + 1)
    n = len(kept)
    if n <= 0:
        return None
    at = np.flatnonzero(words.row[:n] == words.row[size - 1 : size - 1 + n])
    if not len(at):
        return None
    chosen = kept[at]
    new = np.ones(len(at), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    at, value = at[begin], grams[chosen[begin]]
    if field is not None:
        bit = value & np.uint64(FIELD_BITS - 1)
        found = (field[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        at, value, count = at[found], value[found], count[found]
    return words.row[at], bw.signed(value), at, count


def kept_grams(df: DataFrame, sizes, gram: int = GRAM, field=None, own_size: int | None = None):
    """To each row the number of words of its text and the spans of windows by kept gram.

    `sizes` are the window lengths; with `own_size` a text of fewer words is one window of its own
    length and others have windows of `own_size`. `field` is a broadcast bit field of the grams
    worth keeping.
    """

    def rows(batches):
        bits = field.value if field is not None else None
        for batch in bw.chunks(batches):
            words = bw.split_words(column(batch, "text"), bw.ALNUM, lower=True)
            hashes = bw.hash_words(words)
            spans = [[] for _ in range(batch.num_rows)]
            for size in sizes:
                found = _spans(words, hashes, size, gram, bits)
                if found is None:
                    continue
                for row, value, first, count in zip(*(x.tolist() for x in found)):
                    if own_size is not None and size != min(own_size, words.counts[row]):
                        continue
                    text = words.slice(first, first + count + size - 1)
                    spans[row].append(
                        {
                            "size": size,
                            "gram": value,
                            "first": first - int(words.first[row]),
                            "windows": count,
                            "words": b" ".join(_WORD.findall(text)).decode(),
                        }
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    *(column(batch, name) for name in keys),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(spans, _SPAN),
                ],
                names=[*keys, "n_words", "spans"],
            )

    keys = [name for name in df.columns if name != "text"]
    return df.mapInArrow(rows, extended(df.drop("text").schema, _SPANS))


def _windows(span):
    """The windows of a span as (first, size, words)."""
    words = F.split(span["words"], " ")
    return F.transform(
        F.sequence(F.lit(0), span["windows"] - 1),
        lambda i: F.struct(
            (span["first"] + i).alias("first"),
            span["size"].alias("size"),
            F.array_join(F.slice(words, i + 1, span["size"]), " ").alias("words"),
        ),
    )


def benchmark_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Every window of the items, with the gram it keeps: item_id, size, gram, words."""
    found = kept_grams(items.select("item_id", "text"), range(1, window + 1), gram, own_size=window)
    spans = found.select("item_id", F.explode("spans").alias("span"))
    opened = spans.select(
        "item_id", F.col("span.gram").alias("gram"), F.explode(_windows(F.col("span"))).alias("w")
    )
    return opened.select(
        "item_id", F.col("w.size").alias("size"), "gram", F.col("w.words").alias("words")
    )


def _bit_field(spark, grams: DataFrame):
    """The grams as a bit field, folded to at most FIELD_BITS / 64 numbers before the driver."""
    words = (
        grams.select(F.col("gram").bitwiseAND(F.lit(FIELD_BITS - 1)).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .collect()
    )
    field = np.zeros(FIELD_BITS // 64, np.int64)
    for row in words:
        field[row["word"]] = row["bits"]
    return spark.sparkContext.broadcast(field.view(np.uint64))


def contamination(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Per row of `documents` the words inside a benchmark window and the items they come from.

    Adds to row_key and doc_id: n_words, n_hit, item_ids (sorted strings). Texts are compared as runs of
    lower-cased words; a null or empty text has no words and no hits, and a null or empty item has
    no windows. An item of fewer than `window` words is one window. Repeated rows of documents are
    answered one by one, repeated items name their item_id once, a null item_id is left out of
    item_ids though its windows count. Empty tables give no rows, or rows without hits. Other
    columns are ignored.
    """
    spark = documents.sparkSession
    bench = stage(benchmark_windows(items, window, gram), "benchmark")
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())  # at most `window`
    # Plain tables: below Spark's limit they are broadcast, beyond it hot keys are split.
    by_gram = stage(bench.select("size", "gram").distinct().withColumn("known", F.lit(True)), "grams")
    by_words = stage(
        bench.groupBy("size", "words").agg(F.collect_set("item_id").alias("items")), "windows"
    )
    field = _bit_field(spark, by_gram)
    keyed = with_row_key(documents.select("doc_id", "text"))

    found = kept_grams(keyed, sizes, gram, field)
    spans = found.select("row_key", "doc_id", "n_words", F.explode_outer("spans").alias("span"))
    # A row without spans gets a key of its own: null keys would meet in one task.
    hits = spans.select(
        "*",
        F.coalesce("span.size", F.lit(0)).alias("size"),
        F.coalesce("span.gram", F.xxhash64("row_key")).alias("gram"),
    ).join(by_gram, ["size", "gram"], "left")
    opened = hits.select(
        "row_key",
        "doc_id",
        "n_words",
        F.explode_outer(F.when(F.col("known"), _windows(F.col("span")))).alias("w"),
    )
    matched = opened.select(
        "row_key",
        "doc_id",
        "n_words",
        F.col("w.first").alias("first"),
        F.coalesce("w.size", F.lit(0)).alias("size"),
        F.coalesce("w.words", F.col("row_key").cast("string")).alias("words"),
    ).join(by_words, ["size", "words"], "left")
    hit = F.when(F.col("items").isNotNull(), F.struct("first", "size"))
    per_row = matched.groupBy("row_key", "doc_id", "n_words").agg(
        F.array_sort(F.collect_set(hit)).alias("hits"),
        F.array_sort(
            F.transform(
                F.array_distinct(F.flatten(F.collect_set("items"))), lambda i: i.cast("string")
            )
        ).alias("item_ids"),
    )
    start = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(0).cast("long").alias("end"))

    def cover(state, span):
        end = span["first"] + span["size"]
        return F.struct(
            (
                state["covered"]
                + F.greatest(F.lit(0).cast("long"), end - F.greatest(state["end"], span["first"]))
            ).alias("covered"),
            F.greatest(state["end"], end).alias("end"),
        )

    return per_row.select(
        "row_key",
        "doc_id",
        "n_words",
        F.aggregate("hits", start, cover, lambda s: s["covered"]).alias("n_hit"),
        "item_ids",
    )


_SQL_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
WITH item AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS size, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i, w
       FROM item WHERE len(w) > 0),
bench AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS words FROM bw),
doc AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM bench),
dw AS (SELECT doc_id, size, unnest(generate_series(1, len(w) - size + 1)) AS i, w FROM doc, sizes WHERE len(w) >= size),
dx AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS words FROM dw),
hit AS (SELECT doc_id, size, i, item_id FROM dx JOIN bench USING (size, words)),
pos AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM (SELECT DISTINCT doc_id, size, i FROM hit)),
n AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN n USING (doc_id) LEFT JOIN ids USING (doc_id)""")
def op1_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def contaminated():
    """At least one word in twenty lies in a benchmark window."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
