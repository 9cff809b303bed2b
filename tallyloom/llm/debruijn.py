"""Substring deduplication on a compacted De Bruijn graph of words.

Words' k-mers are the edges. Of every window of `window` words the least k-mer is its edge, so equal
windows hang on the same edge at the same place, and only edges that occur twice can carry a
repeated window. The words around an edge that its windows reach are its path. Occurrences that
agree on the whole path are compacted to one row with a multiplicity and the coordinate of one
source. Where several paths leave one edge, the graph branches there: the windows of each path are
then read from the text at its source coordinate and compared with those of the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import bytewords as bw
from tallyloom.llm.base import column, extended, query, table, with_row_key
from tallyloom.session import stage

WINDOW = 35
KMER = 15

_SECOND = 0xA24BAED4963EE407  # base of an independent hash


def _occurrences(window: int, kmer: int):
    """Edges of the texts: edge, path (hash of all words reached), first window, their number."""

    def rows(batches):
        for batch in bw.chunks(batches):
            words = bw.split_words(column(batch, "text"), bw.SOLID)
            hashes = bw.hash_words(words)
            edges = bw.roll(hashes, kmer)
            kept = bw.rightmost_minimum(edges, window - kmer + 1)
            n = len(kept)
            if not n:
                continue
            at = np.flatnonzero(words.row[:n] == words.row[window - 1 : window - 1 + n])
            if not len(at):
                continue
            chosen = kept[at]
            new = np.ones(len(at), bool)
            new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
            begin = np.flatnonzero(new)
            count = np.diff(np.append(begin, len(at)))
            at, chosen = at[begin], chosen[begin]
            whole = _spans(hashes, at, at + count + window - 1)
            shape = ((chosen - at) * 64 + count).astype(np.uint64)
            row = words.row[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bw.signed(edges[chosen])),
                    pa.array(bw.signed(bw.mix(whole ^ bw.mix(shape)))),
                    column(batch, "row_key").take(pa.array(row)),
                    pa.array((at - words.first[row]).astype(np.int64)),
                    pa.array(count.astype(np.int32)),
                ],
                names=["edge", "path", "row_key", "first", "windows"],
            )

    return rows


_inverse = pow(_SECOND, -1, 1 << 64)


def _spans(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the words from starts to ends, one per pair."""
    up = np.full(len(hashes) + 1, _SECOND, np.uint64)
    down = np.full(len(hashes) + 1, _inverse, np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    prefix = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(bw.mix(hashes) * up[:-1], out=prefix[1:])
    return bw.mix((prefix[ends] - prefix[starts]) * down[starts])


def _opened(window: int):
    """The windows of branching paths, read at their source: edge, path, place, two hashes."""

    def rows(batches):
        for batch in bw.chunks(batches):
            words = bw.split_words(column(batch, "text"), bw.SOLID)
            hashes = bw.hash_words(words)
            one, two = bw.roll(hashes, window), bw.roll(bw.mix(hashes), window, _SECOND)
            opened = column(batch, "paths")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(opened.offsets.to_numpy()))
            paths = opened.flatten()
            first = paths.field("first").to_numpy() + words.first[owner]
            count = paths.field("windows").to_numpy()
            each = np.repeat(np.arange(len(count)), count)
            place = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
            at = first[each] + place
            yield pa.RecordBatch.from_arrays(
                [
                    paths.field("edge").take(pa.array(each)),
                    paths.field("path").take(pa.array(each)),
                    pa.array(place.astype(np.int32)),
                    pa.array(bw.signed(one[at])),
                    pa.array(bw.signed(two[at])),
                ],
                names=["edge", "path", "place", "one", "two"],
            )

    return rows


def _cut(window: int, keys: list[str]):
    """Texts without the words of their repeated windows; a window is first + a set bit of mask."""

    def rows(batches):
        for batch in batches:
            texts, spans = column(batch, "text").to_pylist(), column(batch, "spans").to_pylist()
            total, removed, kept = [], [], []
            for text, marks in zip(texts, spans):
                words = (text or "").encode().split()
                total.append(len(words))
                if not marks:
                    removed.append(0)
                    kept.append(b" ".join(words))
                    continue
                first = np.array([m["first"] for m in marks], np.int64)
                mask = np.array([m["mask"] for m in marks], np.int64)
                change = np.zeros(len(words) + 1, np.int64)
                for bit in range(int(mask.max()).bit_length()):
                    at = first[(mask >> bit) & 1 == 1] + bit
                    np.add.at(change, at, 1)
                    np.add.at(change, at + window, -1)
                stays = np.cumsum(change[:-1]) == 0
                removed.append(len(words) - int(stays.sum()))
                kept.append(b" ".join(w for w, s in zip(words, stays.tolist()) if s))
            yield pa.RecordBatch.from_arrays(
                [
                    *(column(batch, name) for name in keys),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([k.decode() for k in kept], pa.string()),
                ],
                names=[*keys, "n_words", "n_removed", "kept"],
            )

    return rows


def remove_repeats(documents: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """Remove every word inside a window of `window` words that also starts anywhere else.

    Gives doc_id, n_words, n_removed and `kept`, the rest of the words joined by one blank. Words
    are runs without ASCII white space, compared unchanged; windows are judged on the input. A null
    or empty text has no words, one shorter than a window keeps all. Repeated rows are elsewhere to
    each other, so both lose their windows. An empty table gives no rows; other columns are ignored.
    """
    keyed = with_row_key(documents.select("doc_id", "text"))
    found = keyed.select("row_key", "text").mapInArrow(
        _occurrences(window, kmer),
        f"edge long, path long, row_key {keyed.schema['row_key'].dataType.simpleString()}, first long, windows int",
    )
    # Sides of joins that come out of an aggregation are staged: Spark splits the rows of a hot key
    # only if nothing else is computed in the joining stage.
    twice = stage(
        found.groupBy("edge").agg(F.count("*").alias("n")).where("n > 1").select("edge"), "twice"
    )
    repeated = stage(found.join(twice, "edge", "left_semi"), "edges")

    source = F.min(F.struct("row_key", "first", "windows")).alias("source")
    paths = stage(
        repeated.groupBy("edge", "path").agg(F.count("*").alias("n"), source), "paths"
    )
    branching = stage(
        paths.groupBy("edge").agg(F.count("*").alias("n")).where("n > 1").select("edge"), "branching"
    )
    to_open = (
        paths.join(branching, "edge", "left_semi")
        .select("source.row_key", F.struct("edge", "path", "source.first", "source.windows").alias("p"))
        .groupBy("row_key")
        .agg(F.collect_list("p").alias("paths"))
    )
    windows = stage(
        keyed.select("row_key", "text")
        .join(to_open, "row_key")
        .select("text", "paths")
        .mapInArrow(_opened(window), "edge long, path long, place int, one long, two long"),
        "windows",
    )
    shared = stage(
        windows.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two"),
        "shared",
    )
    # Windows of one path that lie in several texts are counted by the path's multiplicity; here a
    # window counts once for each path, and twice if its path reaches it twice.
    bits = (
        windows.join(shared, ["one", "two"], "left_semi")
        .groupBy("edge", "path")
        .agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))
    )
    masks = paths.join(bits, ["edge", "path"], "left").select(
        "edge",
        "path",
        F.when(F.col("n") > 1, F.expr("shiftleft(1L, source.windows) - 1"))
        .otherwise(F.coalesce("bits", F.lit(0).cast("long")))
        .alias("mask"),
    )
    masks = stage(masks.where("mask <> 0"), "masks")
    marks = (
        repeated.join(masks, ["edge", "path"])
        .groupBy("row_key")
        .agg(F.collect_list(F.struct("first", "mask")).alias("spans"))
    )
    return (
        keyed.join(marks, "row_key", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(
            _cut(window, ["doc_id"]),
            extended(documents.select("doc_id").schema, "n_words long, n_removed long, kept string"),
        )
    )


@query(r"""
WITH doc AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, unnest(generate_series(1, len(w) - 34)) AS i, w FROM doc WHERE len(w) >= 35),
h AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM win),
rep AS (SELECT s FROM h GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM h SEMI JOIN rep USING (s)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM doc),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)""")
def op10_debruijn(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
