"""Near copies by resemblance: texts whose sets of five-word runs reach a Jaccard similarity of 0.8.

Candidates and links are those of the MinHash operator, for longer runs: every pair that shares a key
counts, however many sets do, and full sets decide. A pair at 0.8 shares no key with a chance of
(1 - P)^8 < 0.002, P being that of at most one difference in seven places. Groups are connected by
these links, and by the pairs within the radius of the SimHash operator, whose links are taken as
they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import bytewords as bw
from tallyloom.llm import minhash, simhash
from tallyloom.llm.base import column, extended, with_row_key
from tallyloom.llm.components import components
from tallyloom.session import stage

SHINGLE = 5


def shingles(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    return minhash.shingles(texts, shingle)


def _rows(batches):
    for batch in bw.chunks(batches):
        kept = {name: column(batch, name) for name in ("row_key", "doc_id", "mark")}
        prints = [simhash.fingerprint(text) for text in column(batch, "text").to_pylist()]
        prints = pa.array(np.array(prints, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_pydict(kept | {"fingerprint": prints} | minhash.signatures(batch, SHINGLE))


def _print_edges(sets: DataFrame) -> DataFrame:
    """Links of the SimHash operator, between one set of each fingerprint; sets under one fingerprint
    are linked with that one."""
    seen = stage(sets.select("node", "fingerprint").distinct(), "prints")
    one = stage(seen.groupBy("fingerprint").agg(F.min("node").alias("least")), "one-set")
    same = seen.join(one, "fingerprint").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    near = stage(simhash.links(one.select("fingerprint")), "links")
    a = one.select(F.col("fingerprint").alias("a"), F.col("least").alias("x"))
    b = one.select(F.col("fingerprint").alias("b"), F.col("least").alias("y"))
    far = near.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    return same.union(far)


def near_copies(documents: DataFrame, block: int = minhash.BLOCK) -> DataFrame:
    """Group the rows connected by pairs of texts with Jaccard similarity of at least 0.8, or with
    fingerprints within the SimHash operator's radius.

    Gives row_key, doc_id, component_id and `keeper` as simhash.near_duplicates does. Texts without
    words are copies of each other. Equal sets are folded before anything is compared.
    """
    texts = minhash.marked(with_row_key(documents.select("doc_id", "text")))
    schema = extended(texts.select("row_key", "doc_id", "mark").schema, f"fingerprint long, {minhash.SIGNED}")
    sets = stage(texts.mapInArrow(_rows, schema), "sets")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_key", "mark")
    by_set = stage(
        sets.groupBy("node").agg(F.min(first).alias("first"), F.first("size").alias("size"),
                                 F.first("signature").alias("signature")),
        "different",
    )
    different = by_set.where("size > 0").select("node", "first.mark", "size", "signature")
    links = minhash.linked_sets(texts, different, SHINGLE, block)
    roots = components(links.union(_print_edges(sets)))
    rooted = by_set.select("node", "first").join(roots, "node", "left").select(
        "node", "first", F.coalesce("root", "node").alias("root")
    )
    groups = stage(rooted.groupBy("root").agg(F.min("first").alias("least")), "roots")
    placed = stage(rooted.join(groups, "root").select("node", "least"), "groups")
    return sets.select("row_key", "doc_id", "node").join(placed, "node").select(
        "row_key",
        "doc_id",
        F.col("least.doc_id").alias("component_id"),
        (F.col("row_key") == F.col("least.row_key")).alias("keeper"),
    )
