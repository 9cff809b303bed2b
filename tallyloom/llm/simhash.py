"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint gets a nonzero vector of radius + 1 bits. For every nonzero vector v the mask
keeps the bits whose vector has an odd inner product with v. The vectors of `radius` differing bits
cannot span the whole space, so some v is orthogonal to all of them and its mask drops them all: a
pair within the radius agrees on at least one masked key, with no chance involved.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import bytewords as bw
from tallyloom.llm.base import column, extended, query, table, with_row_key
from tallyloom.llm.components import components
from tallyloom.session import stage

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
#: Different fingerprints under one key up to which they are compared with each other; beyond it
#: the key's fingerprints meet through their neighbours instead, which is linear in their number.
CROWD = 4096
#: Crowded keys up to which their list is broadcast (16 bytes each).
CROWDED_KEYS = 100_000

_BLOCK = 1 << 16


def covering_masks(radius: int = RADIUS) -> list[int]:
    space = 1 << (radius + 1)
    vectors = [1 + i % (space - 1) for i in range(BITS)]
    return [
        sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() & 1)
        for v in range(1, space)
    ]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    words = (text or "").encode().translate(bw.LOWER.tobytes()).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    counts = np.zeros(BITS, np.int64)
    for a in range(0, len(starts), _BLOCK):
        pieces = map(slice, starts[a : a + _BLOCK].tolist(), ends[a : a + _BLOCK].tolist())
        hashes = map(xxhash.xxh64_intdigest, map(joined.__getitem__, pieces), repeat(SEED))
        bits = np.fromiter(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    ones = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(ones.view(np.uint64)[0])


def fingerprints(df: DataFrame) -> DataFrame:
    """The rows with `fingerprint` (as a signed long) in place of `text`."""

    def rows(batches):
        for batch in batches:
            found = [fingerprint(text) for text in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(column(batch, name) for name in keys),
                    pa.array(np.array(found, np.uint64).view(np.int64)),
                ],
                names=[*keys, "fingerprint"],
            )

    keys = [name for name in df.columns if name != "text"]
    return df.mapInArrow(rows, extended(df.drop("text").schema, "fingerprint long"))


def _linked(values: np.ndarray, ends: np.ndarray, radius: int):
    """Links within runs of equal key that connect all that is within the radius.

    Compares each value with the d-th after it for d = 1, 2, ... and keeps a link only if its two
    sides are not connected yet, so about one link is kept per value.
    """
    label = np.arange(len(values))
    at = np.arange(len(values))
    left, right = [], []
    d = 1
    while True:
        at = at[at + d < ends[at]]
        if not len(at):
            break
        near = np.bitwise_count(values[at] ^ values[at + d]) <= radius
        a, b = label[at[near]], label[at[near] + d]
        new = a != b
        if new.any():
            left.append(values[at[near][new]])
            right.append(values[at[near][new] + d])
            low, high = np.minimum(a[new], b[new]), np.maximum(a[new], b[new])
            np.minimum.at(label, high, low)
            while not np.array_equal(label, jumped := label[label]):
                label = jumped
        d += 1
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def _compare(radius: int):
    """Links within the buckets of a partition sorted by (probe, key)."""

    def rows(batches):
        held = None
        for batch in batches:
            probe = column(batch, "probe").to_numpy()
            key = column(batch, "key").to_numpy()
            value = column(batch, "fingerprint").to_numpy().view(np.uint64)
            if held is not None:
                probe, key, value = (np.concatenate(x) for x in zip(held, (probe, key, value)))
            change = np.flatnonzero((probe[1:] != probe[:-1]) | (key[1:] != key[:-1])) + 1
            last = change[-1] if len(change) else 0
            held = probe[last:], key[last:], value[last:]
            yield from found(value[:last], change)
        if held is not None:
            yield from found(held[2], np.array([len(held[2])]))

    def found(value, borders):
        if len(value) > 1:
            sizes = np.diff(np.concatenate(([0], borders)))
            a, b = _linked(value, np.repeat(borders, sizes), radius)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
                )

    return rows


def _neighbours(masks: list[int], radius: int):
    """Variants of crowded fingerprints on the bits their mask drops: a pair at distance d meets at
    a variant that is at most floor(d / 2) flips from one and at most ceil(d / 2) from the other."""
    from itertools import combinations

    near, far = radius // 2, radius - radius // 2
    flips = []
    for mask in masks:
        free = [i for i in range(BITS) if not mask >> i & 1]
        sets = [c for n in range(far + 1) for c in combinations(free, n)]
        flips.append(
            (
                np.array([sum(1 << i for i in c) for c in sets], np.uint64),
                np.array([len(c) <= near for c in sets]),
            )
        )

    def rows(batches):
        for batch in batches:
            probe = column(batch, "probe").to_numpy()
            value = column(batch, "fingerprint").to_numpy().view(np.uint64)
            for p, v in zip(probe.tolist(), value):
                change, close = flips[p]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(change), p, np.int32)),
                        pa.array((change ^ v).view(np.int64)),
                        pa.array(close),
                        pa.array(np.full(len(change), v, np.uint64).view(np.int64)),
                    ],
                    names=["probe", "variant", "close", "fingerprint"],
                )

    return rows


def links(distinct: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect exactly what pairs within the radius connect.

    `distinct` has one row per different fingerprint. Keys of at most `crowd` fingerprints are
    compared directly; those of more by shared variants, where every one that reaches a variant is
    linked with the least that reaches it by few flips. No key's pairs are ever listed.
    """
    masks = covering_masks(radius)
    probes = F.explode(F.array(*(F.struct(F.lit(p).alias("probe"), F.lit(_signed(m)).alias("mask")) for p, m in enumerate(masks))))
    keyed = distinct.select("fingerprint", probes.alias("m")).select(
        F.col("m.probe").alias("probe"),
        F.col("fingerprint").bitwiseAND(F.col("m.mask")).alias("key"),
        "fingerprint",
    )
    crowded = stage(
        keyed.groupBy("probe", "key").count().where(F.col("count") > crowd).select("probe", "key"),
        "crowded",
    )
    n = crowded.count()
    if n == 0:
        calm, full = keyed, None
    else:
        side = F.broadcast(crowded) if n <= CROWDED_KEYS else crowded
        calm = keyed.join(side, ["probe", "key"], "left_anti")
        full = keyed.join(side, ["probe", "key"], "left_semi")
    found = (
        calm.repartition("probe", "key")
        .sortWithinPartitions("probe", "key")
        .mapInArrow(_compare(radius), "a long, b long")
    )
    if full is None:
        return found
    variants = full.mapInArrow(
        _neighbours(masks, radius), "probe int, variant long, close boolean, fingerprint long"
    )
    centres = (
        variants.where("close").groupBy("probe", "variant").agg(F.min("fingerprint").alias("b"))
    )
    met = variants.join(centres, ["probe", "variant"]).select(F.col("fingerprint").alias("a"), "b")
    return found.union(met.where("a <> b").distinct())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_duplicates(documents: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Group the rows whose fingerprints are connected by steps of at most `radius` bits.

    Gives row_key, doc_id, fingerprint, component_id (least doc_id of the group) and `keeper`, true
    for one row of each group: the one with component_id, among repeated rows the first. Null and
    empty texts have fingerprint zero and are linked like any other. Null doc_ids are ignored by
    component_id (null if a group has no other) and kept last. Equal fingerprints are folded before
    anything is compared, so a group of copies of any size is one row there. Empty table: no rows.
    """
    rows = stage(fingerprints(with_row_key(documents.select("doc_id", "text"))), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_key")
    by_print = rows.groupBy("fingerprint").agg(F.min(first).alias("first"))
    roots = components(links(by_print.select("fingerprint"), radius, crowd))
    rooted = by_print.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    groups = rooted.groupBy("root").agg(F.min("first").alias("least"))
    placed = rooted.select("fingerprint", "root").join(groups, "root").select("fingerprint", "least")
    placed = stage(placed, "groups")  # a plain table, so that the join below splits hot fingerprints
    return rows.join(placed, "fingerprint").select(
        "row_key",
        "doc_id",
        "fingerprint",
        F.col("least.doc_id").alias("component_id"),
        (F.col("row_key") == F.col("least.row_key")).alias("keeper"),
    )


@query()
def op7_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )
