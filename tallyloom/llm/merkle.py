"""Manifest of a dataset as a Merkle tree of threes per source: every row has a digest and a proof.

The tree is kept as a store of records (digest, children). It is built from below in segments of
LEVELS levels: a task gets the nodes of one segment and gives its records, the topmost of which is a
node of the segment above. Proofs come from above: requests enter a segment at its root, descend by
the digits of their rank through digest -> children, collect the children they do not take, and hand
that stretch of path to the segments below; a path read backwards is the proof. The subroots of the
sources are the leaves of one more tree, whose root stands for the whole dataset.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.base import crc32_sql, query, table
from tallyloom.session import stage

FAN = 3
#: Levels of a segment: up to FAN ** LEVELS nodes meet in one task.
LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Name of the tree whose leaves are the subroots; the tree of a source is named with a sign before it.
TOP = "/"

_PROOF = "array<struct<before: string, after: string>>"
_RECORDS = "tree string, round int, segment long, digest string, children array<string>, top boolean"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: tuple[Column, ...]) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, a colon and itself, or - if null."""
    return F.sha2(F.concat(*map(_field, columns)), 256)


def tree_name(source: Column) -> Column:
    """Name of a source's tree. In byte order null comes first and all others as the sources do."""
    return F.coalesce(F.concat(F.lit("+"), source), F.lit(""))


def _ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """The rows with `rank` within their tree by `order`, and `n`, the rows of the tree.

    Sorted by range into files; a part's rows are numbered as they stand, and sums of the counts per
    part and tree make the numbers run through. A tree of any size is spread over many parts.
    """
    parts = nodes.repartitionByRange("tree", *order, F.monotonically_increasing_id()).sortWithinPartitions("tree", *order)
    parts = stage(parts.withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33)
    counts = parts.groupBy("tree", part.alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("size"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("size").over(Window.partitionBy("tree")).alias("n"),
    )
    starts = stage(starts, "starts")  # a plain table, so that the join splits a hot source
    numbered = parts.withColumn("part", part).join(starts, ["tree", "part"])
    return numbered.withColumn("rank", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _segment(nodes: list[str], levels: int | None):
    """Records of the tree over the nodes, the topmost last: (digest, children). Goes up `levels`
    levels, or until one node remains."""
    found, done = {}, 0
    while done != levels and (levels is not None or len(nodes) > 1):
        runs = [nodes[i : i + FAN] for i in range(0, len(nodes), FAN)]
        nodes = [digest(run) for run in runs]
        for name, run in zip(nodes, runs):
            found.pop(name, None)
            found[name] = run
        done += 1
    return list(found.items())


def _segments(turn: int, levels: int):
    width = FAN**levels

    def records(key, nodes):
        tree, segment = (k.as_py() for k in key)
        nodes = nodes.sort_by("rank")
        whole = nodes["n"][0].as_py() > width
        found = _segment(nodes["digest"].to_pylist(), levels if whole else None)
        size = len(found)
        return pa.table(
            {
                "tree": [tree] * size,
                "round": pa.array([turn] * size, pa.int32()),
                "segment": pa.array([segment] * size, pa.int64()),
                "digest": [name for name, _ in found],
                "children": pa.array([run for _, run in found], pa.list_(pa.string())),
                "top": [i == size - 1 for i in range(size)],
            }
        )

    return records


@dataclass(frozen=True)
class Forest:
    """Trees over ranked nodes: the records of each round, lowest first, and the root of each tree."""

    rounds: list[DataFrame]
    roots: DataFrame


def grow(nodes: DataFrame, levels: int = LEVELS) -> Forest:
    """Build the trees over nodes (tree, rank, n, digest). A tree of one node is that node."""
    width = FAN**levels
    rounds, roots = [], nodes.where("n = 1").select("tree", "digest")
    while True:
        nodes = nodes.where("n > 1")
        grouped = nodes.withColumn("segment", F.floor(F.col("rank") / width)).groupBy("tree", "segment")
        made = grouped.applyInArrow(_segments(len(rounds), levels), _RECORDS)
        records = stage(made, "records")
        tops = records.where("top").select("tree", F.col("segment").alias("rank"), "digest")
        sizes = stage(
            nodes.where("rank = 0").select("tree", F.ceil(F.col("n") / width).cast("long").alias("n")), "sizes"
        )
        nodes = stage(tops.join(sizes, "tree"), "nodes")
        rounds.append(records)
        roots = roots.union(nodes.where("n = 1").select("tree", "digest"))
        if nodes.where("n > 1").isEmpty():
            return Forest(rounds, roots)


def _descend(levels: int, carried: list[str]):
    """Paths of the requests of one segment, nearest step first."""
    width = FAN**levels

    def paths(key, requests, held):
        uppers = [u for u in held["upper"].to_pylist() if u is not None]
        upper = max(uppers, key=len, default=[])
        far_before, far_after = [s["before"] for s in upper], [s["after"] for s in upper]
        children, top = {}, None
        for name, run, is_top in zip(*(held[c].to_pylist() for c in ("digest", "children", "top"))):
            if run is not None:
                children[name] = run
                top = name if is_top else top
        before, after, offsets = [], [], [0]
        for rank, n in zip(requests["rank"].to_pylist(), requests["n"].to_pylist()):
            path = []
            if n > 1:
                depth = next((d for d in range(1, levels) if FAN**d >= n), levels)
                node, place = top, rank % width
                for level in range(depth - 1, -1, -1):
                    run, digit = children[node], place // FAN**level % FAN
                    path.append(("".join(run[:digit]), "".join(run[digit + 1 :])))
                    node = run[digit]
            before += [b for b, _ in reversed(path)]
            after += [a for _, a in reversed(path)]
            before += far_before
            after += far_after
            offsets.append(len(before))
        steps = pa.StructArray.from_arrays(
            [pa.array(before, pa.string()), pa.array(after, pa.string())], names=["before", "after"]
        )
        proof = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps)
        return pa.table({name: requests[name] for name in carried} | {"proof": proof})

    return paths


def prove(forest: Forest, requests: DataFrame, above: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """The requests (tree, rank, n and any other columns) with `proof`: the siblings on the way from
    the node at that rank to the root, nearest first, then the steps of the tree in `above` (tree, upper).

    The requests of a segment meet its records and the path of its root in one task: at most
    FAN ** levels of each when no rank is asked twice. A path travels once per segment, not per request.
    """
    width = FAN**levels
    segment = F.floor(F.col("rank") / width)
    empty = requests.sparkSession.createDataFrame([], f"tree string, segment long, upper {_PROOF}")
    start = empty if above is None else above.select("tree", F.lit(0).cast("long").alias("segment"), "upper")
    known = empty  # paths of the roots of this round's segments
    for turn in range(len(forest.rounds) - 1, -1, -1):
        if turn:
            # What an upper round is asked for: the roots of the segments below.
            below = forest.rounds[turn - 1].where("top").select("tree", F.col("segment").alias("rank"))
            counts = stage(below.groupBy("tree").agg(F.count("*").alias("n")), "counts")
            asked = below.join(counts, "tree").where("n > 1")
        else:
            asked = requests
        held = forest.rounds[turn].select("tree", "segment", "digest", "children", "top")
        held = held.unionByName(known, allowMissingColumns=True).unionByName(start, allowMissingColumns=True)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema)
        found = (
            asked.groupBy("tree", segment.alias("segment"))
            .cogroup(held.groupBy("tree", "segment"))
            .applyInArrow(_descend(levels, asked.columns), f"{schema}, proof {_PROOF}")
        )
        if turn:
            known = stage(found.select("tree", F.col("rank").alias("segment"), F.col("proof").alias("upper")), "paths")
    return found


def folded(node: Column, proof: Column) -> Column:
    """The root that a node and its proof give."""
    return F.aggregate(
        proof, node, lambda below, step: F.sha2(F.concat(step["before"], below, step["after"]), 256)
    )


def siblings(proof: Column) -> Column:
    """The siblings of a proof in order, as one text."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


@dataclass(frozen=True)
class Manifest:
    """leaves: the rows given, with tree, rank and n; sources and top: the forests of the sources and
    of their subroots; ranked: the subroots with their places; root: digest of the dataset."""

    leaves: DataFrame
    sources: Forest
    top: Forest
    ranked: DataFrame
    root: str | None


def manifest(rows: DataFrame, levels: int = LEVELS) -> Manifest:
    """Trees over rows of (doc_id, source, leaf) and any other columns but tree, rank and n.

    Leaves of a source ascend by doc_id, null first; rows of one doc_id by leaf. Null is a source of
    its own, before all others. Repeated rows are leaves of their own, and which of them has which
    place cannot be told from the rows. An empty table has no root (null).
    """
    leaves = _ranked(rows.withColumn("tree", tree_name(F.col("source"))), ["doc_id", "leaf"])
    leaves = stage(leaves.withColumnRenamed("leaf", "digest"), "leaves")
    sources = grow(leaves.select("tree", "rank", "n", "digest"), levels)
    named = sources.roots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "digest")
    ranked = stage(_ranked(named, ["name"]), "subroots")
    top = grow(ranked.select("tree", "rank", "n", "digest"), levels)
    root = top.roots.first()
    return Manifest(leaves.withColumnRenamed("digest", "leaf"), sources, top, ranked, root and root["digest"])


def proofs(made: Manifest, requests: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """Rows of made.leaves (all, or those in `requests`) with subroot, root and `proof`."""
    upper = prove(made.top, made.ranked, levels=levels)
    above = stage(upper.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("proof").alias("upper")), "above")
    asked = (made.leaves if requests is None else requests).join(above.select("tree", "subroot"), "tree")
    found = prove(made.sources, asked, above.select("tree", "upper"), levels)
    return found.withColumn("root", F.lit(made.root))


def leaves(documents: DataFrame) -> DataFrame:
    """doc_id, source, leaf of each document, and `tampered`: the leaf after deletion of the text's
    line feeds where 2 divides crc32 of the decimal doc_id, else null."""
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    changed = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    other = leaf((*map(F.col, COLUMNS[:-1]), text))
    return documents.select(
        "doc_id", "source", leaf(tuple(map(F.col, COLUMNS))).alias("leaf"), F.when(changed, other).alias("tampered")
    )


@query(f"""
WITH RECURSIVE enc AS (SELECT doc_id, source, text, CAST(doc_id AS VARCHAR) AS id, concat_ws('',
    coalesce(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head
  FROM documents),
leaf AS (SELECT doc_id, coalesce('+' || source, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN {crc32_sql('id')} % 2 = 0
      THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS tampered
  FROM enc),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
    count(*) OVER (PARTITION BY tree) AS n FROM leaf),
low(tree, lvl, pos, n, digest) AS (SELECT tree, 0, rank, n, leaf FROM ranked
  UNION ALL SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
    FROM low WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
sub AS (SELECT tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS n FROM low WHERE n = 1),
high(lvl, pos, n, digest) AS (SELECT 0, rank, n, digest FROM sub
  UNION ALL SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
    FROM high WHERE n > 1 GROUP BY lvl, pos // 3, n),
step AS (SELECT r.tree, r.rank, 0 AS layer, w.lvl,
    coalesce(string_agg(w.digest, '' ORDER BY w.pos) FILTER (w.pos < r.rank // CAST(3 ** w.lvl AS BIGINT)), '') AS before,
    coalesce(string_agg(w.digest, '' ORDER BY w.pos) FILTER (w.pos > r.rank // CAST(3 ** w.lvl AS BIGINT)), '') AS after
  FROM ranked r JOIN low w ON w.tree = r.tree AND w.n > 1 AND w.pos // 3 = r.rank // CAST(3 ** (w.lvl + 1) AS BIGINT)
  GROUP BY r.tree, r.rank, w.lvl
  UNION ALL SELECT r.tree, r.rank, 1, w.lvl,
    coalesce(string_agg(w.digest, '' ORDER BY w.pos) FILTER (w.pos < s.rank // CAST(3 ** w.lvl AS BIGINT)), ''),
    coalesce(string_agg(w.digest, '' ORDER BY w.pos) FILTER (w.pos > s.rank // CAST(3 ** w.lvl AS BIGINT)), '')
  FROM ranked r JOIN sub s ON s.name = r.tree
    JOIN high w ON w.n > 1 AND w.pos // 3 = s.rank // CAST(3 ** (w.lvl + 1) AS BIGINT)
  GROUP BY r.tree, r.rank, w.lvl),
numbered AS (SELECT *, row_number() OVER (PARTITION BY tree, rank ORDER BY layer, lvl) AS k FROM step),
fold(tree, rank, k, digest) AS (SELECT tree, rank, 0, coalesce(tampered, leaf) FROM ranked
  UNION ALL SELECT f.tree, f.rank, f.k + 1, sha256(s.before || f.digest || s.after)
    FROM fold f JOIN numbered s ON s.tree = f.tree AND s.rank = f.rank AND s.k = f.k + 1),
proof AS (SELECT tree, rank, string_agg(before || after, '' ORDER BY k) AS proof FROM numbered GROUP BY tree, rank),
ended AS (SELECT tree, rank, max_by(digest, k) AS folded_root FROM fold GROUP BY tree, rank)
SELECT r.doc_id, r.leaf, s.digest AS subroot, h.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
  e.folded_root, e.folded_root = h.digest AS verified
FROM ranked r JOIN sub s ON s.name = r.tree JOIN (SELECT digest FROM high WHERE n = 1) h ON true
  JOIN ended e ON e.tree = r.tree AND e.rank = r.rank LEFT JOIN proof p ON p.tree = r.tree AND p.rank = r.rank""")
def op13_merkle(spark, sf_dir):
    made = manifest(leaves(table(spark, sf_dir, "documents")))
    ended = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return proofs(made).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
        ended.alias("folded_root"),
        (ended == F.col("root")).alias("verified"),
    )
