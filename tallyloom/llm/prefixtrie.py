"""Prefix trie of conversations, kept as balanced parentheses per shard.

A conversation is the sequence of its turns' digests, 16 bytes each, so that the byte order of whole
sequences is the order in which a depth-first walk meets them. Sequences are dealt to shards by
range; a shard writes its part of the trie as parentheses, "(" where the walk enters a node and ")"
where it leaves, with per-node arrays in the order of entering. Everything about a subtree is then
found by closing parentheses: its nodes are neighbours in those arrays, its leaves the pairs "()"
between, its sums differences of running totals. Shards meet on the paths of their first and last
sequence only (their spines); what lies there is merged by the digest of the path.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.base import column, crc32_sql, query, table
from tallyloom.session import stage

#: Conversations of a family share the first turns of the one whose conv_id the family is named by.
FAMILY = 20
#: A conversation takes over fewer turns than this.
HEADS = 4
DIGEST = 16
#: Parentheses per block of the excess tree.
BLOCK = 256
#: Leading bytes of a sequence by which shards are cut.
CUT = 64 * DIGEST
#: Bytes of sequences that a task folds at a time.
FOLD = 32 << 20

NOTHING = sha256(b"").hexdigest()
_SEQUENCES = "seq binary, words binary, ids binary, least long"
_SHARDS = (
    "shard long, nodes long, parens binary, lows binary, words binary, depths binary, ended binary, "
    "members binary, least binary, spine binary, last binary, digests array<string>, keys array<string>"
)
_NODES = (
    "shard long, node long, parent long, key string, parent_key string, on_first boolean, on_last boolean, "
    "words long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, digest string"
)


class Parentheses:
    """Balanced parentheses with the least excess of every block, and of pairs of blocks above."""

    def __init__(self, opens: np.ndarray, lows: np.ndarray | None = None):
        self.opens = opens.astype(bool)
        self.excess = np.cumsum(np.where(self.opens, 1, -1))
        blocks = -(-len(opens) // BLOCK)
        self.leaves = 1 << max(0, (blocks - 1).bit_length())
        if lows is None:
            padded = np.full(self.leaves * BLOCK, np.iinfo(np.int64).max)
            padded[: len(opens)] = self.excess
            lows = np.empty(2 * self.leaves, np.int64)
            lows[self.leaves :] = padded.reshape(-1, BLOCK).min(axis=1)
            for i in range(self.leaves - 1, 0, -1):
                lows[i] = min(lows[2 * i], lows[2 * i + 1])
            lows[0] = lows[1] if self.leaves > 1 else lows[-1]
        self.lows = lows
        self.pairs = np.concatenate(([0], np.cumsum(self.opens[:-1] & ~self.opens[1:]))) if len(opens) else np.zeros(1, int)
        self.ranks = np.concatenate(([0], np.cumsum(self.opens)))

    def _within(self, block: np.ndarray, start: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """First place from start on in the block where the excess is below the goal, else -1."""
        out = np.full(len(block), -1)
        for a in range(0, len(block), 4096):
            part = slice(a, a + 4096)
            places = block[part, None] * BLOCK + np.arange(BLOCK)
            safe = np.minimum(places, len(self.excess) - 1)
            hit = (places >= start[part, None]) & (places < len(self.excess)) & (self.excess[safe] < goal[part, None])
            first = hit.argmax(axis=1)
            rows = np.arange(len(first))
            out[part] = np.where(hit[rows, first], places[rows, first], -1)
        return out

    def find_close(self, places: np.ndarray) -> np.ndarray:
        """The parenthesis that closes the one at each place: the first after it with less excess.

        Looks in the block of the opening one, else climbs the tree of least excesses until a later
        block goes low enough and comes down to the first such block.
        """
        goal = self.excess[places]
        out = self._within(places // BLOCK, places + 1, goal)
        far = np.flatnonzero(out < 0)
        if len(far):
            node, want = places[far] // BLOCK + self.leaves, goal[far]
            going = np.ones(len(far), bool)
            while going.any():
                turn = going & (node % 2 == 0)
                turn[turn] = self.lows[node[turn] + 1] < want[turn]
                node[turn] += 1
                going &= ~turn
                node[going] //= 2
            while (below := node < self.leaves).any():
                left = 2 * node[below]
                node[below] = np.where(self.lows[left] < want[below], left, left + 1)
            block = node - self.leaves
            out[far] = self._within(block, block * BLOCK, want)
        return out

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Opening parentheses before each place."""
        return self.ranks[places]

    def leaves_between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs "()" that begin at a or later and end at b or earlier."""
        return self.pairs[b] - self.pairs[a]


def range_minimum(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of values[a:b] for every pair of borders, a < b."""
    size = len(values)
    tree = np.concatenate((values, values))
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    out = np.full(len(a), np.iinfo(np.int64).max)
    low, high = a + size, b + size
    while (on := low < high).any():
        odd = on & (low % 2 == 1)
        out[odd] = np.minimum(out[odd], tree[low[odd]])
        low[odd] += 1
        odd = on & (high % 2 == 1)
        high[odd] -= 1
        out[odd] = np.minimum(out[odd], tree[high[odd]])
        low //= 2
        high //= 2
    return out


def _turns(conversations: DataFrame) -> DataFrame:
    """One narrow row per turn: family, conv_id, turn, digest of role and text, words of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"),
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.substring(whole, 1, 2 * DIGEST)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        (F.crc32(F.col("conv_id").cast("long").cast("string")) % HEADS).cast("int").alias("heads"),
    )


def _rebuild(batches):
    """Whole sequences of rows sorted by family (its first member leading), conversation and turn;
    equal ones are folded to one row."""
    folded: dict[bytes, list] = {}
    size = 0
    family, conv, head, seq, words, own, heads = None, None, [], bytearray(), [], 0, 0

    def close():
        nonlocal size
        known = folded.get(bytes(seq))
        if known is None:
            known = folded[bytes(seq)] = [np.array(words, np.int64).tobytes(), []]
            size += len(seq) + 8 * len(words)
        known[1].append(conv)
        size += 8

    def rows():
        ids = [np.sort(np.array(x[1], np.int64)) for x in folded.values()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(folded), pa.binary()),
                pa.array([x[0] for x in folded.values()], pa.binary()),
                pa.array([i.tobytes() for i in ids], pa.binary()),
                pa.array([int(i[0]) for i in ids], pa.int64()),
            ],
            names=["seq", "words", "ids", "least"],
        )

    for batch in batches:
        columns = (column(batch, name).to_pylist() for name in ("family", "conv_id", "digest", "words", "heads"))
        for group, who, digest, count, take in zip(*columns):
            if who != conv:
                if conv is not None:
                    close()
                    if size > FOLD:
                        yield rows()
                        folded.clear()
                        size = 0
                if group != family:
                    family, head = group, []
                conv, own, heads = who, 0, take
                known = head[:heads] if who != group else []
                seq, words = bytearray(b"".join(d for d, _ in known)), [w for _, w in known]
            if who == group and own < HEADS - 1:
                head.append((digest, count))
            if who == group or own >= heads:
                seq += digest
                words.append(count)
            own += 1
    if conv is not None:
        close()
    if folded:
        yield rows()


def sequences(conversations: DataFrame) -> DataFrame:
    """Rebuilt conversations as digests of turns: seq, words, ids (of all that have it, ascending) and
    the least id. Each task folds its equal ones; one sequence may come from several tasks.

    A conversation begins with the first h turns of the one that names its family (conv_id less its
    remainder by 20; fewer if that has fewer, none if it is absent) and goes on with its own after its
    first h, h being crc32 of the decimal conv_id modulo 4. Turns are ordered by number, null first;
    turns of one number by digest, so repeated rows stay. Rows without a conv_id belong to nothing.
    """
    turns = _turns(conversations)
    leads = (F.col("conv_id") != F.col("family")).alias("later")
    order = ["family", "later", "conv_id", F.col("turn").asc_nulls_first(), "digest"]
    sorted_ = turns.select("*", leads).repartitionByRange("family").sortWithinPartitions(*order)
    return sorted_.select("family", "conv_id", "digest", "words", "heads").mapInArrow(_rebuild, _SEQUENCES)


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with alike."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * DIGEST] == b[: middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


def _keys(seq: bytes) -> list[str]:
    """Digests of all beginnings of a sequence, the empty one first."""
    told, out = sha256(), []
    for a in range(0, len(seq) + DIGEST, DIGEST):
        out.append(told.hexdigest())
        told.update(seq[a : a + DIGEST])
    return out


def _ending(ids: list[np.ndarray]) -> tuple[int, int, str]:
    """Number, least and digest of the members that end at a node."""
    members, told = np.sort(np.concatenate(ids)), sha256()
    for a in range(0, len(members), 1 << 16):
        told.update(("," if a else "").encode() + ",".join(map(str, members[a : a + (1 << 16)].tolist())).encode())
    return len(members), int(members[0]), told.hexdigest()


def _encode(batches):
    """The shard of the sorted sequences of a partition, as one row."""
    parens, words, depths = [np.ones(1, bool)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    ended, endings, ids = [], [], []
    first, before, path, n, shard = None, None, [0], 1, None

    for batch in batches:
        names = ("shard", "seq", "words", "ids")
        for shard, seq, counts, own in zip(*(column(batch, c).to_pylist() for c in names)):
            if seq == before:
                ids.append(np.frombuffer(own, np.int64))
                continue
            if before is None:
                first, common, last = seq, 0, 0
            else:
                ended.append(path[-1])
                endings.append(_ending(ids))
                common, last = _shared(before, seq), len(before) // DIGEST
            new = len(seq) // DIGEST - common
            parens.append(np.repeat([False, True], [last - common, new]))
            words.append(np.frombuffer(counts, np.int64)[common:])
            depths.append(np.arange(common + 1, common + new + 1))
            path[common + 1 :] = range(n, n + new)
            n += new
            before, ids = seq, [np.frombuffer(own, np.int64)]
    if before is None:
        return
    ended.append(path[-1])
    endings.append(_ending(ids))
    parens.append(np.zeros(len(path), bool))
    opens = np.concatenate(parens)
    tree = Parentheses(opens)
    spine = {**dict(enumerate(_keys(first))), **dict(zip(path, _keys(before)))}
    arrays = {
        "parens": np.packbits(opens),
        "lows": tree.lows,
        "words": np.concatenate(words),
        "depths": np.concatenate(depths),
        "ended": np.array(ended),
        "members": np.array([x[0] for x in endings]),
        "least": np.array([x[1] for x in endings]),
        "spine": np.array(list(spine)),
        "last": np.array(path),
    }
    row = {name: pa.array([values.tobytes()], pa.large_binary()) for name, values in arrays.items()}
    yield pa.RecordBatch.from_pydict(
        {
            "shard": pa.array([shard], pa.int64()),
            "nodes": pa.array([n], pa.int64()),
            **{name: values.cast(pa.binary()) for name, values in row.items()},
            "digests": pa.array([[x[2] for x in endings]], pa.list_(pa.string())),
            "keys": pa.array([list(spine.values())], pa.list_(pa.string())),
        }
    )


def encode(folded: DataFrame) -> DataFrame:
    """Shards of the trie over `sequences`: one row each, of arrays as bytes.

    parens (bits), lows (least excesses), words and depths per node in order of entering; ended,
    members, least and digests of the nodes where conversations end; spine, keys and last: the nodes
    on the first and last path, the digests of their paths, and those of the last path. Shards are cut
    by the first 64 turns, so only sequences that agree in more are bound to one shard.
    """
    cut = F.substring("seq", 1, CUT)
    dealt = stage(folded, "sequences").repartitionByRange(cut)
    dealt = dealt.withColumn("shard", F.spark_partition_id().cast("long")).sortWithinPartitions("seq", "least")
    return stage(dealt.select("shard", "seq", "words", "ids").mapInArrow(_encode, _SHARDS), "shards")


def _nodes(batches):
    """Nodes of each shard, those on its spines with sums of what lies beside the spines."""
    for batch in batches:
        for row in batch.to_pylist():
            yield from _shard_nodes(row)


def _shard_nodes(row: dict):
    n = row["nodes"]
    numbers = {name: np.frombuffer(row[name], np.int64) for name in ("lows", "words", "depths", "ended", "members", "least", "spine", "last")}
    tree = Parentheses(np.unpackbits(np.frombuffer(row["parens"], np.uint8), count=2 * n), numbers["lows"])
    places = np.flatnonzero(tree.opens)
    closes = tree.find_close(places)
    begin, end = tree.rank(places), tree.rank(closes)
    leaf = closes == places + 1

    members, least = np.zeros(n + 1, np.int64), np.full(n, np.iinfo(np.int64).max)
    members[numbers["ended"] + 1] = numbers["members"]
    least[numbers["ended"]] = numbers["least"]
    running = np.cumsum(members)
    convs = running[end] - running[begin]
    smallest = range_minimum(least, begin, end)

    inner = np.ones(n, bool)
    inner[numbers["spine"]] = False
    own = np.where(inner, (convs - 1) * numbers["words"], 0)
    running = np.concatenate(([0], np.cumsum(own)))
    saved = running[end] - running[begin]
    running = np.concatenate(([0], np.cumsum(leaf & ~inner)))
    leaves = tree.leaves_between(places, closes) - (running[end] - running[begin])

    # Sorted by depth (stably), a node's parent is the last one above it that was entered before it.
    depths, parent = numbers["depths"], np.full(n, -1)
    order = np.argsort(depths, kind="stable")
    borders = np.searchsorted(depths[order], np.arange(depths.max() + 2))
    for a, b, c in zip(borders[:-2], borders[1:-1], borders[2:]):
        parent[order[b:c]] = order[a + np.searchsorted(order[a:b], order[b:c]) - 1]
    children = np.bincount(parent[1:][inner[1:]], minlength=n)

    digests, keys = np.full(n, None, object), np.full(n, None, object)
    digests[numbers["ended"]] = row["digests"]
    keys[numbers["spine"]] = row["keys"]
    on_last = np.zeros(n, bool)
    on_last[numbers["last"]] = True
    on_first = ~inner & (np.arange(n) == depths)
    above = parent.clip(0)
    known = inner & inner[above] & (parent >= 0)
    for a in range(0, n, 1 << 16):
        part = slice(a, a + (1 << 16))
        yield pa.RecordBatch.from_pydict(
            {
                "shard": np.full(len(depths[part]), row["shard"]),
                "node": np.arange(n)[part],
                "parent": parent[part],
                "key": pa.array(keys[part], pa.string()),
                "parent_key": pa.array(np.where(parent[part] >= 0, keys[above][part], None), pa.string()),
                "on_first": on_first[part],
                "on_last": on_last[part],
                "words": numbers["words"][part],
                "conv_id": smallest[part],
                "depth": depths[part],
                "parent_conv_id": pa.array(smallest[above][part], mask=~known[part]),
                "n_convs": convs[part],
                "n_children": children[part],
                "n_leaves": leaves[part],
                "saved_tokens": saved[part],
                "digest": pa.array(digests[part], pa.string()),
            }
        )


_OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def _merged_spines(spines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes on spines, merged, and for every shard its spine nodes with the merged conv_id."""
    merged = spines.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent_key").alias("parent_key"),
        F.max("words").alias("words"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("beside"),
        F.max("digest").alias("digest"),
        F.min("shard").alias("owner"),
    )
    merged = stage(merged, "merged")
    below = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("along"))
    merged = merged.join(below, "key", "left").withColumn("n_children", F.col("beside") + F.coalesce("along", F.lit(0)))
    merged = stage(merged.drop("beside", "along"), "merged")

    # A merged node counts once, in the shard that owns it, for itself and all above it there.
    totals = merged.select(
        "key",
        "owner",
        F.col("conv_id").alias("least"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
        (F.col("n_children") == 0).cast("long").alias("own_leaf"),
    )
    placed = stage(spines.join(totals, "key"), "spines")
    owned = F.col("shard") == F.col("owner")
    deeper = Window.partitionBy("shard").orderBy(F.desc("depth"))

    def path_sum(own: str) -> Column:
        def along(*on: Column) -> Column:
            want = owned
            for condition in on:
                want = want & condition
            return F.coalesce(F.sum(F.when(want, F.col(own))).over(deeper), F.lit(0))

        first, last = F.col("on_first"), F.col("on_last")
        return F.when(first & last, along()).when(first, along(first)).otherwise(along(last))

    summed = (
        placed.withColumn("saved_tokens", F.col("saved_tokens") + path_sum("own_saved"))
        .withColumn("n_leaves", F.col("n_leaves") + path_sum("own_leaf"))
        .groupBy("key")
        .agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    )
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    whole = merged.join(summed, "key").join(parents, "parent_key", "left")
    return whole.select(*_OUT, "digest"), placed.select("shard", F.col("node").alias("parent"), "least")


def nodes(shards: DataFrame) -> DataFrame:
    """Every node of the trie: conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. No conversations, no nodes."""
    found = stage(shards.mapInArrow(_nodes, _NODES), "nodes")
    merged, heads = _merged_spines(found.where("key IS NOT NULL"))
    inner = found.where("key IS NULL")
    alone = inner.where("parent_key IS NULL").select(*_OUT, "digest")
    attached = inner.where("parent_key IS NOT NULL").drop("parent_conv_id").join(heads, ["shard", "parent"])
    attached = attached.withColumnRenamed("least", "parent_conv_id").select(*_OUT, "digest")
    ends = F.coalesce("digest", F.lit(NOTHING)).alias("ends_sha256")
    return alone.unionByName(attached).unionByName(merged).select(*_OUT, ends)


@query(f"""
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS c, coalesce(text, '') AS text,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, digest, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS d FROM t),
h AS (SELECT c, c - c % {FAMILY} AS family, {crc32_sql('CAST(c AS VARCHAR)')} % {HEADS} AS heads FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT h.c, o.d AS k, o.digest, o.words FROM h JOIN o ON o.c = h.family AND o.d <= h.heads
  UNION ALL SELECT h.c, o.d, o.digest, o.words FROM h JOIN o ON o.c = h.c AND o.d > h.heads),
p AS (SELECT c, row_number() OVER w AS d, words, sha256(string_agg(digest, '') OVER (PARTITION BY c ORDER BY k)) AS node
  FROM r WINDOW w AS (PARTITION BY c ORDER BY k)),
m AS (SELECT c, d, words, node, lag(node, 1, 'root') OVER (PARTITION BY c ORDER BY d) AS parent,
    d = max(d) OVER (PARTITION BY c) AS last FROM p
  UNION ALL SELECT c, 0, 0, 'root', NULL, c NOT IN (SELECT c FROM p) FROM h),
n AS (SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs,
    any_value(words) * (count(*) - 1) AS own,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256 FROM m GROUP BY node),
k AS (SELECT parent, count(*) AS n_children FROM n GROUP BY parent),
under AS (SELECT a.node, sum(b.own) AS saved, count(*) FILTER (q.n_children IS NULL) AS leaves
  FROM n b JOIN m a ON a.c = b.conv_id AND a.d <= b.depth LEFT JOIN k q ON q.parent = b.node GROUP BY a.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs,
  coalesce(k.n_children, 0) AS n_children, u.leaves AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN under u ON u.node = n.node LEFT JOIN n up ON up.node = n.parent LEFT JOIN k ON k.parent = n.node""")
def op11_prefix_trie(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return nodes(encode(sequences(conversations)))
