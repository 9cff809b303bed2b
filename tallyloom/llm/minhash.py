"""Near-duplicate classes by MinHash, with a Hamming join over several indexes.

A text is the set of its runs of two words. Its signature has CHUNKS x WIDTH minima of BITS bits.
By pigeonhole, two signatures that differ in at most CHUNKS * (ERRORS + 1) - 1 places differ in at
most ERRORS places of some chunk; so every chunk is indexed once for each choice of ERRORS places
left out, and all such pairs share a key. Sets under one key are linked with the most central of
them first; where a key still joins several classes, the rest of its pairs are compared too. A link
counts only if the full sets reach the similarity.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import bytewords as bw
from tallyloom.llm.base import column, query, table
from tallyloom.llm.components import components
from tallyloom.session import stage

SHINGLE = 2
#: Least similarity of a link, in hundredths.
ALIKE = 80
CHUNKS, WIDTH, ERRORS = 8, 7, 1
PLACES = CHUNKS * WIDTH
#: Signatures that differ in no more places than this meet under some key, always.
GUARANTEED = CHUNKS * (ERRORS + 1) - 1
#: Pairs that share a key but differ in more places are not read again: at similarity 0.8 the mean is
#: 11.2 with a deviation of 3, and one pair in 50,000 has more.
FAR = 24
#: Sets of a key, and their members, compared at a time; fuller keys are cut into blocks.
BLOCK = 4096
BLOCK_VALUES = 1 << 22
MARK_BITS = 1 << 23

_PART = 1024
_rng = np.random.default_rng(2024)
_FACTORS = _rng.integers(0, 1 << 31, PLACES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, PLACES, dtype=np.uint32)

#: For each chunk and each choice of places left out: the places kept.
_KEPT = [
    [chunk * WIDTH + i for i in range(WIDTH) if i not in out]
    for chunk in range(CHUNKS)
    for out in combinations(range(WIDTH), ERRORS)
]


def shingles(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of the different runs of `shingle` words of each text, lower-cased; a shorter
    text is one run, one without words has none."""
    words = bw.split_words(texts, bw.SOLID, lower=True)
    hashes = bw.hash_words(words)
    rolled = bw.roll(hashes, shingle)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        n = b - a
        if n >= shingle:
            out.append(np.unique(rolled[a : b - shingle + 1]))
        else:
            out.append(bw.roll(hashes[a:b], n) if n else np.empty(0, np.uint64))
    return out


def set_hash(values: np.ndarray) -> np.uint64:
    """Hash of a set of 64-bit values."""
    with np.errstate(over="ignore"):
        total = bw.mix(values).sum(dtype=np.uint64) + np.uint64(len(values))
    return bw.mix(np.array([total], np.uint64))[0]


def signature(values: np.ndarray) -> np.ndarray:
    """PLACES bytes: a byte of the least value of the set under each of as many hash functions."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(PLACES, np.iinfo(np.uint32).max, np.uint32)
    for a in range(0, len(short), _PART):
        hashed = _FACTORS[:, None] * short[a : a + _PART] + _SHIFTS[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return bw.mix(least.astype(np.uint64)).astype(np.uint8)


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """One row of keys per signature: the bytes kept, and which choice kept them."""
    out = np.empty((len(signatures), len(_KEPT)), np.uint64)
    for number, kept in enumerate(_KEPT):
        key = np.full(len(signatures), number, np.uint64)
        for place in kept:
            key = (key << np.uint64(8)) | signatures[:, place].astype(np.uint64)
        out[:, number] = key
    return out


SIGNED = "node long, size long, signature binary"


def signatures(batch: pa.RecordBatch, shingle: int) -> dict[str, pa.Array]:
    """node (hash of the set), size and signature of the set of each text."""
    sets = shingles(column(batch, "text"), shingle)
    nodes = np.array([set_hash(s) for s in sets], np.uint64)
    return {
        "node": pa.array(nodes.view(np.int64)),
        "size": pa.array([len(s) for s in sets], pa.int64()),
        "signature": pa.array([signature(s).tobytes() for s in sets], pa.binary()),
    }


def _signed_rows(batches):
    for batch in bw.chunks(batches):
        found = signatures(batch, SHINGLE)
        kept = {name: column(batch, name) for name in ("doc_id", "mark")}
        yield pa.RecordBatch.from_pydict(kept | found)


def _matrix(signatures: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), np.uint8).reshape(-1, PLACES)


def _index(batches):
    for batch in batches:
        keys = index_keys(_matrix(column(batch, "signature")))
        nodes = np.repeat(column(batch, "node").to_numpy(), keys.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.reshape(-1).view(np.int64)), pa.array(nodes)], names=["key", "node"]
        )


def _mark_field(wanted: DataFrame):
    """The marks wanted as a broadcast bit field of fixed size (1 MiB), folded to at most MARK_BITS / 64
    numbers before the driver. Full of marks it merely lets all texts pass; the join decides."""
    bits = wanted.select(F.col("mark").bitwiseAND(F.lit(MARK_BITS - 1)).alias("bit"))
    folded = F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")
    field = np.zeros(MARK_BITS // 64, np.int64)
    for row in bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(folded).collect():
        field[row["word"]] = row["bits"]
    return wanted.sparkSession.sparkContext.broadcast(field.view(np.uint64))


def _wanted_sets(field, shingle: int):
    """Sets of the texts whose mark may be wanted, as sorted 64-bit hashes."""

    def rows(batches):
        for batch in batches:
            bit = column(batch, "mark").to_numpy().view(np.uint64) & np.uint64(MARK_BITS - 1)
            on = field.value[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1) == 1
            batch = batch.filter(pa.array(on))
            for part in bw.chunks([batch]):
                sets = shingles(column(part, "text"), shingle)
                nodes = np.array([set_hash(s) for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes.view(np.int64)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "values"],
                )

    return rows


def _overlap(x: np.ndarray, y: np.ndarray) -> bool:
    """Two sorted sets reach the similarity."""
    small, big = (x, y) if len(x) < len(y) else (y, x)
    at = np.searchsorted(big, small)
    common = np.count_nonzero(big[np.minimum(at, len(big) - 1)] == small)
    return 100 * common >= ALIKE * (len(x) + len(y) - common)


def _alike(batches):
    """The pairs whose sets reach the similarity."""
    for batch in batches:
        kept = []
        for x, y in zip(column(batch, "one").to_pylist(), column(batch, "two").to_pylist()):
            kept.append(_overlap(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
        keep = pa.array(kept, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [column(batch, "a").filter(keep), column(batch, "b").filter(keep)], names=["a", "b"]
        )


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are links. One set travels with each pair, the other meets it."""
    one = sets.select(F.col("node").alias("a"), F.col("values").alias("one"))
    two = sets.select(F.col("node").alias("b"), F.col("values").alias("two"))
    both = pairs.join(two, "b").join(one, "a").select("a", "b", "one", "two")
    return stage(both.mapInArrow(_alike, "a long, b long"), "links")


def _possible(a, b):
    """A pair of sets with these sizes can reach the similarity."""
    return 100 * F.least(a, b) >= ALIKE * F.greatest(a, b)


class _Block:
    """Members of one block, and links from askers to them."""

    def __init__(self):
        self.parts, self.root, self.joined = [], None, {}

    def add(self, rows: pa.RecordBatch):
        self.parts.append(rows)

    def ask(self, rows: pa.RecordBatch) -> list[tuple[int, int]]:
        if not self.parts:
            return []
        if self.root is None:
            names = ("root", "node", "size")
            self.root, self.node, self.size = (np.concatenate([column(p, n).to_numpy() for p in self.parts]) for n in names)
            self.marks = np.concatenate([_matrix(column(p, "signature")) for p in self.parts])
            self.values = [v for p in self.parts for v in _sets(column(p, "values"))]
        links, marks = [], _matrix(column(rows, "signature"))
        asked = zip(*(column(rows, n).to_pylist() for n in ("node", "root", "size")), marks, _sets(column(rows, "values")))
        for node, root, size, mark, values in asked:
            while root in self.joined:
                root = self.joined[root]
            at = np.flatnonzero(self.root != root)
            low, high = np.minimum(self.size[at], size), np.maximum(self.size[at], size)
            at = at[100 * low >= ALIKE * high]
            far = (self.marks[at] != mark).sum(axis=1)
            order = np.argsort(far, kind="stable")[: np.count_nonzero(far <= FAR)]
            for j in at[order].tolist():
                other = int(self.root[j])
                if other != root and _overlap(values, self.values[j]):
                    links.append((node, int(self.node[j])))
                    self.root[self.root == other] = root
                    self.joined[other] = root
        return links


def _sets(values: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint64) for v in values]


def _across(batches):
    """Links that connect the classes of a block's askers and members. Rows come sorted by key, block
    and asks: members are held, askers pass by. What is connected already is not compared again, so
    there are fewer links than sets."""
    at, block = None, _Block()
    for batch in batches:
        if not batch.num_rows:
            continue
        where = np.stack([column(batch, n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("key", "block", "asks")])
        edges = (np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1).tolist()
        links = []
        for a, b in zip([0, *edges], [*edges, batch.num_rows]):
            key, number, asks = where[:, a].tolist()
            if at != (key, number):
                at, block = (key, number), _Block()
            if asks:
                links += block.ask(batch.slice(a, b - a))
            else:
                block.add(batch.slice(a, b - a))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.array(links).T], names=["a", "b"])


def _links_across(live: DataFrame, roots: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Links between sets that share a key and are in different classes. Under every key the largest
    class answers and the others ask; a key with many sets is cut into blocks, and every block hears
    all who ask. Keys with the same sets are compared once."""
    placed = live.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stage(placed.join(sets.select("node", "size"), "node").select("key", "node", "root", "size"), "placed")
    mixed = (
        placed.groupBy("key", "root")
        .agg(F.count("*").alias("n"), F.sum("size").alias("size"), *(F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"tag{i}") for i in (0, 1)))
        .groupBy("key")
        .agg(
            F.max(F.struct("n", "root")).alias("main"),
            F.sum("n").alias("n"),
            F.sum("size").alias("size"),
            F.count("*").alias("classes"),
            *(F.bit_xor(f"tag{i}").alias(f"tag{i}") for i in (0, 1)),
        )
        .where("classes > 1")
        .groupBy("tag0", "tag1", "n", "size")
        .agg(F.min(F.struct("key", "main.root")).alias("one"))
        .select(
            "one.key",
            F.col("one.root").alias("main"),
            F.ceil(F.greatest(F.col("n") / block, F.col("size") / BLOCK_VALUES)).alias("blocks"),
        )
    )
    rows = placed.join(stage(mixed, "mixed"), "key")
    home = F.array(F.pmod(F.xxhash64("node"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    members = rows.select("key", "node", "root", F.explode(home).alias("block"), F.lit(False).alias("asks"))
    askers = rows.where("root <> main").select(
        "key", "node", "root", F.explode(every).alias("block"), F.lit(True).alias("asks")
    )
    met = members.unionByName(askers).join(sets, "node")
    met = met.repartition("key", "block").sortWithinPartitions("key", "block", "asks")
    return stage(met.mapInArrow(_across, "a long, b long"), "across")


def marked(documents: DataFrame) -> DataFrame:
    """The documents with `mark`, a hash of id and text by which texts are found again."""
    return documents.withColumn("mark", F.xxhash64("doc_id", "text"))


def linked_sets(texts: DataFrame, different: DataFrame, shingle: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all sets connected by pairs that share a key and reach the similarity.

    `texts` are marked documents (mark, text), `different` has one row per set: node, mark of one of
    its texts, size and signature.
    """
    facts = different.select("node", "size", "signature")
    keyed = facts.mapInArrow(_index, "key long, node long")
    repeated = stage(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    live = stage(keyed.join(repeated, "key"), "live")
    # The set that meets most others leads a key.
    weights = stage(live.groupBy("node").agg(F.sum("n").alias("weight")), "weights")
    weighed = live.join(weights, "node")
    leaders = stage(weighed.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("leader")), "leaders")
    led = live.join(leaders, "key").select(F.col("leader.node").alias("x"), F.col("node").alias("y"))
    pairs = led.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    sizes = [different.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size")) for c in "ab"]
    pairs = pairs.join(sizes[0], "a").join(sizes[1], "b").where(_possible(F.col("a_size"), F.col("b_size")))
    pairs = stage(pairs.select("a", "b"), "pairs")

    wanted = stage(different.join(weights.select("node"), "node").select("mark", "node"), "wanted")
    found = texts.select("mark", "text").mapInArrow(_wanted_sets(_mark_field(wanted), shingle), "node long, values binary")
    # Repeated rows give one set several times: one of each stays.
    values = found.join(wanted.select("node"), "node").groupBy("node").agg(F.first("values").alias("values"))
    values = stage(values, "values")

    links = _links(pairs, values)
    held = stage(values.join(facts, "node"), "held")
    return links.union(_links_across(live.select("key", "node"), components(links), held, block))


def near_duplicates(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """Classes of documents connected by links: doc_id, n_shingles, component_id, kept.

    Lower-cases A-Z. A text of one word is a set of one; a text without words or a null one has the
    empty set, n_shingles 0, and is linked with nothing. component_id is the least doc_id of the
    class (null if it has none), kept is true where doc_id equals it. Repeated rows are rows of their
    own in one class, so rows that share the least doc_id are all kept. Equal sets are folded before
    anything is compared; sets are told apart by 64-bit hashes, and so are their members. Reads only
    doc_id and text, whatever other columns are called. Empty table: no rows.
    """
    texts = marked(documents.select("doc_id", "text"))
    sets = stage(texts.mapInArrow(_signed_rows, f"doc_id long, mark long, {SIGNED}"), "sets")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "mark")
    different = stage(
        sets.where("size > 0")
        .groupBy("node")
        .agg(F.min(first).alias("first"), F.first("size").alias("size"), F.first("signature").alias("signature"))
        .select("node", "first.doc_id", "first.mark", "size", "signature"),
        "different",
    )
    roots = components(linked_sets(texts, different, SHINGLE, block))
    rooted = different.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = stage(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    placed = stage(rooted.join(least, "root").select("node", "component_id"), "classes")
    full = sets.where("size > 0").join(placed, "node").select("doc_id", "size", "component_id")
    bare = sets.where("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    return full.union(bare).select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


@query(f"""
WITH RECURSIVE w AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, row, list_sort(list_distinct(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM w),
k AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) = 0 THEN 'row ' || row ELSE sha256(array_to_string(s, chr(10))) END AS node, s FROM s),
d AS (SELECT node, any_value(n) AS n, any_value(s) AS s FROM k WHERE n > 0 GROUP BY node),
u AS (SELECT node, n, unnest(s) AS shingle FROM d),
pair AS (SELECT a.node AS a, b.node AS b FROM u a JOIN u b ON a.shingle = b.shingle AND a.node <> b.node
    AND 100 * least(a.n, b.n) >= {ALIKE} * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {ALIKE} * (a.n + b.n - count(*))),
reach(node, other) AS (SELECT node, node FROM d UNION SELECT r.node, p.b FROM reach r JOIN pair p ON p.a = r.other),
class AS (SELECT r.node, min(k.doc_id) AS component_id FROM reach r JOIN k ON k.node = r.other GROUP BY r.node)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, CASE WHEN k.n = 0 THEN k.doc_id ELSE c.component_id END AS component_id,
  k.doc_id IS NOT DISTINCT FROM CASE WHEN k.n = 0 THEN k.doc_id ELSE c.component_id END AS kept
FROM k LEFT JOIN class c ON c.node = k.node""")
def op12_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
