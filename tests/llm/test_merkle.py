import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import merkle as mk


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def enc(*values):
    return ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]


def brute(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root) of each row."""
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = h(enc(doc_id, source, lang, n_chars, text))
        changed = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            changed = h(enc(doc_id, source, lang, n_chars, text and text.replace("\n", "")))
        key = (source is not None, (source or "").encode())
        trees.setdefault(key, []).append(((doc_id is not None, doc_id or 0), leaf, doc_id, changed))

    def climb(nodes):
        """Root, and per node the steps (before, after)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, place in enumerate(at):
                run = nodes[place // 3 * 3 : place // 3 * 3 + 3]
                paths[i].append(("".join(run[: place % 3]), "".join(run[place % 3 + 1 :])))
                at[i] = place // 3
            nodes = [h(nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        return nodes[0], paths

    names = sorted(trees)
    grown = [climb([leaf for _, leaf, *_ in sorted(trees[name])]) for name in names]
    root, upper = climb([r for r, _ in grown])
    out = []
    for name, (subroot, paths), above in zip(names, grown, upper):
        for (_, leaf, doc_id, changed), path in zip(sorted(trees[name]), paths):
            node = changed
            for before, after in path + above:
                node = h([before, node, after])
            out.append((doc_id, leaf, subroot, root, h([b + a for b, a in path + above]), node))
    return out


def found(documents, levels):
    made = mk.manifest(mk.leaves(documents), levels)
    return mk.proofs(made, levels=levels).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(mk.siblings(F.col("proof")), 256),
        mk.folded(F.coalesce("tampered", "leaf"), F.col("proof")),
    )


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_against_brute_force(docs, odd, rows, levels):
    names = ["a", None, "", "é", "b", "Z", "+", "-", "/", "ab"]
    table = [(i, f"line {i}\nnext\n", "en", "a" if i % 3 else names[i % 10]) for i in range(90)]
    table += [(i, t, None, "odd") for i, t in odd] + [(7, "line 7\nnext\n", "en", "a"), (500, "x", None, "alone")]
    full = [(*r, len(r[1] or "")) for r in table]
    assert rows(found(docs(table), levels)) == sorted(brute(full), key=repr)


def test_small_tables(docs):
    assert found(docs([]), 7).count() == 0
    assert mk.manifest(mk.leaves(docs([]))).root is None
    only = found(docs([(1, None)]), 7).first()
    assert only["leaf"] == only["subroot"] == only["root"] == h(enc(1, None, None, 0, None))


def test_a_proof_is_asked_for_by_row_and_other_columns_stay_out(docs):
    table = docs([(i, f"t{i}", "en", "s") for i in range(30)])
    crowded = table.withColumn("tree", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("proof", F.lit(3))
    made = mk.manifest(mk.leaves(crowded), 2)
    some = mk.proofs(made, made.leaves.where("doc_id % 7 = 3"), 2)
    got = some.withColumn("ended", mk.folded(F.col("leaf"), F.col("proof"))).collect()
    assert sorted(r.doc_id for r in got) == [3, 10, 17, 24]
    assert all(r.ended == r.root == made.root for r in got)
