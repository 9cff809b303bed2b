import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import minhash as mh

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset(words)


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and label[i] != label[j] and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    least = {}
    for (doc_id, *_), at in zip(rows, label):
        if doc_id is not None:
            least[at] = min(least.get(at, doc_id), doc_id)
    found = [least.get(at) for at in label]
    return sorted(((r[0], len(s), c, r[0] == c) for r, s, c in zip(rows, sets, found)), key=repr)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def crowd(seed, n, size=60):
    """Texts around one that is not itself kept in every key: most are links of it, not of each other."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(size)]
    return [" ".join(base)] + [edited(rng, base, rng.choice((2, 3, 3, 4, 6, 9))) for _ in range(n)]


@pytest.mark.parametrize("block", [7, 4096])
def test_against_brute_force(docs, prose, odd, rows, block):
    rng = random.Random(block)
    texts = [prose(i, 5 + i) for i in range(60)]
    texts += [edited(rng, t.split(), 1 + len(t.split()) // 40) for t in texts[20:]] + texts[:5]
    table = [(i, t) for i, t in enumerate(texts)] + [(2000 + i, t) for i, t in enumerate(crowd(1, 150))] + odd
    table += [(3000, "One word"), (3001, "one  WORD"), (3002, "É word"), (3003, "é word")]
    assert rows(mh.near_duplicates(docs(table), block)) == brute(table)


def test_small_and_clashing_tables(docs, rows):
    assert rows(mh.near_duplicates(docs([]))) == []
    assert rows(mh.near_duplicates(docs([(1, None), (2, ""), (3, " ")]))) == [(i, 0, i, True) for i in (1, 2, 3)]
    table = docs([(5, "a b c"), (4, "A b  c"), (None, "a b c"), (None, "z")])
    for name in ("node", "size", "mark", "key", "component_id"):
        table = table.withColumn(name, F.lit("x"))
    assert rows(mh.near_duplicates(table)) == sorted(
        [(5, 2, 4, False), (4, 2, 4, True), (None, 2, 4, False), (None, 1, None, True)], key=repr
    )


def test_pigeonhole_guarantee():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, (400, mh.PLACES), dtype=np.uint8)
    other = base.copy()
    for row in other:
        at = rng.choice(mh.PLACES, rng.integers(0, mh.GUARANTEED + 1), replace=False)
        row[at] ^= rng.integers(1, 256, len(at), dtype=np.uint8)
    assert (mh.index_keys(base) == mh.index_keys(other)).any(axis=1).all()
    assert len(set(map(tuple, mh._KEPT))) == mh.CHUNKS * mh.WIDTH


def test_recall_at_the_threshold():
    """Pairs just at 0.8 share a key and are not thought too far."""
    rng = np.random.default_rng(4)
    met = near = 0
    for _ in range(1500):
        values = np.unique(rng.integers(0, 1 << 63, 110, dtype=np.uint64))
        a, b = mh.signature(np.sort(values[:99])), mh.signature(np.sort(values[11:110]))
        met += (mh.index_keys(a[None]) == mh.index_keys(b[None])).any()
        near += (a != b).sum() <= mh.FAR
    assert met >= 1490 and near >= 1498
