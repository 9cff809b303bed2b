import random
import re

import numpy as np
import pytest
import xxhash

from tallyloom.llm import simhash as sh
from tallyloom.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, radius=3):
    label = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius and label[i] != label[j]:
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    return label


def test_fingerprints(prose, odd, monkeypatch):
    texts = [t for _, t in odd if t is None or len(t) < 1000] + ["A b", "a  B C", prose(1, 200)]
    monkeypatch.setattr(sh, "_BLOCK", 50)
    assert [sh.fingerprint(t) for t in texts] == [brute_print(t) for t in texts]


def test_masks_cover_every_pair():
    rng = random.Random(0)
    masks = sh.covering_masks()
    assert len(masks) == 15
    for _ in range(2000):
        flip = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(flip & m == 0 for m in masks)


def near(seed, n, centres=4):
    """Fingerprints in clouds around a few centres, chained by one to four flips."""
    rng = random.Random(seed)
    values = [rng.getrandbits(64) for _ in range(centres)]
    while len(values) < n:
        v = rng.choice(values)
        for b in rng.sample(range(64), rng.randint(1, 4)):
            v ^= 1 << b
        values.append(v)
    return sorted(set(values))


@pytest.mark.parametrize(("seed", "crowd"), [(1, 4096), (2, 1), (3, 3)])
def test_links_connect_what_brute_force_connects(spark, seed, crowd):
    values = near(seed, 90)
    frame = spark.createDataFrame([(sh._signed(v),) for v in values], "fingerprint long")
    edges = [(r.a, r.b) for r in sh.links(frame, crowd=crowd).collect()]
    back = {sh._signed(v): i for i, v in enumerate(values)}
    for a, b in edges:
        assert (values[back[a]] ^ values[back[b]]).bit_count() <= 3
    label = list(range(len(values)))
    for a, b in edges:
        x, y = label[back[a]], label[back[b]]
        label = [min(x, y) if v in (x, y) else v for v in label]
    assert label == roots(values)


def test_kept_links_are_few():
    values = np.array([i for i in range(1, 129)], np.uint64)  # all near each other
    a, b = sh._linked(values, np.full(len(values), len(values)), 3)
    assert len(a) < 4 * len(values)


def test_near_duplicates(spark, docs, prose, odd):
    base = prose(5, 400)
    rows = list(odd) + [(i, base + " tail" * (i % 2)) for i in range(20)] + [(50, prose(6, 300))]
    found = sh.near_duplicates(docs(rows)).collect()
    assert len(found) == len(rows)
    prints = [brute_print(t) if len(t or "") < 1000 or i != 906 else sh.fingerprint(t) for i, t in rows]
    label = roots(prints)
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i]]
        expected = min((x for x in ids if x is not None), default=None)
        assert {r.component_id for r in found if r.doc_id == doc} == {expected}
    groups = {}
    for r in found:
        groups.setdefault((r.component_id, r.fingerprint if r.component_id is None else 0), []).append(r)
    assert sum(r.keeper for r in found) == len(set(label))
    assert all(r.doc_id == r.component_id for r in found if r.keeper and r.component_id is not None)


def test_empty_table(docs):
    assert sh.near_duplicates(docs([])).count() == 0


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 80)]
    edges += [(7, 7), (3, 9), (9, 3)] + [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(60)]
    rng.shuffle(edges)
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for a, b in edges:
        if a != b:
            x, y = label[a], label[b]
            label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    assert found == label
