import random
from itertools import combinations

import pyarrow as pa
import pytest

import corpus_pipeline as pipeline
from tallyloom.llm import nearcopies as nc
from tallyloom.llm import simhash


def runs(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    a, b = runs(a), runs(b)
    return len(a & b) / max(1, len(a | b))


@pytest.fixture(scope="module")
def edited(prose):
    """Texts and copies with a few words changed, above and below the threshold."""
    rng, rows = random.Random(5), []
    for i in range(40):
        words = prose(5000 + i, 150).split()
        rows.append((2 * i, " ".join(words)))
        for at in rng.sample(range(len(words)), 1 + i % 8):
            words[at] = f"new{i}x{at}"
        rows.append((2 * i + 1, " ".join(words)))
    return rows


def expected(rows):
    root = {i: i for i, _ in rows}
    for (i, a), (j, b) in combinations(rows, 2):
        far = (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count()
        if similarity(a, b) >= 0.8 or far <= simhash.RADIUS:
            old, new = max(root[i], root[j]), min(root[i], root[j])
            root = {k: new if r == old else r for k, r in root.items()}
    return root


def test_groups_are_those_of_brute_force(docs, edited):
    found = {r.doc_id: r.component_id for r in nc.near_copies(docs(edited)).collect()}
    goal = expected(edited)
    assert found == goal
    assert 10 < sum(i != r for i, r in goal.items()) < 40


@pytest.mark.parametrize("block", [16, 4096])
def test_crowded_keys_lose_no_pair(docs, block):
    """Many copies of one text, each changed elsewhere: most are links of it and not of each other."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 200):
        words = list(base)
        for at in rng.sample(range(120), rng.choice((1, 2, 3, 5, 7))):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    found = {r.doc_id: r.component_id for r in nc.near_copies(docs(rows), block).collect()}
    goal = expected(rows)
    assert found == goal and len(set(goal.values())) > 1


def test_stage_drops_copies_beyond_three_bits(spark, docs, edited):
    goal = expected(edited)
    kept = {r.doc_id for r in pipeline.drop_near_duplicates(spark, docs(edited), "").collect()}
    assert kept == set(goal.values())
    texts = dict(edited)
    far = [i for i, r in goal.items() if i != r
           and (simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[r])).bit_count() > 3]
    assert far and not kept & set(far)


def test_odd_texts(docs, odd):
    rows = nc.near_copies(docs(odd)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.component_id)
    assert len(rows) == len(odd) and by[900] == by[901] == by[902] == {900}
    assert by[903] == by[904] == {903} and by[None] == {None}
    assert sum(r.keeper for r in rows) == len({r.component_id for r in rows})


def test_shingles():
    sets = nc.shingles(pa.array(["a b c d e f", "A  b\tc d e f", "a b", None, "a b c d e a b c d e"]))
    assert sets[0].tolist() == sets[1].tolist() and [len(s) for s in sets] == [2, 2, 1, 0, 5]
