import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from tallyloom.llm import prefixtrie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            told = sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), told, role, text))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * words(node[-1][1]) if node else 0
    return sorted(
        (
            (min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), children[n], leaves[n],
             saved[n], sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
            for n in members
        ),
        key=repr,
    )


def talks(seed, n, reach=400):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(reach), n):
        rows += [(c, t, ("user", "assistant")[t % 2], rng.choice(("hi", "a b", "c  d\te"))) for t in range(rng.randint(1, 6))]
    return rows


ODD = [
    (-1, 0, "user", "a"), (-25, None, None, None), (-25, 3, "user", ""), (-20, 1, "user", "x"), (None, 1, "user", "no id"),
    (500, 1, "user", "same"), (500, 1, "user", "same"), (500, 1, "assistant", "same"), (501, None, "user", "first"),
    (501, -5, "user", "second"), (520, 0, "user", "w " * 20_000), (7000, 0, "é", "日本 語\x00"),
    *((9000, t, "user", f"turn {t % 3}") for t in range(300)),
    *((9020 + 20 * i, t, "user", f"turn {t % 3}") for i in range(3) for t in range(300)),
]


@pytest.mark.parametrize(("seed", "partitions", "fold"), [(1, 1, 1 << 25), (2, 7, 1 << 25), (3, 13, 200)])
def test_against_brute_force(spark, rows, monkeypatch, seed, partitions, fold):
    monkeypatch.setattr(pt, "FOLD", fold)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        table = talks(seed, 120) + (ODD if seed != 1 else [])
        conversations = spark.createDataFrame(table, SCHEMA).repartition(3)
        assert rows(pt.nodes(pt.encode(pt.sequences(conversations)))) == brute(table)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_turnless_conversation_and_none(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(pt.nodes(pt.encode(pt.sequences(empty)))) == []
    heads = next(c for c in range(21, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    table = [(heads, 0, "user", "gone")]
    found = rows(pt.nodes(pt.encode(pt.sequences(spark.createDataFrame(table, SCHEMA)))))
    assert found == brute(table) and len(found) == 1


def test_copies_are_folded_before_they_are_dealt_out(spark):
    table = [(c * 20, t, "user", f"t{t}") for c in range(2000) for t in range(3)]
    folded = pt.sequences(spark.createDataFrame(table, SCHEMA)).collect()
    assert len(folded) <= 8
    assert sum(len(r.ids) // 8 for r in folded) == 2000


def random_parens(seed, n):
    rng = random.Random(seed)
    out, depth = [True], 1
    for _ in range(n - 1):
        up = depth == 1 or rng.random() < (0.7 if rng.random() < 0.5 else 0.45)
        out.append(up)
        depth += 1 if up else -1
    return np.array(out + [False] * depth)


@pytest.mark.parametrize(("seed", "n"), [(0, 1), (1, 40), (2, 3000), (3, 20_000)])
def test_parentheses(seed, n):
    opens = random_parens(seed, n)
    tree = pt.Parentheses(opens)
    again = pt.Parentheses(opens, tree.lows)
    places, stack, close = np.flatnonzero(opens), [], {}
    for i, up in enumerate(opens.tolist()):
        if up:
            stack.append(i)
        else:
            close[stack.pop()] = i
    expected = [close[p] for p in places.tolist()]
    assert tree.find_close(places).tolist() == again.find_close(places).tolist() == expected
    assert tree.rank(places).tolist() == list(range(len(places)))
    pairs = [i for i in range(len(opens) - 1) if opens[i] and not opens[i + 1]]
    some = [0, len(places) // 2, len(places) - 1]
    counted = [sum(p <= i and i < close[p] for i in pairs) for p in places[some].tolist()]
    assert tree.leaves_between(places[some], np.array(expected)[some]).tolist() == counted


def test_range_minimum():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 100):
        values = rng.integers(0, 50, n)
        a = rng.integers(0, n, 200)
        b = np.array([rng.integers(x + 1, n + 1) for x in a])
        assert pt.range_minimum(values, a, b).tolist() == [values[x:y].min() for x, y in zip(a, b)]
