import re
from collections import defaultdict

import numpy as np
import pytest

from tallyloom.llm import mixing as mx


def brute_targets(sizes, weights, repeats=3):
    """Share, cut what is above, share the excess again."""
    got = [sum(sizes) * w / sum(weights) for w in weights]
    while True:
        over = [i for i, (g, s) in enumerate(zip(got, sizes)) if g > repeats * s + 1e-9]
        if not over:
            return got
        excess = sum(got[i] - repeats * sizes[i] for i in over)
        for i in over:
            got[i] = repeats * sizes[i]
        free = [i for i, (g, s) in enumerate(zip(got, sizes)) if g < repeats * s - 1e-9]
        for i in free:
            got[i] += excess * weights[i] / sum(weights[j] for j in free)


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 50, 1000], [10, 1, 0, 5000, 3], [7]])
def test_targets(sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    found = mx.targets(sizes, weights)
    assert found == pytest.approx(brute_targets(sizes, weights))
    assert sum(found) == pytest.approx(sum(sizes))
    assert mx.targets([], []) == [] and mx.targets([0, 0], [1, 2]) == [0, 0]


def test_schedule_stays_near_its_shares(spark, monkeypatch):
    monkeypatch.setattr(mx, "ROWS_PER_PART", 300)
    shares = [5.0, 0.0, 2.5, 1.0]
    rows = sorted(mx.schedule(spark, shares, 2000).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(2000))
    seen = defaultdict(int)
    for n, r in enumerate(rows, 1):
        assert r["rank"] == seen[r.source]
        seen[r.source] += 1
        for i, share in enumerate(shares):
            assert abs(seen[i] - n * share / sum(shares)) <= 4


def rows_of(prose, odd):
    rows = [(1000 + i, "w " * n, None, f"small {n}") for i, n in enumerate((1, 2, 5, 7, 13, 40, 100))]
    rows += [(i, prose(i, 20 + i % 50), "en", ("big", "b", "a", "é")[0 if i % 3 else 1 + i % 2]) for i in range(300)]
    rows += [(i, t, None, None) for i, t in odd] + [(700, prose(7, 3), None, "tiny")]
    return rows + [(800, "w " * 5000, None, "big")]


def test_mix(docs, prose, odd):
    rows = rows_of(prose, odd)
    mixed, segments = mx.mix(docs(rows))
    found = mixed.collect()
    assert len(found) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += size(text)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, mx.targets([sizes[n] for n in names], [1 + i % 3 for i in range(len(names))])))
    by_source = {}
    texts = {i: (t, s) for i, t, _, s in rows}
    for r in found:
        text, source = texts[r.doc_id]
        assert (r["size"], r.source_size) == (size(text), sizes[source])
        assert r.target == pytest.approx(goal[source])
        assert 0 <= r.taken <= 3 * r["size"]
        by_source[source] = by_source.get(source, 0) + r.taken
    for source, got in by_source.items():
        assert got == mx.whole_words(goal[source])
    # Every slot is filled with one block's words at most, and no words twice in one pass.
    spans = defaultdict(list)
    for s in segments.collect():
        spans[s.row_key, s.pass_].append((s.skipped, s.skipped + s.words))
    for parts in spans.values():
        parts.sort()
        assert all(a[1] <= b[0] for a, b in zip(parts, parts[1:]))


def test_reruns_agree_whatever_the_partitions(docs, prose, odd):
    frame = docs(rows_of(prose, [o for o in odd if o[0] not in (904,)]))
    take = lambda f: sorted(
        [(r.doc_id or -1, r.taken) for r in mx.mix(f)[0].collect()]
    )
    assert take(frame) == take(frame.repartition(5))


def test_empty_tables(docs):
    for rows in ([], [(1, None, None, "a"), (2, " ", None, None)]):
        mixed, segments = mx.mix(docs(rows))
        assert [r.taken for r in mixed.collect()] == [0] * len(rows) and segments.count() == 0


def test_running_sums(spark, monkeypatch):
    rng = np.random.default_rng(1)
    data = [(i, int(g), int(v)) for i, (g, v) in enumerate(zip(rng.integers(0, 3, 200), rng.integers(0, 9, 200)))]
    frame = spark.createDataFrame(data, "i long, g int, v long").repartitionByRange(5, "i")
    found = mx.running_sums(frame.sortWithinPartitions("i"), "g", "v", "t").collect()
    seen = defaultdict(int)
    before = {}
    for i, g, v in data:
        before[i] = seen[g]
        seen[g] += v
    assert {r.i: r.before for r in found} == before
