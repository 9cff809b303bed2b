import random

import pytest

from tallyloom.operators import ordering
from tallyloom.operators.joins import join_by_frequency


def skewed(n, seed=1):
    """One value holds a third of the rows; some values are null."""
    rng = random.Random(seed)
    out = [7.0 if i % 3 == 0 else rng.choice([rng.randint(0, 50), rng.random() * 100]) for i in range(n)]
    return [None if rng.random() < 0.05 else float(v) for v in out]


def brute_deciles(values):
    known = sorted(v for v in values if v is not None)
    return [known[-(-i * len(known) // 10) - 1] for i in range(1, 10)]


@pytest.mark.parametrize("n", [1, 3, 9, 10, 11, 400])
def test_exact_deciles(frame, n):
    a, b = skewed(n, 1), skewed(n, 2)
    if n < 10:
        a, b = [float(i) for i in range(n)], [2.0] * n
    df = frame(list(zip(a, b)), "a double, b double")
    assert ordering.decile_values(df, ["a", "b"]) == {"a": brute_deciles(a), "b": brute_deciles(b)}


def test_deciles_of_nothing(frame):
    df = frame([(None, 1.0)], "a double, b double")
    assert ordering.decile_values(df, ["a", "b"]) == {"a": [], "b": [1.0] * 9}
    assert ordering.decile_values(df, ["a", "b"], exact=False) == {"a": [], "b": [1.0] * 9}


def test_approximate_deciles_are_close(frame):
    values = [float(i) for i in range(1000)]
    df = frame([(v,) for v in values], "a double")
    approx = ordering.decile_values(df, ["a"], exact=False)["a"]
    assert all(abs(x - e) <= 2 for x, e in zip(approx, brute_deciles(values)))


def test_decile_table(frame, rows):
    df = frame([(float(i),) for i in range(1, 11)], "a double")
    assert rows(ordering.deciles(df, ["a"])) == [("a", [float(i) for i in range(1, 10)])]


def test_global_rank(frame, rows):
    values = [v for v in skewed(300) if v is not None]
    df = frame(list(enumerate(values)), "id int, v double")
    expected = sorted((i, v, 1 + sum(o > v for o in values)) for i, v in enumerate(values))
    got = sorted(rows(ordering.global_rank(df, "v").select("id", "v", "rank")))
    assert got == expected


def test_rank_of_nothing(frame, rows):
    assert rows(ordering.global_rank(frame([], "id int, v double"), "v")) == []


def test_join_by_frequency_keeps_every_row(frame, rows):
    keys = ["hot"] * 50 + [f"k{i % 20}" for i in range(100)] + ["unknown"] * 5
    fact = frame(list(enumerate(keys)), "id int, k string")
    counts = {k: keys.count(k) for k in set(keys) - {"unknown"}}
    keyed = frame(list(counts.items()), "k string, n int")
    for hot_keys in (1, 3, 1000):
        joined = join_by_frequency(fact, keyed, "k", "n", hot_keys=hot_keys)
        expected = sorted((k, i, counts[k]) for i, k in enumerate(keys) if k in counts)
        assert sorted(rows(joined.select("k", "id", "n"))) == expected


def test_top_and_bottom_follow_one_order(frame):
    data = [("a", 1.0), ("b", 1.0), ("c", 3.0), ("d", None), ("e", 2.0)]
    df = frame(data, "k string, v double")
    pick = lambda d: [r["k"] for r in d.collect()]
    assert pick(ordering.top_k(df, "v", "k", 10)) == ["c", "e", "a", "b", "d"]
    assert pick(ordering.top_k(df, "v", "k", 2)) == ["c", "e"]
    assert pick(ordering.bottom_k(df, "v", "k", 3)) == ["d", "b", "a"]
    assert pick(ordering.smallest_k(df, "v", "k", 3)) == ["d", "a", "b"]
    assert pick(ordering.leading_key(df, "v", "k")) == ["c"]
    both = ordering.top_bottom(df, "v", "k", 2).collect()
    assert [r["k"] for r in both] == ["c", "e", "d", "b"]


@pytest.mark.parametrize("k", [1, 5, 20, 500])
def test_rank_top_bottom(frame, rows, k):
    rng = random.Random(k)
    counts = [(f"w{i}", 1 if i % 3 == 0 else rng.randint(1, 30)) for i in range(120)]
    df = frame(counts, "word string, counts int")
    ranks = {w: 1 + sum(o > c for _, o in counts) for w, c in counts}
    expected = [(w, c, ranks[w], "top") for w, c in counts if ranks[w] <= k]
    expected += [(w, c, ranks[w], "bottom") for w, c in counts if ranks[w] > len(counts) - k]
    got = rows(ordering.rank_top_bottom(df, "word", "counts", k))
    assert got == sorted(expected, key=repr)

    order = sorted(counts, key=lambda x: (-x[1], x[0]))
    numbered = [(w, c, i + 1) for i, (w, c) in enumerate(order)]
    expected = [(*x, "top") for x in numbered[:k]] + [(*x, "bottom") for x in numbered[-k:]]
    got = rows(ordering.rank_top_bottom(df, "word", "counts", k, "row_number"))
    assert got == sorted(expected, key=repr)


def test_values_keep_their_type(frame, rows):
    big = 9007199254740992
    df = frame([(big + i,) for i in range(10)], "v bigint")
    assert ordering.decile_values(df, ["v"]) == {"v": [big + i for i in range(9)]}
    assert ordering.deciles(df, ["v"]).schema["deciles"].dataType.simpleString() == "array<bigint>"
    assert rows(ordering.global_rank(df, "v")) == [(big + i, 10 - i) for i in range(10)]


def test_nulls_are_ranked_last(frame, rows):
    df = frame([(1, 5.0), (2, None), (3, 7.0), (4, None), (5, 5.0)], "id int, v double")
    assert rows(ordering.global_rank(df, "v").select("id", "rank")) == [(1, 2), (2, 4), (3, 1), (4, 4), (5, 2)]


@pytest.mark.parametrize("n", [200, 2000])
def test_sorted_parts_stay_bounded(frame, n):
    df = frame([(float(i % (n - 1)),) for i in range(n)], "v double")
    table, before, total = ordering.sorted_frequencies(df, "v", part_rows=50)
    sizes = [r["count"] for r in table.groupBy("part").count().collect()]
    assert total == n and max(sizes) <= 100 and len(sizes) >= n // 100


def test_values_in_small_parts(frame, rows, monkeypatch):
    monkeypatch.setattr(ordering, "PART_ROWS", 7)
    monkeypatch.setattr(ordering.sorted_frequencies, "__defaults__", (7,))
    values = skewed(300, 5)
    df = frame(list(enumerate(values)), "id int, v double")
    assert ordering.decile_values(df, ["v"]) == {"v": brute_deciles(values)}
    known = [v for v in values if v is not None]
    expected = [(i, 1 + (len(known) if v is None else sum(o > v for o in known))) for i, v in enumerate(values)]
    assert rows(ordering.global_rank(df, "v").select("id", "rank")) == sorted(expected, key=repr)
