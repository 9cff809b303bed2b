import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.sketches import day_sketches, merged_sketches, read_sketches
from tallyloom.operators.suggest import suggest_entries


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_all_near_pairs(frame, distance):
    rng = random.Random(distance)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 9)))
    names, entries = [word() for _ in range(80)], [word() for _ in range(80)]
    odd = [None, "", "  ", " Abca ", "abca", "ABCA"]
    left = frame([(x,) for x in [*names, *odd, *names[:5]]], "label string")
    right = frame([(x,) for x in [*entries, *odd, *entries[:5]]], "official string")
    tidy = lambda x: x.strip(" ").lower()
    expected = {
        (n, e, edits(tidy(n), tidy(e)))
        for n in [*names, *odd]
        for e in [*entries, *odd]
        if n and e and tidy(n) and tidy(e) and edits(tidy(n), tidy(e)) <= distance
    }
    found = suggest_entries(left, "label", right, "official", distance).collect()
    assert {(r.name, r.entry, r.edits) for r in found} == expected and len(found) == len(expected)
    for r in found:
        assert r["rank"] == 1 + sum((x.edits, x.entry) < (r.edits, r.entry) for x in found if x.name == r.name)


def test_no_names(frame):
    left, right = frame([], "a string"), frame([("x",)], "b string")
    assert suggest_entries(left, "a", right, "b").count() == 0


def test_days_merge_to_the_whole(spark, frame, tmp_path):
    rng = random.Random(5)
    day = dt.datetime(2024, 1, 1)
    posts = [(rng.choice("xy"), day + dt.timedelta(hours=rng.randrange(480)), rng.randrange(3000), rng.gauss(50, 9))
             for _ in range(20_000)]
    posts += [("z", day, None, None), ("z", None, 1, 2.0)]
    df = frame(posts, "topic string, at timestamp, author long, value double")
    path = str(tmp_path / "sketches")
    early, late = F.col("at") < "2024-01-11", F.coalesce(F.col("at") >= "2024-01-11", F.lit(True))
    for part in (early, late):  # the second part is appended as new days
        day_sketches(df.where(part), ["topic"], "at", "author", "value").write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    found = {r.topic: r for r in read_sketches(merged_sketches(stored, ["topic"], end="2024-01-15")).collect()}
    for topic in "xy":
        kept = [p for p in posts if p[0] == topic and p[1] < dt.datetime(2024, 1, 16)]
        authors, values = len({p[2] for p in kept}), sorted(p[3] for p in kept)
        assert found[topic].n == len(kept)
        assert abs(found[topic].unique_authors - authors) < 0.05 * authors
        for rank, value in zip((0.25, 0.5, 0.75), found[topic].quantiles):
            assert abs(sum(v <= value for v in values) / len(values) - rank) < 0.04
    assert (found["z"].n, found["z"].known, found["z"].unique_authors, found["z"].quantiles) == (1, 0, 0, None)
    plan = merged_sketches(stored, ["topic"], "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day,2024-01-02)" in plan
    assert read_sketches(merged_sketches(stored.limit(0), ["topic"])).count() == 0
