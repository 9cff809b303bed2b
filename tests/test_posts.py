import datetime as dt
import math
import random

import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from tallyloom.functions.text import normalise, tokenise
from tallyloom.operators import activity, series, topics, words

FIRST = dt.date(2018, 11, 5)


@pytest.fixture(scope="module")
def posts(frame):
    """Posts over two years; community `big` holds a third of them."""
    rng = random.Random(4)
    data = []
    for i in range(300):
        community = "big" if i % 3 == 0 else rng.choice(["p", "q", "r"])
        day = FIRST + dt.timedelta(days=rng.randint(0, 700))
        text = None if i % 17 == 0 else " ".join(rng.choice(["help", "me", "give", "up", "tired"]) for _ in range(6))
        data.append((i, community, f"u{rng.randint(0, 20)}", day, text))
    return data, frame(data, "id int, c string, a string, d date, post string")


def test_share(posts):
    data, df = posts
    out = {r["c"]: (r["posts"], r["percentage"]) for r in activity.activity_share(df, "c").collect()}
    assert sum(n for n, _ in out.values()) == 300
    assert out["big"][1] == pytest.approx(100 * out["big"][0] / 300)


def test_counts_by_period(posts, rows):
    data, df = posts
    months = {}
    for _, c, _, d, text in data:
        key = (c, f"{d:%Y-%m}")
        months[key] = months.get(key, 0) + (text is not None)
    got = {(r["c"], r["month"]): r["posts"] for r in activity.activity_counts(df, "d", "month", ["c"], "post").collect()}
    assert got == months
    weeks = {}
    for row in data:
        key = (row[3].year, row[3].isocalendar()[1])
        weeks[key] = weeks.get(key, 0) + 1
    assert {(r["year"], r["week"]): r["posts"] for r in activity.activity_counts(df, "d", "week").collect()} == weeks
    assert sum(r["posts"] for r in activity.activity_counts(df, "d", "day").collect()) == 300
    assert {r["year"] for r in activity.activity_counts(df, "d", "year").collect()} == {r[3].year for r in data}
    with pytest.raises(ValueError):
        activity.activity_counts(df, "d", "hour")


def test_before_after(posts):
    data, df = posts
    before, after = (dt.date(2018, 12, 1), dt.date(2019, 2, 28)), (dt.date(2020, 1, 1), dt.date(2020, 3, 31))
    out = {r["c"]: r for r in activity.before_after_change(df, "d", before, after, ["c"]).collect()}

    def mean_posts(community, span):
        months = {}
        for _, c, _, d, _ in data:
            if c == community and span[0] <= d <= span[1]:
                months[d.month] = months.get(d.month, 0) + 1
        return sum(months.values()) / len(months) if months else None

    for community in ("big", "p", "q", "r"):
        a, b = mean_posts(community, before), mean_posts(community, after)
        if a is None or b is None:
            assert community not in out
        else:
            assert out[community]["avg_before"] == pytest.approx(a)
            assert out[community]["percentage_increase"] == pytest.approx((b - a) / a * 100)


def test_season_and_weekday(posts):
    data, df = posts
    seen = {}
    for row in data:
        seen.setdefault(row[3].month, {}).setdefault(row[3].year, []).append(row)
    got = {r["month"]: r["monthly_avg_posts"] for r in activity.seasonal_pattern(df, "d").collect()}
    assert got == pytest.approx({m: sum(map(len, y.values())) / len(y) for m, y in seen.items()})
    sundays = sum(1 for row in data if row[3].isoweekday() == 7)
    assert sum(r["posts"] for r in activity.weekday_counts(df, "d", "c").where("day_of_week = 1").collect()) == sundays


def test_authors(posts):
    data, df = posts
    authors = {}
    breadth = {}
    for _, c, a, _, _ in data:
        authors.setdefault(c, set()).add(a)
        breadth.setdefault(a, set()).add(c)
    exact = {r["c"]: r["unique_authors"] for r in activity.unique_authors(df, "c", "a").collect()}
    assert exact == {c: len(s) for c, s in authors.items()}
    assert set(r["c"] for r in activity.unique_authors(df, "c", "a", approx=True).collect()) == set(authors)
    spread = {r["communities"]: r["authors"] for r in activity.breadth_distribution(df, "a", "c").collect()}
    assert sum(spread.values()) == len(breadth)
    top = activity.leaderboard(df, "a", 3).collect()
    counts = sorted(((-sum(r[2] == a for r in data), a) for a in breadth))[:3]
    assert [(r["a"], r["posts"]) for r in top] == [(a, -n) for n, a in counts]


def test_pivot_and_back(posts):
    _, df = posts
    communities = ["big", "p", "none"]
    wide = activity.pivot_counts(df, F.col("d"), "c", communities, "d")
    assert wide.columns == ["d", *communities]
    long = activity.unpivot_counts(wide, ["d"], communities, "c")
    assert long.where("c = 'none' and posts <> 0").count() == 0
    assert long.where("c = 'big'").agg(F.sum("posts")).first()[0] == 100
    assert activity.mean_length(df, "c", "post").count() == 4


def test_series(frame, rows):
    a = frame([("x", 1, 10), ("x", 2, 20), ("x", 3, 25), ("y", 1, 1)], "c string, period int, posts int")
    b = frame([(1, 1.0), (2, 2.0), (4, 9.0)], "period int, cases double")
    outer = series.align_series(a.drop("c"), b, ["period"], "outer", 0)
    assert rows(outer) == [(1, 1, 1.0), (1, 10, 1.0), (2, 20, 2.0), (3, 25, 0.0), (4, 0, 9.0)]
    by = series.series_correlation(a, b, ["period"], "posts", "cases", ["c"])
    got = {r["c"]: r["correlation"] for r in by.collect()}
    assert got["x"] == pytest.approx(1.0) and got["y"] is None or math.isnan(got["y"])


def texts(data):
    return [(r[0], r[1], r[4]) for r in data if r[4] is not None]


def test_lexicon_modes(posts):
    data, df = posts
    lexicon = ["tired", "give up", "help", "me give up"]
    got = {r["word"]: r["counts"] for r in words.lexicon_counts(df, "post", lexicon).collect()}
    assert set(got) <= {"tired", "help"}
    assert got["help"] == sum(t.split().count("help") for _, _, t in texts(data))
    phrase = {r["word"]: r["counts"] for r in words.lexicon_counts(df, "post", lexicon, mode="phrase").collect()}
    runs = lambda t, p: sum(t.split()[i:i + len(p)] == p for i in range(6))
    for entry in lexicon:
        expected = sum(runs(t, entry.split()) for _, _, t in texts(data))
        assert phrase.get(entry, 0) == expected
    with pytest.raises(ValueError):
        words.lexicon_counts(df, "post", lexicon, mode="other")


def test_lexicon_hits(posts):
    data, df = posts
    got = {r["id"]: r["hits"] for r in words.lexicon_hits(df, "post", ["tired", "up"], ["id"]).collect()}
    expected = {i: t.split().count("tired") + t.split().count("up") for i, _, t in texts(data)}
    assert got == {i: n for i, n in expected.items() if n}


def test_word_counts_and_stop_words(frame, rows):
    df = frame([("Help, help me!  now",), (None,)], "post string")
    assert rows(words.word_counts(df, "post")) == [("", 1), ("help", 2), ("me", 1), ("now", 1)]
    assert rows(words.word_counts(df, "post", ["ME", ""])) == [("help", 2), ("now", 1)]
    assert words.word_list(df, "post").count() == 5


def test_cooccurrence(frame, rows):
    df = frame([("help me please me",), ("me too",), ("HELP",), (None,)], "post string")
    assert rows(words.cooccurrence(df, "post", "help")) == [("me", 2), ("please", 1)]
    assert rows(words.cooccurrence(df, "post", "help", ["me"])) == [("please", 1)]


def test_term_share(posts):
    data, df = posts
    out = words.term_share(df, "post", "give up").first()
    hits = sum("give up" in t for _, _, t in texts(data))
    assert (out["posts"], out["posts_with_term"]) == (300, hits)
    assert out["percentage"] == pytest.approx(hits / 3)


def test_community_lexicons(posts, frame):
    data, df = posts
    lists = {"big": ["help", "tired", "give up"], "p": ["nothing"], "elsewhere": ["help"]}
    lexicon = frame(list(lists.items()), "c string, keywords array<string>")
    got = {r["c"]: r["matching_words_count"] for r in words.community_lexicon_matches(df, "c", "post", lexicon).collect()}
    assert got["p"] == 0 and set(got) == {"big", "p"}
    assert got["big"] == sum(len({"help", "tired"} & set(t.split())) for _, c, t in texts(data) if c == "big")


def test_tfidf_equals_ml(posts, spark):
    _, df = posts
    known = df.where("post is not null")
    tokens = known.select("id", tokenise(normalise(F.col("post")), "whitespace").alias("w"))
    counts = CountVectorizer(inputCol="w", outputCol="tf").fit(tokens)
    weighed = IDF(inputCol="tf", outputCol="v").fit(counts.transform(tokens)).transform(counts.transform(tokens))
    expected = {}
    for row in weighed.collect():
        for i, value in zip(row["v"].indices, row["v"].values):
            expected[row["id"], counts.vocabulary[i]] = value
    got = {(r["id"], r["word"]): r["tfidf"] for r in words.tfidf(known, "id", "post").collect()}
    assert got == pytest.approx(expected)


@pytest.fixture(scope="module")
def corpus(frame):
    rng = random.Random(9)
    themes = [["cat", "dog", "fish", "bird"], ["car", "bus", "train", "ship"], ["red", "blue", "green", "pink"]]
    return frame(
        [(i, " ".join(rng.choice(themes[i % 3]) for _ in range(20))) for i in range(90)], "id int, post string"
    )


def test_features_hold_every_word(posts, corpus, rows):
    _, df = posts
    for frame_ in (df, corpus.union(corpus.selectExpr("id + 1000", "concat(post, ' once', id)"))):
        features = topics.fit_features(frame_, "id", "post", [])
        known = {w for r in frame_.collect() for w in (r["post"] or "").replace("0", "").split()}
        known = {"".join(c for c in w if c.isalpha()) for w in known}
        found = {r["word"]: r["index"] for r in features.words.collect()}
        assert set(found) == known and sorted(found.values()) == list(range(features.size))
        weighed = {(r["id"], r["word"]): r["tfidf"] for r in words.tfidf(frame_.where("post is not null"), "id", "post").collect()}
        unpacked = {(r["id"], r["word"]): r["weight"] for r in topics.vector_terms(features, "id").collect()}
        assert unpacked == pytest.approx(weighed)


def test_features_are_ml_vectors(frame):
    df = frame([(1, "bb aa bb"), (2, "cc"), (3, "the"), (4, None)], "id int, post string")
    features = topics.fit_features(df, "id", "post")
    vectors = {r["id"]: r["counts"] for r in features.vectors.collect()}
    assert vectors[1].toArray().tolist() == [1, 2, 0] and vectors[2].size == 3
    assert vectors[3].numNonzeros() == 0 and set(vectors) == {1, 2, 3}


def test_models_too_large_are_refused(corpus, monkeypatch):
    monkeypatch.setattr(topics, "MODEL_CELLS", 20)
    with pytest.raises(ValueError, match="numbers"):
        topics.lda_topics(corpus, "id", "post", k=3)


def test_lda(corpus):
    out = topics.lda_topics(corpus, "id", "post", k=3, iterations=5, terms=4).collect()
    assert len(out) == 12 and {r["rank"] for r in out} == {1, 2, 3, 4}
    assert all(0 <= r["weight"] <= 1 for r in out)


def test_clusters(corpus, tmp_path, spark):
    from pyspark.ml.clustering import BisectingKMeansModel

    from tallyloom.sources.tables import load_model, save_model

    model, clustered = topics.cluster_posts(corpus, "id", "post", k=3)
    assert clustered.count() == 90
    groups = clustered.groupBy("prediction").agg(F.countDistinct(F.col("id") % 3).alias("themes")).collect()
    assert len(groups) == 3 and {g["themes"] for g in groups} == {1}
    top = topics.cluster_top_words(clustered, 2).collect()
    assert len(top) == 6 and {r["rank"] for r in top} == {1, 2}
    topics.write_cluster_text(clustered, str(tmp_path / "text"))
    assert spark.read.text(str(tmp_path / "text")).count() == 90
    save_model(model, str(tmp_path / "model"))
    assert load_model(BisectingKMeansModel, str(tmp_path / "model")).getK() == 3


def test_nmf_separates_themes(corpus):
    out = topics.nmf_topics(corpus, "id", "post", vocab_size=12, min_df=1, k=3, iterations=15, terms=4).collect()
    found = {frozenset(r["term"] for r in out if r["topic"] == t) for t in range(3)}
    assert found == {
        frozenset(["cat", "dog", "fish", "bird"]),
        frozenset(["car", "bus", "train", "ship"]),
        frozenset(["red", "blue", "green", "pink"]),
    }
    again = topics.nmf_topics(corpus, "id", "post", vocab_size=12, min_df=1, k=3, iterations=15, terms=4).collect()
    weights = lambda result: {(r["topic"], r["term"]): r["weight"] for r in result}
    assert weights(again) == pytest.approx(weights(out), abs=1e-6)
