import math
import random

import pytest

from tallyloom.operators import assembly, features, phrases
from tallyloom.operators.topics import fit_features

SCHEMA = "id long, post string"
THEMES = ("sun sea sand beach wave", "stock bond market trade price", "oven flour bread bake dough")


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(THEMES[i % 3].split()) for _ in range(12))) for i in range(60)]
    return spark.createDataFrame(rows, SCHEMA)


def test_a_saved_model_weighs_and_clusters_new_posts(spark, corpus, tmp_path):
    model, fitted = features.fit_model(corpus, "id", "post", ["the"])
    centroids, assigned = features.cluster_terms(fitted.terms, "id", 3)
    of_theme = {r["id"] % 3: r["cluster"] for r in assigned.collect()}
    assert assigned.count() == 60 and len(set(of_theme.values())) == 3
    model.save(str(tmp_path / "model"))
    loaded = features.FeatureModel.load(spark.newSession(), str(tmp_path / "model"))
    assert (loaded.documents, loaded.size, loaded.stop_words) == (60, 15, ["the"])
    again = features.FeatureModel.load(spark, str(tmp_path / "model"))
    new = spark.createDataFrame([(1, "the bread Bake zebra"), (2, "wave wave"), (3, None), (4, ""), (5, "zebra")], SCHEMA)
    found = features.transform(again, new, "id", "post")
    df = {r["word"]: r["df"] for r in again.words.collect()}
    got = {(r["id"], r["word"]): (r["tf"], r["weight"]) for r in found.terms.collect()}
    assert set(got) == {(1, "bread"), (1, "bake"), (2, "wave")}
    assert got[2, "wave"] == (2, pytest.approx(2 * math.log(61 / (df["wave"] + 1))))
    coverage = {r["id"]: (r["known_words"], r["unknown_words"]) for r in found.coverage.collect()}
    assert coverage[1] == (2, 1) and coverage[2] == (2, 0) and coverage[5] == (0, 1) and 3 not in coverage
    nearest = {r["id"]: r["cluster"] for r in features.nearest_clusters(found.terms, centroids, "id").collect()}
    assert nearest == {1: of_theme[2], 2: of_theme[0]}


def test_repeated_ids_are_refused(spark):
    with pytest.raises(ValueError, match="once"):
        fit_features(spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA), "id", "post", [])


def test_factors_of_topics(corpus):
    terms = fit_features(corpus, "id", "post", []).terms
    found = features.topic_factors(terms, "id", 3, 15)
    assert features.topic_loss(terms, found, "id") == pytest.approx(found.losses[-1], rel=1e-9)
    best = {}
    for r in found.documents.collect():
        best[r["id"]] = max(best.get(r["id"], (0, 0)), (r["weight"], r["topic"]))
    assert len({(i % 3, t) for i, (_, t) in best.items()}) == 3


def test_text_of_a_group_in_chunks(spark):
    rng = random.Random(2)
    rows = [(g, i, "".join(rng.choice("aé𝄞 ") for _ in range(rng.choice((0, 3, 40))))) for i in range(60) for g in ("x", None, "y")]
    rows += [("x", 100, None), ("empty", 1, ""), ("null", 1, None)]
    table = spark.createDataFrame(rows, "g string, i long, t string").repartition(5)
    for separator in (" ", "--", ""):
        found = {}
        for r in assembly.ordered_text(table, "g", "i", "t", separator, chunk=17).collect():
            found.setdefault(r["g"], {})[r["chunk"]] = (r["offset"], r["text"])
        for group in ("x", None, "y", "empty", "null"):
            whole = separator.join(t for g, i, t in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]) if t is not None)
            chunks = [text for _, (_, text) in sorted(found.get(group, {}).items())]
            assert "".join(chunks) == whole
            assert all(len(c) == 17 for c in chunks[:-1]) and all(o == k * 17 for k, (o, _) in found.get(group, {}).items())


def test_phrases_against_runs_of_tokens(spark, rows):
    rng = random.Random(3)
    texts = [(i, rng.choice(("p", "q", None)), " ".join(rng.choice(("a", "b", "A,", "", "c")) for _ in range(30))) for i in range(40)]
    texts += [(50, "p", None), (51, "q", ""), (52, "p", "b")]
    lists = {"p": ["a", "a b", "b a a b", "a a"], "q": ["a a", "", "c"], "none": []}
    table = spark.createDataFrame(texts, "id long, own string, post string")

    def brute(narrow):
        out = {}
        for _, own, text in texts:
            tokens = "".join(c for c in (text or "").lower() if c.isalnum() or c == " ").split(" ") if text is not None else []
            for name, entries in lists.items():
                if narrow and own != name:
                    continue
                for entry in entries:
                    n = len(entry.split(" "))
                    hits = sum(tokens[i : i + n] == entry.split(" ") for i in range(len(tokens) - n + 1))
                    if hits:
                        out[own, name, entry] = out.get((own, name, entry), 0) + hits
        return sorted(((*k, n) for k, n in out.items()), key=repr)

    assert rows(phrases.phrase_counts(table, "post", lists, ["own"])) == brute(False)
    assert rows(phrases.phrase_counts(table, "post", lists, ["own"], only_own="own")) == brute(True)
    assert rows(phrases.phrase_counts(table, "post", {}, [])) == []
