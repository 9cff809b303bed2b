"""Models over any number of words: what moves, what is made, and that results are whole."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.operators import factors, features, topics, words

THEMES = ("sun sea sand beach wave", "stock bond market trade price", "oven flour bread bake dough")


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(THEMES[i % 3].split()) for _ in range(15))) for i in range(60)]
    return spark.createDataFrame([*rows, (60, ""), (61, None)], "id long, post string")


def staged_since(at):
    return {path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in session._staged[at:]}


def test_f1_topics_weigh_and_rank_all_words(corpus):
    out = topics.lda_topics(corpus, "id", "post", k=3, terms=None, stop_words=[]).collect()
    assert len(out) == 3 * 16  # the empty text is a word as well
    for topic in range(3):
        own = sorted((r for r in out if r["topic"] == topic), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 17)) and sum(r["weight"] for r in own) == pytest.approx(1)
        assert all(a["weight"] >= b["weight"] for a, b in zip(own, own[1:]))
    assert not hasattr(topics, "LDA")


def test_f1_a_pass_over_documents_raises_their_bound(spark):
    rng = np.random.default_rng(5)
    data = [(r, c, float(rng.integers(1, 5))) for r in range(40) for c in rng.choice(30, 8, replace=False).tolist()]
    table = factors.sparse(spark.createDataFrame(data, "row long, column long, value double"))

    def fit(iterations):
        shares = np.zeros((30, 2))
        for index, vec in factors.dirichlet(table, 2, iterations).collect():
            shares[index] = np.frombuffer(bytes(vec))
        assert shares.sum(axis=0) == pytest.approx(np.ones(2))
        x = np.zeros((40, 30))
        for r, c, v in data:
            x[r, c] = v
        theta = np.full((40, 2), 0.5)
        for _ in range(200):
            theta *= (x / (theta @ shares.T)) @ shares
            theta /= theta.sum(axis=1, keepdims=True)
        return (x * np.log(theta @ shares.T)).sum()

    assert fit(8) > fit(1)


def test_f2_clusters_without_a_model_on_the_driver(corpus):
    means, clustered = topics.cluster_documents(corpus, "id", "post", k=3, stop_words=[])
    rows = clustered.collect()
    assert {r["id"] for r in rows} == set(range(61)) and means.columns == ["cluster", "index", "weight"]
    assert len({(r["id"] % 3, r["prediction"]) for r in rows if r["id"] < 60}) == 3
    assert [r["filtered_words"] for r in rows if r["id"] == 60] == [[""]]


def test_f3_f4_a_block_gets_each_of_its_columns_once(spark):
    data = [(r, c % 7, 1.0) for r in range(50) for c in range(r, r + 3)]
    table = factors.sparse(spark.createDataFrame(data, "row long, column long, value double"))
    blocks, tiles = table.blocks.collect(), table.tiles.collect()
    assert 1 < len(blocks) <= table.count and sum(len(b["at"]) // 4 for b in blocks) == 150
    assert sum(len(t["places"]) // 4 for t in tiles if t["block"] >= 0) == sum(len(b["columns"]) // 8 for b in blocks) <= 7 * len(blocks)
    plan = factors.per_block(table, None, 1, lambda *_: None, "block int")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_f5_f9_words_are_counted_where_texts_are_dealt(spark, corpus, rows):
    tokens = words.topic_tokens(F.col("post"), [])
    counted = words.term_frequencies(corpus, "id", tokens, dealt=True)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "word" not in plan.split("Exchange hashpartitioning")[1].splitlines()[0]
    assert rows(counted) == rows(words.term_frequencies(corpus, "id", tokens))
    assert words.few_per_id(corpus, "id") == (62, True)
    assert words.few_per_id(corpus.withColumn("id", F.lit(1)), "id") == (62, False)


def test_f6_f8_a_model_for_later_posts_weighs_no_corpus(corpus):
    at = len(session._staged)
    model, fitted = features.fit_model(corpus, "id", "post", [])
    assert staged_since(at) == {"terms", "words", "numbered-words"}
    assert (model.documents, model.size, model.occurrences) == (61, 16, fitted.terms.count())
    assert "weights" in staged_since(at) and fitted.vectors.count() == 61


def test_f7_sums_of_a_pass_are_those_of_the_dense_table(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 3, (30, 9)).astype(float)
    data = [(int(r), int(c), float(x[r, c])) for r, c in zip(*np.nonzero(x))]
    table = factors.sparse(spark.createDataFrame(data, "row long, column long, value double"))
    found = rng.random((2, 9)) + 0.1
    w = np.ones((30, 2))
    for _ in range(10):
        w *= x @ found.T / (w @ (found @ found.T) + 1e-9)
    gram, cross = topics._topic_sums(table, found)
    assert gram == pytest.approx(w.T @ w) and cross == pytest.approx(w.T @ x)
