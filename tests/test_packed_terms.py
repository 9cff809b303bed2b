"""Terms at size: words cut where texts stand, packed once, rounds that leave nothing behind."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.operators import factors, features, topics, words

PIECES = ["a", "B", "k", "K", "İ", "ſ", "é", "ß", "3", "_", "the", " ", "  ", "\t", "\n", "\x0b", "\r", "\x1c", "\x85", "𝄞"]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.choice((0, 1, 3, 30))))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (1002, " \t"), (1003, " a"), (1004, "a "), (1005, "12")]
    return spark.createDataFrame(rows, "id long, post string")


@pytest.mark.parametrize("drop", [[], ["the", "K"], ["", "a"]])
def test_f1_f3_words_cut_in_arrow_are_topic_tokens(odd, rows, drop):
    tokens = words.topic_tokens(F.col("post"), drop)
    assert rows(words.document_terms(odd, "id", "post", drop)) == rows(words.term_frequencies(odd, "id", tokens))
    known = odd.where("post IS NOT NULL")
    assert rows(words.document_tokens(odd, "id", "post", drop, "t")) == rows(known.select("id", tokens.alias("t")))
    plan = words.document_terms(odd, "id", "post", drop)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "regexp" not in plan


def test_f1_similarities_by_packed_terms(spark, rows):
    rng = np.random.default_rng(8)
    x, c = rng.random((30, 12)) * (rng.random((30, 12)) < 0.4), rng.random((3, 12)) * (rng.random((3, 12)) < 0.5)
    terms = spark.createDataFrame([(f"d{r}", int(i), float(x[r, i])) for r in range(30) for i in range(12) if x[r, i] or i == 0], "id string, index int, weight double")
    centroids = spark.createDataFrame([(int(k) * 7, int(i), float(c[k, i])) for k, i in zip(*np.nonzero(c))], "cluster int, index long, weight double")
    at = len(session._tables)
    found = {(r["id"], r["cluster"]): r["similarity"] for r in features.similarities(terms, centroids, "id").collect()}
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    want = {(f"d{r}", k * 7): unit[r] @ c[k] for r in range(30) for k in range(3) if (x[r] * c[k]).any()}
    assert found == pytest.approx(want)
    features.similarities(terms, centroids, "id")
    assert len(session._tables) == at + 2  # blocks and tiles, once


def test_f1_similarities_of_terms_with_few_words(spark, rows):
    terms = spark.createDataFrame([(1, 3, 2.0)], "id long, index int, weight double")
    centroids = spark.createDataFrame([(0, i, 0.5) for i in range(20)], "cluster int, index long, weight double")
    assert rows(features.similarities(terms, centroids, "id")) == [(1, 0, 0.5)]


def test_f1_f3_rounds_are_deleted(spark):
    rng = np.random.default_rng(9)
    data = [(r, int(c), float(rng.random() + 0.1)) for r in range(60) for c in rng.choice(40, 6, replace=False)]
    table = factors.sparse(spark.createDataFrame(data, "row long, column long, value double"))
    at = len(session._staged)
    factors.bisect(table, 4, 6, spherical=False)
    left = [path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in session._staged[at:]]
    assert left.count("centroids") == 1 and "stirred" not in left


def test_f2_topics_keep_one_table_and_send_half(spark, monkeypatch):
    rng = np.random.default_rng(10)
    data = [(r, int(c), float(rng.integers(1, 5))) for r in range(40) for c in rng.choice(30, 8, replace=False)]
    table = factors.sparse(spark.createDataFrame(data, "row long, column long, value double"))

    def fit():
        at, shares = len(session._staged), np.zeros((30, 3))
        for index, vec in factors.dirichlet(table, 3, 5).collect():
            shares[index] = np.frombuffer(bytes(vec))
        left = [path for path in session._staged[at:] if "topic-words" in path]
        assert len(left) == 1 and shares.sum(axis=0) == pytest.approx(np.ones(3))
        return shares

    assert factors.SENT == np.float32
    short = fit()
    monkeypatch.setattr(factors, "SENT", np.float64)
    assert short == pytest.approx(fit(), rel=1e-3, abs=1e-6)


@pytest.mark.parametrize("many", [False, True])
@pytest.mark.parametrize("unit", [False, True])
def test_f1_f3_blocks_hold_the_values(spark, many, unit):
    n = 70_000 if many else 500
    rng = np.random.default_rng(11)
    row, column = np.arange(n) // 50, np.arange(n) % 50
    value = rng.random(n) + 0.5 if many else rng.integers(1, 4, n).astype(float)
    entries = spark.createDataFrame(zip(row.tolist(), column.tolist(), value.tolist()), "row long, column long, value double")
    seen = {}
    for record in factors.sparse(entries.coalesce(1), unit).blocks.toArrow().to_batches(1):
        block = factors.Block(pa.Table.from_batches([record]))
        rows = np.repeat(block.rows, block.lengths)
        seen |= dict(zip(zip(rows.tolist(), block.columns[block.at].tolist()), block.values.tolist()))
    length = np.sqrt(np.bincount(row, value**2))[row] if unit else 1.0
    assert seen == pytest.approx(dict(zip(zip(row.tolist(), column.tolist()), (value / length).tolist())))


def test_f2_shuffle_files_go_when_a_table_is_staged(spark):
    before = spark.conf.get(session.CLEANUP_KEY, None)
    staged = session.stage(spark.range(1000).repartition(3, "id"), "kept")
    assert staged.count() == 1000 and spark.conf.get(session.CLEANUP_KEY, None) == before
    table, path = session.stage_at(staged, "gone")
    assert table.count() == 1000
    session.unstage(spark, path)
    assert path not in session._staged and not spark.sparkContext._jvm.java.io.File(path.removeprefix("file:")).exists()


def test_f3_clusters_give_every_text_its_words(odd, rows):
    _, clustered = topics.cluster_documents(odd, "id", "post", k=2, stop_words=["the"])
    want = odd.where("post IS NOT NULL").select("id", words.topic_tokens(F.col("post"), ["the"]).alias("t"))
    assert rows(clustered.select("id", "filtered_words")) == rows(want)
