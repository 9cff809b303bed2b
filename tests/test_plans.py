"""Plans keep to built-in operators, prune what they read and never sort all rows in one task."""

from pathlib import Path

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no driver tables here")
ML = {"lda_topics", "cluster_words", "nmf_topics", "tfidf_features"}


def plan(spark, name):
    return entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - ML))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def test_season_reaches_the_scan(spark):
    text = plan(spark, "season_window")
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_columns_are_pruned(spark):
    text = plan(spark, "posts_by_month")
    assert "ReadSchema: struct<o_orderdate:timestamp" in text and "o_totalprice" not in text


def test_facts_fold_before_the_join(spark):
    text = plan(spark, "entity_year_panel")
    scan = text.index("l_suppkey")
    assert "partial_sum" in text[: text.rindex("FileScan")] and scan > 0


def test_top_k_is_taken_per_task(spark):
    assert "TakeOrderedAndProject" in plan(spark, "author_leaderboard")


def test_cluster_words_are_cut_before_the_shuffle(spark, frame):
    from tallyloom.operators.topics import cluster_top_words

    df = frame([(0, ["a", "b"])], "prediction int, filtered_words array<string>")
    text = cluster_top_words(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


def test_ranks_come_from_a_cut_table(spark):
    text = plan(spark, "ranked_words_near_anchor")
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if " Window [" in line and "SinglePartition" in "".join(lines[i : i + 4]):
            assert "TakeOrderedAndProject" in "".join(lines[i : i + 6]) or "Limit" in "".join(lines[i : i + 6])
