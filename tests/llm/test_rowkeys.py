import pytest

from tallyloom.llm import debruijn
from tallyloom.llm.base import with_row_key

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def stored(spark, prose, tmp_path):
    """Documents in a few files of many row groups, with a long passage that two share."""
    shared = prose(1000, 60)
    rows = [(i, prose(i, 150) + (f" {shared}" if i in (7, 211) else "")) for i in range(240)]
    df = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string").coalesce(2)
    df.write.option("parquet.block.size", 20_000).parquet(str(tmp_path / "documents"))
    yield spark.read.parquet(str(tmp_path / "documents"))
    spark.conf.unset(SPLIT)


def test_keys_do_not_depend_on_the_splits(spark, stored):
    found, parts = [], []
    for size in ("1g", "20k"):
        spark.conf.set(SPLIT, size)
        keyed = with_row_key(stored.select("doc_id", "text"))
        parts.append(keyed.rdd.getNumPartitions())
        found.append(sorted((r.doc_id, *r.row_key) for r in keyed.drop("text").collect()))
    assert found[0] == found[1] and parts[0] < parts[1]
    assert len({(file, row) for _, file, row in found[0]}) == 241


def test_repeats_are_removed_alike_when_the_splits_change_between_jobs(spark, stored, monkeypatch):
    plain = sorted(map(tuple, debruijn.remove_repeats(stored).collect()))
    sizes = iter(("20k", "1g", "40k") * 20)
    step = debruijn.stage

    def stage(df, label):
        out = step(df, label)
        spark.conf.set(SPLIT, next(sizes))
        return out

    monkeypatch.setattr(debruijn, "stage", stage)
    assert sorted(map(tuple, debruijn.remove_repeats(stored).collect())) == plain
    assert {i for i, _, removed, *_ in plain if removed} == {3, 7, 211}
