import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tallyloom.llm import decontamination, simhash


@pytest.fixture(scope="module")
def folder(spark, docs, prose, odd, tmp_path_factory):
    rng = random.Random(2)
    passage = prose(77, 40)
    rows = [(i, prose(i, 30 + i % 40), "en", f"s{i % 3}") for i in range(150)]
    rows += [(200 + i, rows[i][1], "en", "s9") for i in range(5)]
    rows += [(300 + i, prose(900 + i, 10) + " " + passage, "en", "s1") for i in range(4)]
    toxic = []
    for i in range(60):
        words = prose(2000 + i, 30).split()
        words[rng.randint(0, 20) : 21] = ["vileword", "badone", "vileword"]
        toxic.append((400 + i, " ".join(words), "en", "s2"))
    rows += toxic + [(i, t, None, None) for i, t in odd]
    path = tmp_path_factory.mktemp("tables")
    docs(rows).repartition(3).withColumn("row_key", F.lit(1)).withColumn("Copies", F.lit("c")).write.parquet(
        str(path / "documents.parquet")
    )
    labels = [(i, int(i >= 400)) for i in [*range(0, 120), *range(400, 450)]]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(
        str(path / "benchmark.parquet")
    )
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, step in pipeline.STAGES:
        docs = pipeline.stage(step(spark, docs, folder), "test")
        seen[name] = docs
        if name != "token output":
            assert docs.columns == columns
    ids = lambda name: {r.doc_id for r in seen[name].select("doc_id").collect()}
    assert len([i for i in ids("toxicity") if i is not None and 400 <= i < 460]) <= 3
    assert len([i for i in ids("toxicity") if i is not None and i < 300]) >= 150
    near = seen["near-duplicates"]
    assert near.count() == simhash.near_duplicates(seen["toxicity"]).where("keeper").count()
    assert not ids("near-duplicates") & set(range(200, 205))
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontamination.contamination(near, items).where(decontamination.contaminated())
    bad = {r.doc_id for r in found.collect()}
    assert bad and ids("decontamination") == ids("near-duplicates") - bad
    mixed = seen["mixing"].groupBy("doc_id").count().collect()
    assert ids("mixing") <= ids("decontamination") and max(r["count"] for r in mixed) <= 3
    out = sorted(seen["token output"].collect(), key=lambda r: r.start)
    assert len(out) == seen["mixing"].count()
    assert [r.start for r in out] == [sum(x.n_tokens for x in out[:i]) for i in range(len(out))]


def test_run_is_registered(spark, folder):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run
    assert pipeline.run(spark, folder).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_empty_documents(spark, folder, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    assert pipeline.run(spark, str(tmp_path)).count() == 0
