import hashlib

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import exactdedup
from tallyloom.llm.exactdedup import deduplicate


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    out = []
    for doc, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc, keep, len(ids), doc == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def written(docs, rows, tmp_path, parts):
    path = str(tmp_path / "documents.parquet")
    docs(rows).repartition(parts).write.parquet(path)
    return path


@pytest.mark.parametrize("options", [{}, {"maxFilesPerTrigger": "1"}])
def test_groups_over_batches(spark, docs, odd, tmp_path, options):
    rows = list(odd) + [(i, f"text {i % 7}") for i in range(60)] + [(99, "Text 1"), (98, "text 1 ")]
    path = written(docs, rows, tmp_path, 4)
    found = deduplicate(spark, path, **options)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_clashing_digests_are_told_apart_by_bytes(spark, docs, tmp_path):
    rows = [(i, "ab" * (i % 3) + "cd" * (i % 5)) for i in range(40)]
    path = written(docs, rows, tmp_path, 3)
    found = deduplicate(spark, path, digest=lambda t: F.length(t).cast("string"))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_empty_table(spark, docs, tmp_path):
    assert deduplicate(spark, written(docs, [], tmp_path, 1)).count() == 0


def test_settings_are_restored(spark, docs, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    deduplicate(spark, written(docs, [(1, "a")], tmp_path, 1))
    assert spark.conf.get(key) == before


def test_bytes_are_compared_at_the_locator(spark, docs, tmp_path):
    rows = [(i, f"text {i % 7}") for i in range(40)] + [(100 + i, f"single {i}") for i in range(40)]
    path = written(docs, rows, tmp_path, 3)
    documents = spark.read.parquet(path)
    keyed = documents.select("doc_id", "text", exactdedup._locator(documents).alias("locator"))

    def clashes(digest):
        entries = exactdedup._entries(spark, path, documents.schema, digest, {"maxFilesPerTrigger": "1"})
        return {r.digest for r in exactdedup._clashing(keyed.withColumn("digest", digest(F.col("text"))), entries).collect()}

    assert clashes(exactdedup.sha256) == set()
    assert clashes(lambda t: F.substring(t, 1, 4)) == {"text", "sing"}
    assert clashes(lambda t: F.substring(t, 1, 8)) == {"single 1", "single 2", "single 3"}


def test_only_digests_met_twice_pass_the_field(spark):
    keyed = spark.range(2000).select(F.col("id").cast("string").alias("digest"))
    hits = keyed.where("cast(digest as int) % 10 = 0")
    found = {int(r.digest) for r in exactdedup._maybe_hit(keyed, hits).collect()}
    assert found >= set(range(0, 2000, 10)) and len(found) < 210


def test_a_column_named_like_the_files_metadata(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(1, "a", 5), (2, "a", 6)], "doc_id long, text string, _metadata int").write.parquet(path)
    found = sorted((r.doc_id, r.keep_id, r.kept) for r in deduplicate(spark, path).collect())
    assert found == [(1, 2, False), (2, 2, True)]
