"""The corpus pipeline: filter, deduplicate, decontaminate, mix and encode the documents.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame. `run` writes each stage's rows as
Parquet to the shared folder and reads them back as the next stage's docs. All stages but the last
keep the columns of docs, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontamination, mixing, nearcopies, toxicity, wavelet
from tallyloom.llm.base import fresh, small_batches, with_row_key
from tallyloom.session import stage

#: The first stage is a trained classifier and the last a tokenizer: no SQL gives these rows.
ORACLE_SQL = None


def _join(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Join what an operator says of rows (by row_key) to the rows it was given."""
    key = fresh(docs, "row_key")
    keyed = with_row_key(docs, key)
    return keyed.join(found.withColumnRenamed("row_key", key), key, how).drop(key)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier flags go. It learns from the labelled ones among docs."""
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = fresh(docs, "toxicity")
    scored = toxicity.score(docs, model, name, keep_text=True)
    return scored.where(~toxicity.flagged(model, score=name)).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word runs, Jaccard 0.8) the one with the least doc_id stays."""
    small_batches(spark)
    keepers = nearcopies.near_copies(docs).where("keeper").select("row_key")
    return _join(docs, keepers, "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up a twentieth or more go."""
    small_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(docs, items).where(decontamination.contaminated())
    return _join(docs, found.select("row_key"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, to the nearest whole time.

    Only a source's last block is cut within documents, so nearly all are taken whole. Documents
    that the mix takes less than half of, and those without words, go.
    """
    small_batches(spark)
    mixed, _ = mixing.mix(docs)
    copies = F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    name = fresh(docs, "copies")
    taken = mixed.select("row_key", copies.alias(name)).where(F.col(name) > 0)
    repeated = F.explode(F.sequence(F.lit(1), F.col(name)))
    return _join(docs, taken, "inner").withColumn(name, repeated).drop(name)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in shards, read back: doc_id, start, n_tokens, ids_crc32."""
    small_batches(spark)
    return wavelet.encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token output", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
