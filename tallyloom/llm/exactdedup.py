"""Exact deduplication as a stateful stream.

The stream folds documents by the digest of their text. Its state, one entry per digest, lives on
disk (RocksDB) and never expires; an entry holds the digest, the stable identifier (the largest
doc_id so far), the locator of the content (file and row of one of the texts) and the count. Copies
within a batch are folded before they are shuffled, so a hot text reaches its entry as one row per
task. Digests are only a first hit: the texts of a digest met more than once are compared, byte by
byte, with the text at the locator of its entry. A bit field of fixed size keeps other texts at home.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.base import query
from tallyloom.session import stage, unique_path

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
#: Off: with it every state partition takes megabytes of disk before it holds a row.
ALLOCATE_KEY = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
#: Bits of the field of digests met more than once, which is broadcast (16 MiB). A full one lets more
#: texts through to the comparison, it never holds back a text that has to be compared.
FIELD_BITS = 1 << 27
#: Input taken into one batch.
BATCH_BYTES = str(64 << 30)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _locator(df: DataFrame) -> Column:
    place = df.metadataColumn("_metadata")
    return F.struct(place["file_path"].alias("file_path"), place["row_index"].alias("row_index"))


def _maybe_hit(keyed: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows of keyed whose digest has its bit set in the field of the hits."""
    bit = F.pmod(F.xxhash64("digest"), F.lit(FIELD_BITS)) + 1
    field = hits.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("field")
    )
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("field", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.expr("shiftleft(1, CAST(place % 8 AS INT))")
    return (
        keyed.withColumn("bucket", F.bitmap_bucket_number(bit))
        .withColumn("place", place)
        .join(F.broadcast(field), "bucket")
        .where(byte.bitwiseAND(mask) != 0)
        .drop("bucket", "place", "field")
    )


def _clashing(keyed: DataFrame, entries: DataFrame) -> DataFrame:
    """Digests under which some text differs from the text at the locator of their entry.

    Copies are folded on their bytes within each task, and of equal texts the least place is kept: a
    text that is not the one at the locator has another.
    """
    hits = stage(entries.where("group_size > 1").select("digest", "locator"), "dedup-hits")
    texts = _maybe_hit(keyed, hits).groupBy("digest", "text").agg(F.min("locator").alias("at"))
    return texts.join(hits, "digest").where("at <> locator").select("digest").distinct()


def _entries(spark: SparkSession, path: str, schema, digest, trigger: dict) -> DataFrame:
    """Run the stream over what is at `path`; its state at the end: one row per digest."""
    updates = unique_path(spark, "dedup-updates")
    checkpoint = unique_path(spark, "dedup-state")
    source = spark.readStream.schema(schema)
    for key, value in trigger.items():
        source = source.option(key, value)
    rows = source.parquet(path)
    folded = (
        rows.select(
            "doc_id", digest(F.coalesce("text", F.lit(""))).alias("digest"), _locator(rows).alias("locator")
        )
        .groupBy("digest")
        .agg(
            F.max("doc_id").alias("keep_id"),
            F.min("locator").alias("locator"),
            F.count("*").alias("group_size"),
        )
    )

    def write(batch: DataFrame, number: int) -> None:
        # A batch that is run again replaces its own folder.
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    settings = {PROVIDER_KEY: STATE_STORE, ALLOCATE_KEY: "false"}
    previous = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        run = (
            folded.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    finally:
        for key, value in previous.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    written = (
        "digest string, keep_id long, locator struct<file_path: string, row_index: long>, "
        "group_size long, batch long"
    )
    entry = F.max_by(F.struct("keep_id", "locator", "group_size"), "batch").alias("entry")
    rows = spark.read.schema(written).option("recursiveFileLookup", "false").parquet(updates)
    return rows.groupBy("digest").agg(entry).select("digest", "entry.*")


def deduplicate(
    spark: SparkSession,
    path: str,
    digest: Callable[[Column], Column] = sha256,
    **trigger: str,
) -> DataFrame:
    """Group the rows of the Parquet table at `path` (a folder or a pattern) by identical text.

    Gives doc_id, keep_id (the largest doc_id of the group, null ids only if there is no other),
    group_size, kept and text_sha256. Null counts as empty text. Of repeated rows with the largest
    doc_id every one is marked kept, as they cannot be told apart by id. An empty table gives no
    rows; other columns are ignored. `trigger` are options of the file source, such as
    maxFilesPerTrigger; whatever the batches, the result is the same.
    """
    documents = spark.read.parquet(path)
    options = trigger or {"maxBytesPerTrigger": BATCH_BYTES}
    entries = stage(_entries(spark, path, documents.schema, digest, options), "dedup-entries")

    keyed = documents.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), _locator(documents).alias("locator")
    ).withColumn("digest", digest(F.col("text")))
    clashing = stage(_clashing(keyed, entries), "dedup-clashes")
    keyed = keyed.drop("locator")
    narrow = keyed.select("doc_id", "digest", sha256(F.col("text")).alias("text_sha256"))
    if clashing.isEmpty():
        found = narrow.join(entries, "digest")
    else:
        split = keyed.join(clashing, "digest", "left_semi")
        exact = split.groupBy("digest", "text").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        )
        apart = (
            split.join(exact, ["digest", "text"])
            .withColumn("text_sha256", sha256(F.col("text")))
            .drop("digest", "text")
        )
        plain = narrow.join(entries.join(clashing, "digest", "left_anti"), "digest")
        columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
        found = plain.select(columns).union(apart.select(columns))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


@query("""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)""")
def op2_exact_dedup(spark, sf_dir):
    # A pattern, as a file stream takes a folder or a pattern, and the table may be a single file; it
    # matches this name only.
    return deduplicate(spark, f"{sf_dir}/documents.parque[t]")
