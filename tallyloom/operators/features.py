"""Word features that outlive their fit: saved as Parquet, loaded later, joined to posts not seen before."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import english_stop_words
from tallyloom.operators import factors
from tallyloom.operators.joins import join_by_frequency
from tallyloom.operators.shaping import col, require
from tallyloom.operators.topics import Features, fit_features
from tallyloom.operators.words import HOT_WORDS, term_frequencies, topic_tokens
from tallyloom.session import clearings, stage
from tallyloom.sources.tables import rows_table, write_table

_FACTS = "documents bigint, size bigint, occurrences bigint, stop_words array<string>"


@dataclass(frozen=True)
class FeatureModel:
    """words: (index, word, df); documents, and (document, word) pairs, of the corpus it was fitted to."""

    words: DataFrame
    documents: int
    size: int
    occurrences: int
    stop_words: list[str]

    def save(self, path: str) -> None:
        """Two Parquet folders below the path. The vocabulary is written as the table it is."""
        write_table(self.words, f"{path}/words")
        facts = [(self.documents, self.size, self.occurrences, list(self.stop_words))]
        write_table(rows_table(self.words.sparkSession, facts, _FACTS), f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureModel:
        facts = spark.read.schema(_FACTS).parquet(f"{path}/facts").first()
        words = spark.read.schema("index int, word string, df bigint").parquet(f"{path}/words")
        return FeatureModel(words, *facts)


def fit_model(
    df: DataFrame, id: str, text: str, stop_words: Sequence[str] | None = None
) -> tuple[FeatureModel, Features]:
    """Count all words of a corpus and keep what later posts need: the model, and the corpus' features,
    which are weighed when they are asked for."""
    drop = english_stop_words() if stop_words is None else stop_words
    features = fit_features(df, id, text, drop)
    return FeatureModel(features.words, features.documents, features.size, features.occurrences, list(drop)), features


@dataclass(frozen=True)
class Transformed:
    """terms: (id, index, word, tf, weight) of the words the model knows; coverage: (id, known_words,
    unknown_words), occurrences, for every post with a text."""

    terms: DataFrame
    coverage: DataFrame


def transform(model: FeatureModel, df: DataFrame, id: str, text: str) -> Transformed:
    """Features of posts under a fitted model: tf of the post times idf of the fitted corpus.

    Words the model has not seen have no weight and are counted. The words that are frequent in the
    fitted corpus, fewer than HOT_WORDS, are joined by broadcast and the rest by a shuffle.
    """
    require(df, [id, text])
    known = df.where(col(text).isNotNull())
    counted = stage(term_frequencies(known, id, topic_tokens(col(text), model.stop_words)), "new-terms")
    idf = F.ln((F.lit(model.documents) + 1) / (F.col("df") + 1))
    joined = join_by_frequency(counted, model.words, "word", "df", F.lit(model.occurrences), HOT_WORDS)
    terms = stage(joined.select(col(id), "index", "word", "tf", (F.col("tf") * idf).alias("weight")), "new-weights")
    seen = terms.groupBy(col(id)).agg(F.sum("tf").alias("seen"))
    every = counted.groupBy(col(id)).agg(F.sum("tf").alias("every"))
    none = F.lit(0).cast("bigint")
    coverage = (
        known.select(col(id)).distinct().join(every, id, "left").join(seen, id, "left")
        .withColumn("known_words", F.coalesce("seen", none))
        .select(col(id), "known_words", (F.coalesce("every", none) - F.col("known_words")).alias("unknown_words"))
    )
    return Transformed(terms, coverage)


@dataclass(frozen=True)
class TopicFactors:
    """topics: (topic, index, weight); documents: (id, topic, weight); losses: per round."""

    topics: DataFrame
    documents: DataFrame
    losses: list[float]


def topic_factors(
    terms: DataFrame, id: str, k: int = 10, rounds: int = 100, seed: int = 1, value: str = "tf", least_gain: float = 1e-4
) -> TopicFactors:
    """Non-negative factorisation of a table of terms (id, index, value) with all its words.

    Both factors are tables; a document or word whose weights are all zero has no rows.
    """
    table, numbers = factors.sparse_terms(terms, id, value)
    found = factors.factorise(table, k, rounds, seed, least_gain)
    documents = factors.named(factors.entries_of(found.rows, k, "row", "topic"), numbers, id)
    return TopicFactors(
        factors.entries_of(found.columns, k, "index", "topic").select("topic", "index", "weight"),
        documents.select(col(id), "topic", "weight"),
        found.losses,
    )


def topic_loss(terms: DataFrame, found: TopicFactors, id: str, value: str = "tf") -> float:
    """Squared error of factors, from their tables: over all cells, empty ones too."""
    own = found.documents.groupBy(col(id)).agg(F.map_from_entries(F.collect_list(F.struct("topic", "weight"))).alias("d"))
    words = found.topics.groupBy("index").agg(F.map_from_entries(F.collect_list(F.struct("topic", "weight"))).alias("w"))
    fit = F.aggregate(F.map_keys("d"), F.lit(0.0), lambda s, t: s + F.col("d")[t] * F.coalesce(F.try_element_at("w", t), F.lit(0.0)))
    cells = terms.join(own, id, "left").join(words, "index", "left")
    missed = F.when(F.col("d").isNull() | F.col("w").isNull(), 0.0).otherwise(fit)
    value_ = F.col(value).cast("double")
    seen = cells.agg(F.sum(value_ * value_ - 2 * value_ * missed)).first()[0] or 0.0

    def gram(table, key):
        other = table.select(col(key), F.col("topic").alias("other"), F.col("weight").alias("beside"))
        return table.join(other, key).groupBy("topic", "other").agg(F.sum(F.col("weight") * F.col("beside")).alias("g"))

    both = gram(found.documents, id).join(gram(found.topics, "index").withColumnRenamed("g", "h"), ["topic", "other"])
    return seen + (both.agg(F.sum(F.col("g") * F.col("h"))).first()[0] or 0.0)


#: Packed terms by their DataFrame: clusters and similarities of the same terms pack them once.
_packed: WeakKeyDictionary[DataFrame, dict] = WeakKeyDictionary()


def unit_table(terms: DataFrame, id: str) -> tuple[factors.Sparse, DataFrame]:
    """Terms as a sparse table of document vectors of unit length, and the numbers of the documents.
    Weightless terms go."""
    known, key = _packed.setdefault(terms, {}), (id, clearings())
    if key not in known:
        known[key] = factors.sparse_terms(terms.where("weight <> 0"), id, "weight", unit=True)
    return known[key]


def cluster_terms(terms: DataFrame, id: str, k: int = 5, rounds: int = 10, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Bisecting spherical k-means of documents: centroids (cluster, index, weight), each of unit
    length, and (id, cluster, similarity), each document with the nearest of them by cosine.

    Any number of words: no centroid is held by the driver or a single task. Documents without
    weights are in no cluster.
    """
    table, numbers = unit_table(terms, id)
    found = factors.bisect(table, k, rounds, seed)
    assigned = factors.named(found.assigned.withColumnRenamed("index", "row"), numbers, id)
    return found.centroids.select("cluster", "index", "weight"), assigned.select(col(id), "cluster", "similarity")


def similarities(terms: DataFrame, centroids: DataFrame, id: str) -> DataFrame:
    """(id, cluster, similarity) of documents, new ones too, with every centroid that shares a word.

    One pass over the packed terms: a block gets the centroids' weights of its words, and the rows that
    are made are those returned."""
    table, numbers = unit_table(terms, id)
    clusters = sorted(r[0] for r in centroids.select("cluster").distinct().collect() if r[0] is not None)  # k rows
    names = rows_table(terms.sparkSession, enumerate(clusters), "place int, cluster long")
    width = max(1, len(clusters))
    placed = centroids.join(F.broadcast(names), "cluster")
    found = factors.products(table, factors.factor_of(table, placed, width), width).join(F.broadcast(names), "place")
    cluster = F.col("cluster").cast(centroids.schema["cluster"].dataType).alias("cluster")
    return factors.named(found, numbers, id).select(col(id), cluster, F.col("product").alias("similarity"))


def nearest_clusters(terms: DataFrame, centroids: DataFrame, id: str) -> DataFrame:
    """(id, cluster, similarity): for each document the most similar centroid, the first of equals.
    Documents that share no word with any are left out."""
    best = F.max(F.struct("similarity", (-F.col("cluster")).alias("back"))).alias("best")
    found = similarities(terms, centroids, id).groupBy(col(id)).agg(best)
    return found.select(col(id), (-F.col("best.back")).alias("cluster"), "best.similarity")
