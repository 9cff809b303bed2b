"""Topic mining reports on one community."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import topic_stop_words
from tallyloom.operators import assembly, features, topics, words
from tallyloom.operators.ordering import rank_top_bottom
from tallyloom.plans.posting_reports import COMMUNITY, KEY, POST
from tallyloom.sources.catalog import Catalog


def run(
    spark: SparkSession,
    catalog: Catalog,
    community: str = "suicidewatch",
    anchor: str = "help",
    topic_community: str = "healthanxiety",
) -> None:
    """Needs the `posts` table of the posting reports. Topics are those of `topic_community`, with
    the default stop list; all else is about `community`."""
    posts = catalog.table(spark, "posts").where((F.col(COMMUNITY) == community) & F.col(POST).isNotNull())
    stop = topic_stop_words()
    near = words.cooccurrence(posts, POST, anchor, stop)
    catalog.save(near, "words_near_anchor")
    near = catalog.table(spark, "words_near_anchor")
    catalog.report(near, "topics/words_near_anchor", [F.desc("counts"), "word"])
    catalog.report(rank_top_bottom(near, "word", "counts"), "topics/top_bottom_words")
    talk = catalog.table(spark, "posts").where((F.col(COMMUNITY) == topic_community) & F.col(POST).isNotNull())
    catalog.report(topics.lda_topics(talk, KEY, POST), "topics/lda", ["topic", "rank"])
    fitted, weighed = features.fit_model(posts, KEY, POST, stop)
    fitted.save(catalog.table_path("feature_model"))
    centroids, assigned = features.cluster_terms(weighed.terms, KEY)
    catalog.save(centroids, "cluster_centroids")
    catalog.save(assigned, "post_clusters")
    factors = features.topic_factors(weighed.terms, KEY, rounds=10)
    catalog.save(factors.topics, "topic_words")
    catalog.save(factors.documents, "topic_posts")
    means, clustered = topics.cluster_documents(posts, KEY, POST, stop_words=stop, features=weighed)
    catalog.save(means, "cluster_means")
    catalog.save(clustered, "clustered_posts")
    clustered = catalog.table(spark, "clustered_posts")
    catalog.report(topics.cluster_top_words(clustered), "topics/cluster_words")
    topics.write_cluster_text(clustered, catalog.table_path("cluster_text"))
    lines = clustered.select("prediction", KEY, F.array_join("filtered_words", " ").alias("text"))
    catalog.save(assembly.ordered_text(lines, "prediction", KEY, "text"), "cluster_documents")


def score_posts(spark: SparkSession, catalog: Catalog, posts: DataFrame, id: str = KEY) -> tuple[DataFrame, DataFrame]:
    """Posts not seen before, under the models that `run` has saved: (id, cluster, similarity), and
    (id, known_words, unknown_words)."""
    fitted = features.FeatureModel.load(spark, catalog.table_path("feature_model"))
    weighed = features.transform(fitted, posts, id, POST)
    centroids = catalog.table(spark, "cluster_centroids")
    return features.nearest_clusters(weighed.terms, centroids, id), weighed.coverage
