"""Word counting, TF-IDF and topic models over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.functions.lexicons import COMMUNITY_KEYWORDS, ENGLISH_STOP_WORDS, EXTRA_STOP_WORDS
from tallyloom.operators import assembly, features, phrases, topics, words
from tallyloom.operators.ordering import rank_top_bottom
from tallyloom.session import unique_path
from tallyloom.sources.tables import rows_table
from workload.registry import query, rounded, table


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _quoted(items) -> str:
    return ", ".join("'" + item.replace("'", "''") + "'" for item in items)


NORMAL = r"regexp_replace(lower(text), '[^\w\s]', '', 'g')"
LETTERS = r"regexp_replace(lower(text), '[^a-zA-Z\s]', '', 'g')"


def _whitespace(expr: str) -> str:
    return rf"string_split_regex(regexp_replace(lower({expr}), '\s+$', ''), '\s')"


WORDS = f"string_split({NORMAL}, ' ')"
STOP = _quoted(EXTRA_STOP_WORDS)
ALL_STOP = _quoted(ENGLISH_STOP_WORDS + EXTRA_STOP_WORDS)
TOPIC = f"list_filter({_whitespace(LETTERS)}, lambda t: t NOT IN ({STOP}))"


@query(f"SELECT doc_id, md5({NORMAL}) AS word_text, md5({LETTERS}) AS letter_text FROM documents")
def normalised_text(spark, sf):
    text = F.col("text")
    return _docs(spark, sf).select(
        "doc_id",
        F.md5(tx.normalise(text)).alias("word_text"),
        F.md5(tx.normalise(text, "letters")).alias("letter_text"),
    )


@query(f"""SELECT doc_id, len({WORDS}) AS blank_tokens, len({_whitespace('text')}) AS whitespace_tokens,
    len(list_filter({WORDS}, lambda t: t <> '')) AS known_tokens FROM documents""")
def token_counts(spark, sf):
    text = F.col("text")
    normal = tx.normalise(text)
    return _docs(spark, sf).select(
        "doc_id",
        F.size(tx.tokenise(normal)).cast("bigint").alias("blank_tokens"),
        F.size(tx.tokenise(text, "whitespace")).cast("bigint").alias("whitespace_tokens"),
        F.size(tx.tokenise(normal, keep_empty=False)).cast("bigint").alias("known_tokens"),
    )


ALL_TOPIC = TOPIC.replace(STOP, ALL_STOP)


LEXICON = ["that", "with", "this", "from", "of the", "is the and"]
EXPLODED = f"SELECT lang, unnest({WORDS}) AS word FROM documents"


@query(f"SELECT lang, word, count(*) AS counts FROM ({EXPLODED}) WHERE word IN ({_quoted(LEXICON)}) GROUP BY 1, 2")
def lexicon_words(spark, sf):
    return words.lexicon_counts(_docs(spark, sf), "text", LEXICON, ["lang"])


@query(f"""WITH t AS (SELECT lang, {WORDS} AS w FROM documents),
    g AS (SELECT lang, unnest(w) AS word FROM t
    UNION ALL SELECT lang, unnest(list_transform(generate_series(1, len(w) - 1), lambda i: array_to_string(w[i:i+1], ' '))) FROM t
    UNION ALL SELECT lang, unnest(list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i+2], ' '))) FROM t)
    SELECT lang, word, count(*) AS counts FROM g WHERE word IN ({_quoted(LEXICON)}) GROUP BY 1, 2""")
def lexicon_phrases(spark, sf):
    return words.lexicon_counts(_docs(spark, sf), "text", LEXICON, ["lang"], mode="phrase")


@query(f"""SELECT role, turn, count(*) AS hits FROM (SELECT role, turn, unnest({WORDS}) AS word FROM conversations)
    WHERE word IN ({_quoted(LEXICON)}) GROUP BY 1, 2""")
def lexicon_hits_by_turn(spark, sf):
    return words.lexicon_hits(table(spark, sf, "conversations"), "text", LEXICON, ["role", "turn"])


@query(f"""SELECT doc_id, count(*) AS hits FROM (SELECT doc_id, unnest({WORDS}) AS word FROM documents)
    WHERE word IN ({_quoted(LEXICON)}) GROUP BY 1""")
def lexicon_hits_by_post(spark, sf):
    return words.lexicon_hits(_docs(spark, sf), "text", LEXICON, ["doc_id"])


@query(f"SELECT word, count(*) AS counts FROM ({EXPLODED}) GROUP BY 1")
def word_cloud(spark, sf):
    return words.word_counts(_docs(spark, sf), "text")


@query(f"SELECT word, count(*) AS counts FROM ({EXPLODED}) WHERE word NOT IN ({STOP}) GROUP BY 1")
def word_cloud_without_stop_words(spark, sf):
    return words.word_counts(_docs(spark, sf), "text", EXTRA_STOP_WORDS)


NEAR = f"""near AS (SELECT word, count(*) AS counts FROM (SELECT unnest(t) AS word FROM (SELECT {TOPIC} AS t FROM documents)
    WHERE list_contains(t, 'that')) WHERE word <> 'that' GROUP BY 1)"""


def _near(spark, sf):
    return words.cooccurrence(_docs(spark, sf), "text", "that", EXTRA_STOP_WORDS)


@query(f"WITH {NEAR} SELECT * FROM near")
def words_near_anchor(spark, sf):
    return _near(spark, sf)


@query(f"""WITH {NEAR}, r AS (SELECT *, rank() OVER (ORDER BY counts DESC) AS rank, count(*) OVER () AS n FROM near)
    SELECT word, counts, rank, 'top' AS side FROM r WHERE rank <= 20
    UNION ALL SELECT word, counts, rank, 'bottom' FROM r WHERE rank > n - 20""")
def ranked_words_near_anchor(spark, sf):
    return rank_top_bottom(_near(spark, sf), "word", "counts")


@query(f"""WITH {NEAR}, r AS (SELECT *, row_number() OVER (ORDER BY counts DESC, word) AS rank, count(*) OVER () AS n FROM near)
    SELECT word, counts, rank, 'top' AS side FROM r WHERE rank <= 20
    UNION ALL SELECT word, counts, rank, 'bottom' FROM r WHERE rank > n - 20""")
def numbered_words_near_anchor(spark, sf):
    return rank_top_bottom(_near(spark, sf), "word", "counts", method="row_number")


@query(f"""SELECT lang, count(*) AS posts, count(*) FILTER (WHERE contains({NORMAL}, 'ment')) AS posts_with_term,
    round(count(*) FILTER (WHERE contains({NORMAL}, 'ment')) * 100.0 / count(*), 6) AS percentage FROM documents GROUP BY 1""")
def term_share(spark, sf):
    return rounded(words.term_share(_docs(spark, sf), "text", "ment", ["lang"]), ["percentage"])


KEYWORDS = [
    ("en", ["that", "with", "this", "from", "the"]),
    ("fr", ["ment", "elle", "tion", "pour", "dans"]),
    ("de", ["sich", "nicht", "heit", "eine"]),
    ("xx", ["that"]),
]


@query(f"""SELECT lang, CAST(sum(len(list_intersect({_whitespace('text')}, k))) AS BIGINT) AS matching_words_count
    FROM documents JOIN (VALUES {', '.join(f"('{lang}', [{_quoted(k)}])" for lang, k in KEYWORDS)}) v(lang, k) USING (lang)
    GROUP BY 1""")
def community_lexicons(spark, sf):
    lexicon = rows_table(spark, KEYWORDS, "lang string, keywords array<string>")
    return words.community_lexicon_matches(_docs(spark, sf), "lang", "text", lexicon)


def _weights(tokens: str) -> str:
    return f"""WITH t AS (SELECT doc_id, unnest({tokens}) AS word FROM documents),
    tf AS (SELECT doc_id, word, count(*) AS tf FROM t GROUP BY 1, 2), d AS (SELECT word, count(*) AS df FROM tf GROUP BY 1),
    w AS (SELECT doc_id, word, tf, df, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS weight
    FROM tf JOIN d USING (word))"""


@query(f"{_weights(TOPIC)} SELECT doc_id, word, tf, df, weight AS tfidf FROM w")
def tfidf_weights(spark, sf):
    df = words.tfidf(_docs(spark, sf), "doc_id", "text", EXTRA_STOP_WORDS)
    return rounded(df, ["tfidf"])


@query(f"{_weights(ALL_TOPIC)} SELECT doc_id, word, tf, weight FROM w")
def tfidf_features(spark, sf):
    """Unpacked from the vectors that the models are fitted to."""
    features = topics.fit_features(_docs(spark, sf), "doc_id", "text", tx.topic_stop_words())
    return rounded(topics.vector_terms(features, "doc_id"), ["weight"])


DEFAULT_TOPIC = TOPIC.replace(STOP, _quoted(ENGLISH_STOP_WORDS))


@query(f"SELECT word, count(*) AS counts FROM (SELECT unnest({DEFAULT_TOPIC}) AS word FROM documents) GROUP BY 1")
def words_without_default_stop_words(spark, sf):
    tokens = words.topic_tokens(F.col("text"), tx.english_stop_words())
    counted = words.term_frequencies(_docs(spark, sf), "doc_id", tokens)
    return counted.groupBy("word").agg(F.sum("tf").alias("counts"))


# The models have no SQL of their own. Their queries report what must hold for every fit: each topic
# weighs all words and its weights sum to 1, and clusters share out all words of the corpus.
CORPUS = f"(SELECT word, count(DISTINCT doc_id) AS df, count(*) AS counts FROM (SELECT doc_id, unnest({ALL_TOPIC}) AS word FROM documents) GROUP BY 1)"


def _sums(topic_terms):
    summed = topic_terms.groupBy("topic").agg(
        F.count("*").alias("terms"), F.max("rank").cast("bigint").alias("last_rank"), F.sum("weight").alias("weight")
    )
    return rounded(summed.withColumn("topic", F.col("topic").cast("bigint")), ["weight"])


@query(f"""SELECT topic, n AS terms, n AS last_rank, 1.0::DOUBLE AS weight
    FROM (SELECT unnest(range(15)) AS topic), (SELECT count(*) AS n FROM {CORPUS})""")
def lda_topics(spark, sf):
    df = topics.lda_topics(
        _docs(spark, sf), "doc_id", "text", k=15, iterations=10, terms=None, stop_words=tx.topic_stop_words()
    )
    return _sums(df)


@query(f"SELECT word, CAST(counts AS BIGINT) AS counts FROM {CORPUS}")
def cluster_words(spark, sf):
    _, clustered = topics.cluster_documents(
        _docs(spark, sf), "doc_id", "text", k=5, stop_words=tx.topic_stop_words()
    )
    counts = topics.cluster_word_counts(clustered)
    return counts.groupBy("word").agg(F.sum("counts").alias("counts"))


@query(f"""SELECT topic, n AS terms, n AS last_rank, 1.0::DOUBLE AS weight FROM (SELECT unnest(range(10)) AS topic),
    (SELECT least(1000, count(*)) AS n FROM {CORPUS} WHERE df >= 5)""")
def nmf_topics(spark, sf):
    df = topics.nmf_topics(
        _docs(spark, sf), "doc_id", "text", vocab_size=1000, min_df=5, k=10, iterations=100, terms=None,
        stop_words=tx.topic_stop_words(),
    )
    return _sums(df)


# A model fitted to the documents, saved and loaded again, weighs the words of the conversations.
TURNS = f"""turns AS (SELECT conv_id || '/' || turn AS turn_id, {ALL_TOPIC} AS t FROM conversations WHERE text IS NOT NULL),
    fitted AS (SELECT word, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({ALL_TOPIC}) AS word FROM documents) GROUP BY 1),
    seen AS (SELECT turn_id, word, count(*) AS tf FROM (SELECT turn_id, unnest(t) AS word FROM turns) GROUP BY 1, 2)"""


def _transformed(spark, sf):
    model, _ = features.fit_model(_docs(spark, sf), "doc_id", "text", tx.topic_stop_words())
    path = unique_path(spark, "feature-model")
    model.save(path)
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    turns = turns.select(F.concat_ws("/", "conv_id", "turn").alias("turn_id"), "text")
    return features.transform(features.FeatureModel.load(spark, path), turns, "turn_id", "text")


@query(f"""WITH {TURNS} SELECT turn_id, word, tf,
    round(tf * ln(((SELECT count(*) FROM documents WHERE text IS NOT NULL) + 1) / (df + 1)), 6) AS weight FROM seen JOIN fitted USING (word)""")
def new_post_features(spark, sf):
    return rounded(_transformed(spark, sf).terms.select("turn_id", "word", "tf", "weight"), ["weight"])


@query(f"""WITH {TURNS} SELECT turn_id, CAST(coalesce(sum(tf) FILTER (df IS NOT NULL), 0) AS BIGINT) AS known_words,
    CAST(coalesce(sum(tf) FILTER (df IS NULL), 0) AS BIGINT) AS unknown_words
    FROM turns LEFT JOIN seen USING (turn_id) LEFT JOIN fitted USING (word) GROUP BY 1""")
def new_post_coverage(spark, sf):
    return _transformed(spark, sf).coverage


TERMS = f"(SELECT DISTINCT doc_id, unnest({ALL_TOPIC}) AS word FROM documents)"


@query(f"""SELECT topic, (SELECT count(DISTINCT word) FROM {TERMS}) AS words, (SELECT count(DISTINCT doc_id) FROM {TERMS}) AS documents,
    true AS loss_fell, true AS loss_is_theirs FROM (SELECT unnest(range(10)) AS topic)""")
def topic_factors(spark, sf):
    """Factors of all words. Their loss must never rise, and is computed again from the tables returned."""
    terms = topics.fit_features(_docs(spark, sf), "doc_id", "text", tx.topic_stop_words()).terms
    found = features.topic_factors(terms, "doc_id", k=10, rounds=6)
    loss, losses = features.topic_loss(terms, found, "doc_id"), found.losses
    fell = all(b <= a * (1 + 1e-9) for a, b in zip(losses, losses[1:]))
    counts = terms.agg(F.countDistinct("index").alias("words"), F.countDistinct("doc_id").alias("documents")).first()
    return found.topics.select(F.col("topic").cast("bigint").alias("topic")).distinct().select(
        "topic", F.lit(counts["words"]).alias("words"), F.lit(counts["documents"]).alias("documents"), F.lit(fell).alias("loss_fell"),
        F.lit(abs(loss - losses[-1]) <= 1e-6 * losses[-1]).alias("loss_is_theirs"),
    )


@query(f"SELECT DISTINCT doc_id, true AS nearest, true AS similarity_is_theirs FROM {TERMS}")
def spherical_clusters(spark, sf):
    """Documents and whether no emitted centroid is nearer than the one they were given."""
    terms = topics.fit_features(_docs(spark, sf), "doc_id", "text", tx.topic_stop_words()).terms
    centroids, assigned = features.cluster_terms(terms, "doc_id", k=5)
    scores = features.similarities(terms, centroids, "doc_id")
    own = F.max(F.when(F.col("cluster") == F.col("given"), F.col("similarity")))
    checked = scores.join(assigned.select("doc_id", F.col("cluster").alias("given"), F.col("similarity").alias("told")), "doc_id")
    return checked.groupBy("doc_id").agg(
        (own >= F.max("similarity") - 1e-9).alias("nearest"), (F.abs(own - F.max("told")) < 1e-9).alias("similarity_is_theirs")
    )


@query("""WITH s AS (SELECT source, string_agg(text, ' ' ORDER BY doc_id, text) AS whole FROM documents WHERE text IS NOT NULL GROUP BY 1),
    c AS (SELECT source, whole, unnest(range(0, length(whole), 50000)) AS start FROM s)
    SELECT source, start // 50000 AS chunk, start AS "offset", md5(substring(whole, start + 1, 50000)) AS text FROM c""")
def text_by_source(spark, sf):
    chunks = assembly.ordered_text(_docs(spark, sf), "source", "doc_id", "text", chunk=50_000)
    return chunks.withColumn("text", F.md5("text"))


PHRASES = {
    "common": [*LEXICON, "that", "with the", "and", "in the"],
    "long": ["in the and", "der die und in", "et la de", "the", "und die", *(f"{a} {b}" for a in ("the", "in", "und", "la") for b in ("the", "in", "und", "la"))],
    **COMMUNITY_KEYWORDS,
}
RUNS = " UNION ALL ".join(
    f"SELECT lang, unnest(list_transform(generate_series(1, len(w) - {n}), lambda i: array_to_string(w[i:i+{n}], ' '))) AS entry FROM t"
    for n in range(max(entry.count(" ") for entries in PHRASES.values() for entry in entries) + 1)
)


@query(f"""WITH t AS (SELECT lang, {WORDS} AS w FROM documents), g AS ({RUNS}),
    l AS (SELECT DISTINCT * FROM (VALUES {', '.join(f"({_quoted([name])}, {_quoted([entry])})" for name, entries in PHRASES.items() for entry in entries)}) v(lexicon, entry))
    SELECT lang, lexicon, entry, count(*) AS counts FROM g JOIN l USING (entry) GROUP BY 1, 2, 3""")
def phrases_of_all_lists(spark, sf):
    return phrases.phrase_counts(_docs(spark, sf), "text", PHRASES, ["lang"])
