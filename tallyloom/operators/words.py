"""Word counting over whole texts.

Filtering happens inside the token array, before it is exploded, so only wanted words become rows;
counts are combined on the map side, so a word that fills the corpus is one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tallyloom.functions.text import (
    BLANKS,
    normalise,
    only_words,
    phrases,
    tokenise,
    without_words,
)
from tallyloom.operators.joins import join_by_frequency
from tallyloom.operators.shaping import col, require
from tallyloom.session import stage


def lexicon_tokens(tokens: Column, lexicon: Sequence[str], mode: str = "token") -> Column:
    """Tokens found in the lexicon, repeats kept.

    `token` compares single tokens, so an entry of several words never matches; `phrase` compares
    runs of adjacent tokens as long as each entry.
    """
    if mode == "token":
        return only_words(tokens, lexicon)
    if mode != "phrase":
        raise ValueError("mode must be 'token' or 'phrase'")
    def size(entry: str) -> int:
        return len(entry.split(" "))

    by_length = groupby(sorted(set(lexicon), key=size), size)
    found = [only_words(phrases(tokens, length), list(entries)) for length, entries in by_length]
    return found[0] if len(found) == 1 else F.concat(*found)


def lexicon_counts(
    df: DataFrame, text: str, lexicon: Sequence[str], by: Sequence[str] = (), mode: str = "token"
) -> DataFrame:
    """Occurrences of lexicon entries in lower-cased text without punctuation: (by, word, counts)."""
    require(df, [text, *by])
    keys = [col(name) for name in by]
    hits = lexicon_tokens(F.col("_tokens"), lexicon, mode)
    return (
        df.select(*keys, tokenise(normalise(col(text))).alias("_tokens"))
        .select(*keys, F.explode(hits).alias("word"))
        .groupBy(*keys, "word")
        .agg(F.count("*").alias("counts"))
    )


def lexicon_hits(
    df: DataFrame, text: str, lexicon: Sequence[str], by: Sequence[str], to: str = "hits"
) -> DataFrame:
    """Number of lexicon tokens per group: (by, hits), groups without any left out.

    Rows are counted where they stand; only rows with a hit are shuffled.
    """
    require(df, [text, *by])
    keys = [col(name) for name in by]
    hits = F.size(only_words(tokenise(normalise(col(text))), lexicon))
    return (
        df.select(*keys, hits.alias("_hits"))
        .where("_hits > 0")
        .groupBy(*keys)
        .agg(F.sum("_hits").alias(to))
    )


def word_list(
    df: DataFrame, text: str, stop_words: Sequence[str] = (), keep: str = "word"
) -> DataFrame:
    """Every word of the corpus as a row: the feed of a word cloud. Stop words are optional."""
    require(df, [text])
    words = df.select(F.explode(tokenise(normalise(col(text), keep))).alias("word"))
    drop = sorted({word.lower() for word in stop_words})
    return words.where(~F.col("word").isin(*drop)) if drop else words


def word_counts(
    df: DataFrame, text: str, stop_words: Sequence[str] = (), keep: str = "word"
) -> DataFrame:
    """Occurrences of each word: (word, counts)."""
    return word_list(df, text, stop_words, keep).groupBy("word").agg(F.count("*").alias("counts"))


def topic_tokens(text: Column, stop_words: Sequence[str]) -> Column:
    """Tokens as topic mining sees them: letters only, cut at whitespace, stop words dropped."""
    return without_words(tokenise(normalise(text, "letters"), "whitespace"), stop_words, lowered=True)


_CAPITALS = bytes(range(65, 91))
_BLANKS = BLANKS.encode()
#: What `normalise` keeps of a text's bytes, blanks made alike. Of the letters beyond ASCII two have
#: ASCII letters in lower case.
_LOWER = bytes.maketrans(_CAPITALS + _BLANKS, _CAPITALS.lower() + b" " * len(_BLANKS))
_LEFT_OUT = bytes(set(range(256)) - set(_CAPITALS + _CAPITALS.lower() + _BLANKS))
_BEYOND_ASCII = (("\u212a".encode(), b"k"), ("\u0130".encode(), b"i"))
#: Texts that are cut together.
_TEXTS = 512


def _cut(texts: pa.Array, drop: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """`topic_tokens` of texts: the text and the number of each token, and the words of the numbers."""
    cleaned = []
    for text in texts.cast(pa.binary()).to_pylist():
        if text is not None:
            for old, new in _BEYOND_ASCII:
                text = text.replace(old, new)
            kept = text.translate(_LOWER, _LEFT_OUT)
            text = kept.rstrip(b" ") or (None if kept else kept)
        cleaned.append(text)
    tokens = pc.split_pattern(pa.array(cleaned, pa.binary()).cast(pa.large_string()), " ")
    encoded = tokens.flatten().dictionary_encode()
    lengths = pc.list_value_length(tokens).fill_null(0).to_numpy(zero_copy_only=False)
    text, code = np.repeat(np.arange(len(lengths)), lengths), encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = encoded.dictionary.cast(pa.string())
    kept = ~pc.is_in(words, drop).to_numpy(zero_copy_only=False)[code]
    return text[kept], code[kept], words


def _in_arrow(df: DataFrame, id: str, text: str, stop_words: Sequence[str], made: Callable, fields: list[StructField]) -> DataFrame:
    """`made(ids, text, code, words)` of the tokens of every few texts, as columns beside the id."""
    drop = pa.array(sorted({word.lower() for word in stop_words}), pa.string())
    schema = StructType([df.schema[id], *fields])

    def cut(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                yield pa.RecordBatch.from_arrays(made(part.column(0), *_cut(part.column(1), drop)), names=schema.names)

    return df.select(col(id), col(text)).mapInArrow(cut, schema)


def document_terms(df: DataFrame, id: str, text: str, stop_words: Sequence[str]) -> DataFrame:
    """(id, word, tf) of `topic_tokens`, for ids that name one document each: texts are cut and counted
    where they stand, in Arrow batches, and nothing is shuffled."""

    def counted(ids, text, code, words):
        cells, tf = np.unique(text * max(1, len(words)) + code, return_counts=True)
        text, code = np.divmod(cells, max(1, len(words)))
        return [ids.take(pa.array(text)), words.take(pa.array(code)), pa.array(tf)]

    return _in_arrow(df, id, text, stop_words, counted, [StructField("word", StringType()), StructField("tf", LongType())])


def document_tokens(df: DataFrame, id: str, text: str, stop_words: Sequence[str], to: str) -> DataFrame:
    """(id, to): the `topic_tokens` of texts that are not null, cut in Arrow batches."""

    def listed(ids, text, code, words):
        ends = np.searchsorted(text, np.arange(len(ids) + 1)).astype(np.int32)
        return [ids, pa.ListArray.from_arrays(pa.array(ends), words.take(pa.array(code)))]

    known = df.where(col(text).isNotNull())
    return _in_arrow(known, id, text, stop_words, listed, [StructField(to, ArrayType(StringType()))])


def cooccurrence(
    df: DataFrame, text: str, anchor: str, stop_words: Sequence[str] = ()
) -> DataFrame:
    """Words of the posts that contain the anchor, the anchor left out: (word, counts)."""
    require(df, [text])
    tokens = F.col("_tokens")
    # The test sits in the exploded expression: as a filter it would be pushed below the
    # projection and the text would be cut into tokens twice.
    others = F.filter(tokens, lambda token: token != anchor)
    return (
        df.select(topic_tokens(col(text), stop_words).alias("_tokens"))
        .select(F.explode(F.when(F.array_contains(tokens, anchor), others)).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("counts"))
    )


def term_share(df: DataFrame, text: str, term: str, by: Sequence[str] = ()) -> DataFrame:
    """Posts containing the term as a substring of their normalised text:
    (by, posts, posts_with_term, percentage)."""
    require(df, [text, *by])
    has = normalise(col(text)).contains(term)
    counted = df.groupBy(*[col(name) for name in by]).agg(
        F.count("*").alias("posts"), F.count_if(has).alias("posts_with_term")
    )
    return counted.withColumn(
        "percentage", F.try_divide(F.col("posts_with_term") * 100.0, F.col("posts"))
    )


def community_lexicon_matches(
    df: DataFrame, community: str, text: str, lexicon: DataFrame, keywords: str = "keywords"
) -> DataFrame:
    """Keyword matches per community against its own list: (community, matching_words_count).

    A keyword counts once per post. `lexicon` has the community and an array of keywords, one row per
    community, and is small by nature: it is inlined, so posts are matched where they stand and only
    sums are shuffled, however few the communities. Only communities in both tables are reported.
    """
    require(df, [community, text])
    require(lexicon, [community, keywords])
    lists = lexicon.select(col(community), col(keywords)).where(col(community).isNotNull()).collect()
    if not lists:
        return df.limit(0).select(col(community), F.lit(0).cast("bigint").alias("matching_words_count"))
    if len({row[0] for row in lists}) < len(lists):
        raise ValueError("a community has more than one keyword list")
    known = F.create_map(
        *[x for name, own in lists for x in (F.lit(name), F.array(*map(F.lit, own or [])).cast("array<string>"))]
    )
    matched = df.where(col(community).isin(*[row[0] for row in lists])).select(
        col(community),
        F.size(
            F.array_intersect(tokenise(col(text), "whitespace"), known[col(community)])
        ).alias("_matches"),
    )
    return matched.groupBy(col(community)).agg(F.sum("_matches").alias("matching_words_count"))


def term_frequencies(df: DataFrame, id: str, tokens: Column, dealt: bool = False) -> DataFrame:
    """(id, word, tf) for each document and word.

    `dealt` deals texts to tasks by id and counts where they lie, so that no (document, word) row is
    shuffled. It is for ids that name few documents each: those of one id are counted by one task.
    """
    rows = df.repartition(col(id)) if dealt else df
    return (
        rows.select(col(id), F.explode(tokens).alias("word"))
        .groupBy(col(id), "word")
        .agg(F.count("*").alias("tf"))
    )


def few_per_id(df: DataFrame, id: str) -> tuple[int, bool]:
    """The number of rows, and whether no id has more than a thousandth of them."""
    same = df.groupBy(col(id)).agg(F.count("*").alias("n"))
    rows, most = same.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    return rows, most <= 1 or most * 1000 <= rows


#: Words joined by broadcast are fewer than this, those with a larger share of the rows than its inverse.
HOT_WORDS = 50_000


def tfidf(df: DataFrame, id: str, text: str, stop_words: Sequence[str] = ()) -> DataFrame:
    """TF-IDF of every word of every document: (id, word, tf, df, tfidf).

    idf = ln((documents + 1) / (df + 1)). The (document, word) table is staged in the shared folder
    first, since several steps read it: texts are cut into tokens once, and where no id names more than
    a thousandth of the documents, counted where texts are dealt to. Word frequencies are known
    before the join, so common words are joined by broadcast and only rare ones by a shuffle.
    """
    require(df, [id, text])
    tokens = topic_tokens(col(text), stop_words)
    documents, few = few_per_id(df, id)
    terms = stage(term_frequencies(df, id, tokens, dealt=few), "terms")
    words = stage(terms.groupBy("word").agg(F.count("*").alias("df")), "word-counts")
    joined = join_by_frequency(terms, words, "word", "df", hot_keys=HOT_WORDS)
    idf = F.ln((documents + 1) / (F.col("df") + 1))
    return joined.select(col(id), "word", "tf", "df", (F.col("tf") * idf).alias("tfidf"))
