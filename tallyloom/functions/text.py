"""Text expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.lexicons import ENGLISH_STOP_WORDS, EXTRA_STOP_WORDS

# Characters kept by `normalise`; both word classes are ASCII.
KEPT = {"word": r"[^\w\s]", "letters": r"[^a-zA-Z\s]"}


BLANKS = " \t\n\x0b\f\r"


def normalise(c: Column, keep: str = "word") -> Column:
    """Lower case without punctuation. `keep` is `word` (letters, digits, `_`) or `letters`."""
    return F.regexp_replace(F.lower(c), KEPT[keep], "")


def tokenise(c: Column, mode: str = "blank", keep_empty: bool = True) -> Column:
    """Array of tokens.

    `blank` cuts at each blank. `whitespace` lowers the text, cuts at each whitespace character
    and has no empty tokens at the end, as Spark ML's tokenizer does.
    """
    if mode == "blank":
        tokens = F.split(c, " ", -1)
    elif mode == "whitespace":
        text = F.rtrim(F.lower(c), F.lit(BLANKS))
        no_token = F.array().cast("array<string>")
        tokens = F.coalesce(
            F.split(F.nullif(text, F.lit("")), r"\s", -1),
            F.when(c == "", F.array(F.lit(""))).when(c.isNotNull(), no_token),
        )
    else:
        raise ValueError("mode must be 'blank' or 'whitespace'")
    return tokens if keep_empty else F.filter(tokens, lambda token: token != "")


def phrases(tokens: Column, length: int) -> Column:
    """Every run of `length` adjacent tokens, joined by a blank.

    Shifted copies of the array are zipped, which takes one walk per word of the phrase. Pass a
    column rather than a long expression: it is referred to `length` times.
    """
    runs = F.greatest(F.size(tokens) - (length - 1), F.lit(0))
    grams = F.slice(tokens, F.lit(1), runs)
    for start in range(2, length + 1):
        following = F.slice(tokens, F.lit(start), runs)
        grams = F.zip_with(grams, following, lambda a, b: F.concat_ws(" ", a, b))
    return grams


def without_words(tokens: Column, words: Iterable[str], lowered: bool = False) -> Column:
    """Drop stop words whatever their case; other tokens keep their order and number.

    Say `lowered` when the tokens are in lower case already.
    """
    drop = sorted({word.lower() for word in words})
    return F.filter(tokens, lambda token: ~(token if lowered else F.lower(token)).isin(*drop))


def only_words(tokens: Column, words: Iterable[str]) -> Column:
    keep = sorted(set(words))
    return F.filter(tokens, lambda token: token.isin(*keep))


def lower_tokens(tokens: Column) -> Column:
    return F.transform(tokens, lambda token: F.lower(token))


def english_stop_words(extra: Iterable[str] = ()) -> list[str]:
    """Spark's English list plus additions."""
    return ENGLISH_STOP_WORDS + list(extra)


def topic_stop_words() -> list[str]:
    """The list used before topic mining."""
    return english_stop_words(EXTRA_STOP_WORDS)
