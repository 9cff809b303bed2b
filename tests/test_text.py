import random

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from tallyloom.functions import dates, text

TEXTS = ["It's  FINE, ok\n", "Élan vital", "", " ", "\t\n ", " lead", "a b c d", None, "trail  "]


@pytest.fixture(scope="module")
def posts(frame):
    return frame(list(enumerate(TEXTS)), "id int, text string")


def column(df, expression):
    return [r["out"] for r in df.select("id", expression.alias("out")).orderBy("id").collect()]


def test_normalise(posts):
    assert column(posts, text.normalise(F.col("text")))[:2] == ["its  fine ok\n", "lan vital"]
    digits = text.normalise(F.lit("a1_b"), "letters")
    assert column(posts.limit(1), digits) == ["ab"]


def test_blank_tokens_keep_empties(posts):
    tokens = column(posts, text.tokenise(F.col("text")))
    assert tokens[0] == ["It's", "", "FINE,", "ok\n"]
    assert tokens[8] == ["trail", "", ""]
    known = column(posts, text.tokenise(F.col("text"), keep_empty=False))
    assert known[8] == ["trail"]


def test_whitespace_tokens_equal_ml_tokenizer(posts):
    known = posts.where("text is not null")
    expected = Tokenizer(inputCol="text", outputCol="out").transform(known).orderBy("id").collect()
    assert column(known, text.tokenise(F.col("text"), "whitespace")) == [r["out"] for r in expected]
    assert column(posts, text.tokenise(F.col("text"), "whitespace"))[7] is None


def test_stop_words_equal_ml_remover(posts, spark):
    df = posts.where("text is not null").select("id", F.split("text", " ").alias("t"))
    words = ["FINE,", "a", ""]
    remover = StopWordsRemover(inputCol="t", outputCol="out", stopWords=words)
    expected = [r["out"] for r in remover.transform(df).orderBy("id").collect()]
    assert column(df, text.without_words(F.col("t"), words)) == expected
    assert len(text.english_stop_words()) > 150
    assert "im" in text.topic_stop_words()


def test_phrases_against_brute_force(frame):
    rng = random.Random(3)
    rows = [(i, [rng.choice("abc") for _ in range(i)]) for i in range(8)]
    df = frame(rows, "id int, t array<string>")
    for n in (1, 2, 3):
        expected = [[" ".join(t[i:i + n]) for i in range(len(t) - n + 1)] for _, t in rows]
        assert column(df, text.phrases(F.col("t"), n)) == expected


def test_lower_tokens(frame):
    df = frame([(0, ["Ab", "C"])], "id int, t array<string>")
    assert column(df, text.lower_tokens(F.col("t"))) == [["ab", "c"]]


def test_dates(frame):
    import datetime as dt

    df = frame(list(enumerate(["2019/03/05", "bad", None, "2019-03-05"])), "id int, text string")
    day = dt.date(2019, 3, 5)
    assert column(df, dates.parse_date(F.col("text"))) == [day, None, None, None]
    assert dates.month_bounds(2020, 1, 4) == (dt.date(2020, 1, 1), dt.date(2020, 4, 30))
    assert dates.month_bounds(2019, 12, 12) == (dt.date(2019, 12, 1), dt.date(2019, 12, 31))
    years = frame(list(enumerate(["1990", "-3000", "2024", "x", None])), "id int, text string")
    assert column(years, dates.in_years(F.col("text"), 1990, 2023)) == [True, False, False, False, False]


def test_season_keeps_the_last_day(spark):
    df = spark.sql(
        "select id, cast(t as timestamp) t from values (0, '2018-01-01 00:00:00'), (1, '2018-04-30 23:59:59'),"
        " (2, '2018-05-01 00:00:00'), (3, '2019-02-01 00:00:00'), (4, '2021-02-01 00:00:00') v(id, t)"
    )
    season = dates.in_season(F.col("t"), 1, 4, [2018, 2019])
    assert [r["id"] for r in df.where(season).orderBy("id").collect()] == [0, 1, 3]
