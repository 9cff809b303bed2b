import pytest
from pyspark.sql import functions as F

from tallyloom.functions import cleaning as c
from tallyloom.functions import labels


@pytest.fixture(scope="module")
def apply(frame):
    def run(clean, cells):
        df = frame(list(enumerate(cells)), "i int, cell string")
        out = df.select("i", clean(F.col("cell")).alias("out")).orderBy("i").collect()
        return [row["out"] for row in out]

    return run


def test_whole_numbers(apply):
    cells = ["-", "--", None, "38 041 757", "1,234", "1.5", "many", "", "99999999999"]
    assert apply(c.parse_int, cells) == [None, None, None, 38041757, 1234, None, None, None, None]


def test_numbers(apply):
    cells = ["-", "--", None, "38 041 757", "1,234", "1.5", "many", "-2", ".5", "1e2", "1d", "5."]
    expected = [None, None, None, 38041757.0, 1234.0, 1.5, None, -2.0, 0.5, 100.0, None, 5.0]
    assert apply(c.parse_float, cells) == expected


def test_null_markers(apply):
    flag = lambda x: c.null_markers(x, labels.PROGRAMME_MARKERS)
    assert apply(flag, ["-", "-,-,-,-", "??", "yes", None, ""]) == [None, None, None, "yes", None, ""]
    assert apply(c.null_markers, ["-", "??", None]) == [None, "??", None]
    assert apply(c.lower_label, ["-", "High", None]) == [None, "high", None]


def test_currency(apply):
    cells = ["1,234 USD", "1234USD", "12 usd", "-", None, "1234", "US dollars 5", "1 234.5 CAD a"]
    assert apply(c.currency_code, cells) == ["USD", "USD", "USD", None, None, None, "DOL", "CAD"]
    amounts = [1234.0, 123.0, 12.0, None, None, None, None, 1234.5]
    assert apply(c.currency_amount, cells) == amounts
    strict = lambda x: c.currency_amount(x, strict=True)
    assert apply(strict, cells)[:3] == [1234.0, 1234.0, 12.0]


def test_text_helpers(apply):
    assert apply(c.digits_only, ["a1b22", "none", None]) == ["122", "", None]
    assert apply(c.strip_newlines, ["a\nb\r\nc"]) == ["abc"]
    assert apply(lambda x: c.strip_newlines(x, " "), ["a\nb"]) == ["a b"]
    titles = ["Health Book of New South Land 2020", "One two three", "A B C D", None]
    assert apply(c.title_entity, titles) == ["New South Land", "", "", None]
    assert apply(c.list_cell, ["['a', 'b c']", "x,y", "[]"]) == [["a", "b c"], ["x", "y"], []]
    assert apply(c.is_present, [None, ""]) == [0, 1]


@pytest.mark.parametrize(
    "table, cells, expected",
    [
        (
            labels.AUTHORITY,
            ["A dedicated authority body does  not exist", "exists but not fully functioning",
             "N", "EW", "EP", "-", None, "never seen"],
            ["N", "EP", "N", "EW", "EP", None, None, None],
        ),
        (
            labels.PAYMENT,
            ["nothing, fully insured", "Persons pay atleast 20% towards the cost of services",
             "mostly paid by individuals", "FI", "20", "M", "-", None, "never seen"],
            ["FI", "20", "M", "FI", "20", "M", None, None, None],
        ),
    ],
)
def test_label_codes(apply, table, cells, expected):
    assert apply(lambda x: c.label_code(x, table), cells) == expected


def test_share_bands(apply):
    cells = ["less-25", "25-less", "25", "26-50", "51-75", "more-75", "More-75", "-", "--", None, "x"]
    code = lambda x: c.label_code(x, labels.SHARE_BAND, c.DASHES)
    assert apply(code, cells) == [1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 4.0, None, None, None, None]
