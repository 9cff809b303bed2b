import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import conform, panel, scoring, shaping, star
from tallyloom.operators.links import extract_links
from tallyloom.operators.profile import profile


def test_rename_and_fill_are_strict(frame):
    df = frame([("x", None)], "`a b` string, c double")
    assert shaping.rename_strict(df, {"a b": "ab"}).columns == ["ab", "c"]
    with pytest.raises(ValueError, match="nope"):
        shaping.rename_strict(df, {"nope": "x"})
    with pytest.raises(ValueError):
        shaping.fill_sentinels(df, {"nope": 1})
    assert shaping.fill_sentinels(df, {"c": -1.0}).first()["c"] == -1.0
    assert shaping.clean_columns(df, {"a b": F.upper}).first()[0] == "X"


def test_outliers_need_known_measures(frame, rows):
    cells = ["100", "100.5", "101", None, "0.16", "text"]
    df = frame([(c, "1") for c in cells], "m string, n string")
    assert rows(shaping.drop_outliers(df, ["m", "n"]).select("m")) == [("0.16",), ("100",)]
    assert shaping.drop_null_measures(df, ["m", "n"]).count() == 5


def test_unmapped_labels(frame, rows):
    df = frame([("a", "A"), ("b", None), ("b", None), (None, None)], "raw string, code string")
    assert rows(shaping.unmapped_labels(df, {"raw": "code"})) == [("raw", "b", 2)]


@pytest.fixture(scope="module")
def dictionary(frame):
    return frame(
        [("Aland", "Kingdom of A", "AAA", "North"), ("Beeland", "B", "BBB", "South")],
        "country string, country_name string, country_code string, un_region string",
    )


def test_conform(frame, rows, dictionary):
    df = frame([("Aland", 1), ("??", 2), (None, 3), ("??", 4)], "name string, v int")
    added = ["country_code", "un_region"]
    out = conform.conform(df, "name", dictionary, "country", added)
    assert rows(out) == [("??", 2, None, None), ("??", 4, None, None), ("Aland", 1, "AAA", "North"), (None, 3, None, None)]
    assert conform.conform(df, "name", dictionary, "country", added, "inner").count() == 1
    assert conform.conform(df, "name", dictionary, "country", added, "right").count() == 2
    assert rows(conform.unmatched(df, "name", dictionary, "country")) == [("??", 2), (None, 1)]
    report = conform.overlap(df, "name", dictionary, "country", "country_code")
    assert rows(report) == [(2, 1, 4, 1, 1)]


def test_currency_conversion(frame):
    df = frame([(1, 10.0, "USD"), (2, 10.0, "CAD"), (3, 10.0, "ZZZ"), (4, None, "USD"), (5, 1.0, "BAD")],
               "id int, amount double, code string")
    rates = frame([("USD", "2"), ("CAD", "3"), ("BAD", "0")], "currency string, rate string")
    out = conform.convert_currency(df, "amount", "code", rates, "CAD", "cad").orderBy("id")
    assert [r["cad"] for r in out.collect()] == [15.0, 10.0, None, None, None]
    no_target = rates.where("currency <> 'CAD'")
    out = conform.convert_currency(df, "amount", "code", no_target, "CAD", "cad")
    assert {r["cad"] for r in out.collect()} == {None}


def test_dimension_spec(frame, rows):
    df = frame([("A", "1,5", "x")], "`k` string, `v($)` string, other string")
    spec = star.DimSpec("d", ["k", "v($)"], {"v($)": F.length}, {"v($)": "v_%"})
    out = star.build_dim(df, spec)
    assert out.columns == ["k", "v_%"] and rows(out) == [("A", 3)]
    with pytest.raises(ValueError):
        star.build_dim(df, star.DimSpec("d", ["missing"]))
    with pytest.raises(ValueError):
        star.build_dim(df, star.DimSpec("d", ["k"], renames={"other": "o"}))


def test_indicator_fact(frame, rows, dictionary):
    raw = frame(
        [("AAA", "1990", "5", "1"), ("AAA", "1989", "5", "1"), ("BBB", "2000", "101", "1"),
         ("BBB", "2001", "100.5", "1"), ("BBB", "2002", "7", None), ("ZZZ", "2000", "5", "1"), ("BBB", "x", "1", "1")],
        "Code string, Year string, `Raw M (%)` string, `Raw N (%)` string",
    )
    countries = dictionary.drop("country")
    names = {"Raw M (%)": "m_%", "Raw N (%)": "n_%"}
    bounded = star.build_indicator_fact(raw, countries, star.IndicatorSpec("i", names, bounded=["m_%"]))
    assert rows(bounded.select("country_code", "year", "m_%", "n_%")) == [("AAA", 1990, 5.0, 1.0), ("BBB", 2002, 7.0, None)]
    required = star.build_indicator_fact(raw, countries, star.IndicatorSpec("i", names, required=["m_%", "n_%"]))
    assert sorted(r["year"] for r in required.collect()) == [1990, 2000, 2001]


@pytest.fixture(scope="module")
def sample(frame):
    """12 countries x 4 years; one country is null throughout, two tie."""
    rng = random.Random(5)
    data = []
    for c in range(12):
        for year in (1990, 2000, 2010, 2017):
            value = None if c == 3 else (50.0 if c in (4, 5) else rng.random() * 100)
            data.append((f"c{c:02d}", f"r{c % 3}", year, value, rng.random()))
    schema = "country_name string, un_region string, year int, `m_%` double, n double"
    return data, frame(data, schema)


def mean(items):
    known = [x for x in items if x is not None]
    return sum(known) / len(known) if known else None


def test_top_bottom_series(sample):
    data, df = sample
    out = panel.top_bottom_with_mean(df, "country_name", "year", "m_%", 3).collect()
    means = {c: mean([r[3] for r in data if r[0] == c]) for c in {r[0] for r in data}}
    order = sorted(means, key=lambda c: (-(means[c] if means[c] is not None else -1), c))
    chosen = set(order[:3] + order[-3:])
    assert {r["country_name"] for r in out} == chosen | {"Mean"}
    assert "c03" in chosen  # a country without values counts as lowest
    assert len(out) == 7 * 4
    yearly = {r["year"]: r["m_%"] for r in out if r["country_name"] == "Mean"}
    assert yearly[1990] == pytest.approx(mean([r[3] for r in data if r[2] == 1990]))


def test_worst_group(sample):
    data, df = sample
    regions = {g: mean([r[3] for r in data if r[1] == g]) for g in ("r0", "r1", "r2")}
    worst = max(regions, key=regions.get)
    out = panel.worst_group_drilldown(df, "un_region", "country_name", "m_%").collect()
    assert {r["un_region"] for r in out} == {worst}
    for r in out:
        expected = mean([x[3] for x in data if x[0] == r["country_name"]])
        assert (r["m_%"] is None) if expected is None else r["m_%"] == pytest.approx(expected)


def test_growth(sample, frame):
    data, df = sample
    extra = frame([("z", "late only", 2017, 1.0, 1.0), ("y", None, 1990, 1.0, 1.0), ("y", None, 2017, 1.0, 1.0)],
                  "country_name string, un_region string, year int, `m_%` double, n double")
    out = panel.growth_between(df.unionByName(extra), "un_region", "year", ["m_%", "n"], 1990, 2017).collect()
    assert {r["un_region"] for r in out} == {"r0", "r1", "r2"}
    for r in out:
        at = lambda y: mean([x[4] for x in data if x[1] == r["un_region"] and x[2] == y])
        assert r["N growth"] == pytest.approx(at(2017) - at(1990))
    assert "M_% growth" in out[0].asDict()


def test_correlation(sample):
    import numpy as np

    data, df = sample
    out = {(r["a"], r["b"]): r["r"] for r in panel.correlation_matrix(df, ["m_%", "n", "year"]).collect()}
    known = [(r[3], r[4], r[2]) for r in data if r[3] is not None]
    assert len(out) == 9
    assert out["m_%", "n"] == pytest.approx(np.corrcoef([k[0] for k in known], [k[1] for k in known])[0, 1])
    assert out["m_%", "n"] == out["n", "m_%"] and out["n", "n"] == 1.0


def test_top_bottom_union(sample):
    _, df = sample
    out = panel.top_bottom_union(df, ["country_name"], ["m_%", "n"], 2).collect()
    assert len({r["country_name"] for r in out}) == len(out) <= 8


def test_presence(frame, rows):
    data = [("a", "yes", 1.0, 9.0), ("b", None, 2.0, 8.0), ("c", "yes", 3.0, 7.0), ("d", None, None, 6.0)]
    df = frame(data, "e string, flag string, m double, f double")
    out = panel.split_by_presence(df, "flag", "e", ["m", "f"], 1)
    assert rows(out) == [(False, "b", 2.0, 8.0), (True, "a", 1.0, 9.0), (True, "c", 3.0, 7.0)]
    means = panel.mean_by_presence(df, "flag", ["m"], "with", "without")
    assert rows(means) == [("with", 2.0), ("without", 2.0)]


def test_entity_panel_equals_plain_means(frame):
    rng = random.Random(2)
    facts = [(0 if i % 3 else rng.randint(0, 5), 2000 + i % 2, None if i % 7 == 0 else rng.random()) for i in range(200)]
    names = {k: f"e{k % 2}" for k in range(6)}
    df = frame(facts, "k int, y int, v double")
    dim = frame(list(names.items()), "id int, e string")
    out = panel.entity_panel(df, "k", F.col("y"), {"v": "v"}, dim, "id", ["e"])
    for r in out.collect():
        assert r["v"] == pytest.approx(mean([v for k, y, v in facts if names[k] == r["e"] and y == r["year"]]))


def test_scores(frame):
    df = frame([(float(i),) for i in range(1, 11)] + [(-1.0,), (None,)], "v double")
    cuts = {"v": [float(i) for i in range(1, 10)]}
    out = scoring.decile_score(df, ["v"], cuts).collect()
    got = {r["v"]: r["v_score"] for r in out}
    assert got[1.0] == 0.0 and got[2.0] == 0.11 and got[10.0] == 0.99  # a value on a cut is not above it
    assert got[-1.0] == 0.0 and got[None] == 0.0
    assert scoring.decile_score(df, ["v"], {"v": []}).first()["v_score"] == 0.0


def test_unreported_rows_take_part_in_deciles(frame):
    df = scoring.fill_unreported(frame([(None,)] * 5 + [(float(i),) for i in range(5)], "v double"), ["v"])
    out = {r["v"]: r["v_score"] for r in scoring.decile_score(df, ["v"]).collect()}
    assert out[-1.0] == 0.0 and out[0.0] == 0.55 and out[4.0] == 0.99


def test_composite(frame, rows):
    a = frame([("x", 0.5), ("y", 0.1)], "k string, s double")
    flags = frame([("x", "p", None), ("z", None, None)], "k string, f string, g string")
    b = scoring.count_present(flags, ["f", "g"], "n").select("k", "n")
    out = scoring.composite_index([a, b], "k", ["s", "n"])
    assert rows(out.select("k", "total_score")) == [("x", 1.5)]


def test_profile(frame):
    df = frame([(1, "a", dt.date(2020, 1, 1)), (1, None, None), (3, "b", None)], "n int, s string, d date")
    for approx in (False, True):
        out = {r["column"]: r for r in profile(df, approx).collect()}
        assert (out["n"]["rows"], out["n"]["nulls"], out["n"]["distinct_values"]) == (3, 0, 2)
        assert (out["s"]["nulls"], out["s"]["min"], out["s"]["max"], out["s"]["mean"]) == (1, "a", "b", None)
        assert out["d"]["type"] == "date" and out["d"]["nulls"] == 2
    assert out["n"]["mean"] == pytest.approx(5 / 3)


def test_links(frame, rows):
    html = """<A class=x HREF='one.pdf'>1</A> <a href="two.PDF?x.pdf=1">2</a> <link href="three.pdf">
    <a name="n">no</a> <a\n href = "four">4</a> <article href="five.pdf">"""
    df = frame([(1, html), (2, None)], "id int, html string")
    assert [h for _, h in rows(extract_links(df, "id", "html"))] == ["four", "one.pdf", "two.PDF?x.pdf=1"]
    assert [h for _, h in rows(extract_links(df, "id", "html", ".pdf"))] == ["one.pdf", "two.PDF?x.pdf=1"]
