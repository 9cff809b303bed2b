"""The whole batch on made inputs of the declared shape."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import cross_reports, indicator_facts, panel_reports, posting_reports
from tallyloom.plans import survey_star, topic_reports
from tallyloom.plans.survey_star import ADMISSIONS, BASIC, PROGRAMMES, SURVEY_DIMS
from tallyloom.sources.catalog import Catalog

REGIONS = [f"Region {i}" for i in range(6)]
COUNTRIES = [(f"Land {i}", f"Republic of Land {i}", f"L{i:02d}", REGIONS[i % 6]) for i in range(24)]


def write(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as file:
        writer = csv.writer(file, quoting=csv.QUOTE_ALL)
        if header:
            writer.writerow(header)
        writer.writerows(rows)


def survey_cell(rng, column, i):
    if column == "population":
        return ["-", "1 234 567", "12,000"][i % 3]
    if column == "expenditure($)":
        return ["-", "1,000 USD", "500 cad", "no code"][i % 4]
    if column.startswith("service_pay"):
        return ["nothing, fully\n insured", "-", "mostly paid by individuals"][i % 3]
    if column == "dedcated_body":
        return ["A dedicated body does not exist", "-", "exists but not\nfully functioning"][i % 3]
    if column in ("follow_up", "ip_timely_servies"):
        return ["less-25", "51-75", "--", "more-75"][i % 4]
    if column in ("income_group", "who_region", "mh_inclusive_schemes", "policy", "mh_law"):
        return ["High", "Low", "-"][i % 3]
    return rng.choice(["-", "--"]) if rng.random() < 0.2 else f"{rng.randint(0, 5000):,}"


@pytest.fixture(scope="module")
def catalog(tmp_path_factory, spark):
    root = tmp_path_factory.mktemp("batch")
    rng = random.Random(11)
    inputs = root / "in"
    catalog = Catalog(str(inputs), str(root / "out"))
    at = lambda name: inputs / getattr(catalog, name)

    write(at("country_dictionary") / "part-0.csv", None, COUNTRIES)
    known = {"country_name", "country_code", "un_region"}
    columns = [c for spec in [*SURVEY_DIMS, BASIC, ADMISSIONS] for c in spec.columns if c not in known]
    columns = list(dict.fromkeys(columns))
    write(at("survey"), ["country", *columns],
          [[c[0], *[survey_cell(rng, col, i) for col in columns]] for i, c in enumerate(COUNTRIES)])
    flags = [c for c in PROGRAMMES.columns if c != "country_code"]
    write(at("programmes"), ["Country", *flags],
          [[c[0], *[rng.choice(["-", "??", "-,-,-,-", "national, running"]) for _ in flags]] for c in COUNTRIES])
    write(at("rates"), ["country", "rate"], [["USD", "1.0"], ["CAD", "1.5"]])

    panel = indicator_facts.PANEL.measures
    write(at("panel"), ["index", "Entity", "Code", "Year", *panel],
          [[0, c[1], c[2], year, *[round(rng.random() * 10, 3) for _ in panel]]
           for c in COUNTRIES for year in (-500, 1990, 2000, 2017)])
    for spec in indicator_facts.SEX_SPLITS:
        write(at(spec.name), ["Entity", "Code", "Year", *spec.measures, "Continent"],
              [[c[1], c[2], 2000, "1.5", "2.5" if i % 2 else "", ""] for i, c in enumerate(COUNTRIES)])
    write(at("suicide_dictionary") / "part-0.csv", None, [(f"Raw {i}", c[2]) for i, c in enumerate(COUNTRIES)])
    write(at("suicide"), ["country", *indicator_facts.SUICIDE.measures],
          [[f"Raw {i}", 10 + i, 116 if i == 0 else 20 + i, 5 + i] for i in range(24)] + [["Elsewhere", 1, 1, 1]])

    posts = []
    for i in range(400):
        community = rng.choice(["suicidewatch", "anxiety", "depression", "healthanxiety", "EDAnonymous"])
        day = f"{rng.choice([2018, 2019, 2020])}/{rng.randint(1, 6):02d}/{rng.randint(1, 28):02d}"
        text = " ".join(rng.choice(["help", "virus", "worthless", "give", "up", "dog", "cat", "sun", "rain\nfall"])
                        for _ in range(12))
        posts.append([community, f"u{rng.randint(0, 30)}", "bad" if i == 0 else day, text, "0.5"])
    write(inputs / "posts" / "a.csv", ["subreddit", "author", "date", "post", "feature"], posts[:200])
    write(inputs / "posts" / "b.csv", ["subreddit", "author", "date", "post", "feature"], posts[200:])
    write(inputs / "cases.csv", ["date", "cases", "deaths"],
          [[f"2020-{m:02d}-{d:02d}", m * d, 0] for m in (1, 2, 3, 4) for d in range(1, 29)])

    survey_star.run(spark, catalog)
    indicator_facts.run(spark, catalog)
    panel_reports.run(spark, catalog)
    cross_reports.run(spark, catalog)
    posting_reports.run(spark, catalog, str(inputs / "posts" / "*"), str(inputs / "cases.csv"))
    topic_reports.run(spark, catalog)
    return catalog


@pytest.fixture(scope="module")
def report(spark, catalog):
    def read(name):
        path = f"{catalog.outputs}/reports/{name}"
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)

    return read


def test_dimensions(spark, catalog):
    for spec in SURVEY_DIMS:
        df = catalog.table(spark, spec.name)
        assert df.columns == [spec.renames.get(c, c) for c in spec.columns] and df.count() == 24
    basic = {r["country_code"]: r for r in catalog.table(spark, "basic_info").collect()}
    assert basic["L01"]["population"] == 1234567 and basic["L01"]["expenditure_cad"] == 1500.0
    assert basic["L02"]["expenditure_cad"] == 500.0 and basic["L03"]["expenditure_cad"] is None
    payments = {r["country_code"]: r["pay_for_services"] for r in catalog.table(spark, "expenditure").collect()}
    assert [payments[c] for c in ("L00", "L01", "L02")] == ["FI", None, "M"]
    policies = {r["country_code"]: r["dedicated_authority"] for r in catalog.table(spark, "policies").collect()}
    assert [policies[c] for c in ("L00", "L01", "L02")] == ["N", None, "EP"]
    bands = {r["country_code"]: r["follow_up_post_discharge"] for r in catalog.table(spark, "admissions").collect()}
    assert [bands[c] for c in ("L00", "L01", "L02", "L03")] == [1.0, 3.0, None, 4.0]
    programmes = catalog.table(spark, "programmes")
    assert programmes.columns[-1] == "country_code"
    assert {r[0] for r in programmes.collect()} <= {None, "national, running"}


def test_facts(spark, catalog):
    assert catalog.table(spark, "panel").count() == 24 * 3
    assert catalog.table(spark, "anxiety").count() == 12
    suicide = catalog.table(spark, "suicide")
    assert suicide.count() == 23  # one above the bound, one not in the dictionary
    assert {r["year"] for r in suicide.collect()} == {2019}


def test_panel_reports(report):
    series = report("series_schizophrenia")
    assert series.count() == 11 * 3
    assert report("growth_depression").count() == 6
    assert report("correlation").count() == 49
    worst = report("worst_un_region_anxiety_disorders")
    assert worst.select("un_region").distinct().count() == 1 and worst.count() == 4
    assert 1 <= report("suicide_by_region").count() <= 20
    assert report("countries_without_income_group").count() == 8


def test_published_suicide_columns(spark, catalog):
    fact = catalog.table(spark, "suicide")
    row = panel_reports.suicide_columns(fact, published=True).where("country_code = 'L01'").first()
    assert (row["male_suicide_%"], row["female_suicide_%"]) == (11.0, 21.0)
    row = panel_reports.suicide_columns(fact, published=False).where("country_code = 'L01'").first()
    assert (row["male_suicide_%"], row["female_suicide_%"]) == (21.0, 6.0)


def test_right_join_keeps_every_country(spark, catalog, frame):
    from pyspark.sql import functions as F

    rates = frame([("Raw 1", "1", "2", "3")], "country string, rate2019both string, rate2019male string, rate2019female string")
    dictionary = frame([("Raw 1", "L01")], "country string, country_code string")
    countries = catalog.table(spark, "country")
    assert indicator_facts.suicide_fact(rates, dictionary, countries).count() == 1
    every = indicator_facts.suicide_fact(rates, dictionary, countries, "right")
    assert every.count() == 24 and every.where(F.col("`all_suicide_%`").isNull()).count() == 23


def test_cross_reports(report):
    scores = [float(r["total_score"]) for r in report("composite_score").collect()]
    assert len(scores) == 24 and 0 <= min(scores) and max(scores) <= 14.92
    ends = [float(r["total_score"]) for r in report("top_bottom_countries").collect()]
    assert sorted(ends)[-5:] == sorted(scores)[-5:] and sorted(ends)[:5] == sorted(scores)[:5]
    assert report("mean_suicide_by_programme").count() == 2
    workforce = report("expenditure_and_workforce").collect()
    assert len(workforce) == 24 and any(float(r["govt_exp_mental_health_%_budget"]) == -1 for r in workforce)


def test_posting_reports(report):
    shares = report("posts/posts_by_community").collect()
    assert "EDAnonymous" not in {r["subreddit"] for r in shares}
    assert sum(float(r["percentage"]) for r in shares) == pytest.approx(100)
    assert report("posts/season_by_month").count() == 12
    assert {r["word"] for r in report("posts/crisis_words").collect()} == {"help", "worthless"}
    assert "give up" in {r["word"] for r in report("posts/crisis_phrases").collect()}
    assert report("posts/cases_by_month").count() == 4
    assert report("posts/case_correlation_by_community").count() == 4
    assert report("posts/profile").count() == 4


def lines_of(catalog, name):
    """Rows of a report in the order of its files."""
    from pathlib import Path

    found = []
    for path in sorted(Path(f"{catalog.outputs}/reports/{name}").glob("part-*")):
        with open(path, newline="") as file:
            found += list(csv.DictReader(file))
    return found


def test_reports_are_sorted(catalog):
    shares = [int(r["posts"]) for r in lines_of(catalog, "posts/posts_by_community")]
    assert shares == sorted(shares, reverse=True)
    months = [r["month"] for r in lines_of(catalog, "posts/posts_by_month")]
    assert months == sorted(months) and len(months) > 12
    counts = [int(r["counts"]) for r in lines_of(catalog, "topics/words_near_anchor")]
    assert counts == sorted(counts, reverse=True)


def test_matrix_trend_cloud_and_keywords(spark, catalog, report):
    posts = catalog.table(spark, "posts").where("subreddit <> 'EDAnonymous'")
    matrix = report("posts/community_month_matrix")
    assert "2019-03" in matrix.columns and matrix.count() == 4
    total = sum(int(r[c]) for r in matrix.collect() for c in matrix.columns if c != "subreddit")
    assert total == posts.where("date is not null").count()
    assert set(report("posts/daily_trend").columns) == {"date", "anxiety", "depression", "healthanxiety", "suicidewatch"}
    cloud = {r["word"] for r in report("posts/health_cloud").collect()}
    assert "virus" in cloud and not cloud & {"and", "because", "at"}
    keywords = {r["subreddit"]: int(r["matching_words_count"]) for r in report("posts/community_keywords").collect()}
    hits = posts.where("subreddit = 'depression' and array_contains(split(lower(post), '[ \\n]'), 'worthless')").count()
    assert keywords == {"depression": hits, "anxiety": 0}


def test_unmatched_names_and_labels(report):
    assert report("unmatched/survey").count() == report("unmatched/programmes").count() == 0
    assert [r["country"] for r in report("unmatched/suicide").collect()] == ["Elsewhere"]
    assert int(report("unmatched/survey_overlap").first()["matched_names"]) == 24
    assert report("unmatched/labels").columns == ["column", "label", "rows"]


def test_missing_survey_columns_are_an_error(spark, catalog, tmp_path):
    import shutil

    inputs = tmp_path / "in"
    shutil.copytree(catalog.inputs, inputs)
    path = inputs / catalog.survey
    path.write_text(path.read_text().replace('"smr_2016"', '"smr_16"'))
    other = Catalog(str(inputs), str(tmp_path / "out"))
    with pytest.raises(ValueError, match="mortality.*smr_2016"):
        survey_star.run(spark, other)
    survey_star.run(spark, other, optional=["mortality"])


def test_topic_reports(spark, catalog, report):
    assert "help" not in {r["word"] for r in report("topics/words_near_anchor").collect()}
    assert report("topics/lda").select("topic").distinct().count() == 15
    clustered = catalog.table(spark, "clustered_posts")
    assert spark.read.text(catalog.table_path("cluster_text")).count() == clustered.count()
    keys = catalog.table(spark, "posts").select("post_id")
    assert keys.distinct().count() == keys.count()
    words = catalog.table(spark, "cluster_documents").agg(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert words == clustered.agg(F.sum(F.greatest(F.size("filtered_words"), F.lit(1)))).first()[0]


def test_new_posts_are_scored_by_saved_models(spark, catalog):
    posts = catalog.table(spark, "posts").where("subreddit = 'suicidewatch' AND post IS NOT NULL")
    known = {r["post_id"]: (r["cluster"], r["similarity"]) for r in catalog.table(spark, "post_clusters").collect()}
    nearest, coverage = topic_reports.score_posts(spark, catalog, posts)
    for row in nearest.collect():
        assert row["similarity"] == pytest.approx(known[row["post_id"]][1])
    assert coverage.where("unknown_words > 0").isEmpty()


def test_equal_posts_count_as_posts_of_their_own(spark, catalog, tmp_path):
    from tallyloom.operators import features, topics
    from tallyloom.plans.posting_reports import KEY, with_key

    rows = [("a", "d", "sun sea")] * 2 + [("b", "d", "stock bond"), ("c", "d", "bread oven"), ("d", "d", "sea wave")]
    with_key(spark.createDataFrame(rows, "author string, date string, post string")).write.parquet(str(tmp_path / "posts"))
    posts = spark.read.parquet(str(tmp_path / "posts"))
    fitted, weighed = features.fit_model(posts, KEY, "post", [])
    assert {r["word"]: r["df"] for r in fitted.words.collect()}["sea"] == 3
    _, clustered = topics.cluster_posts(posts, KEY, "post", k=2, stop_words=[], features=weighed)
    assert clustered.count() == 5
    counts = {r["word"]: r["counts"] for r in topics.cluster_word_counts(clustered).groupBy("word").agg(F.sum("counts").alias("counts")).collect()}
    assert counts["sun"] == 2 and counts["sea"] == 3
