import pytest
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.sources import schemas, tables
from tallyloom.sources.catalog import Catalog


def test_multiline_quoted_cells(spark, tmp_path):
    path = tmp_path / "posts.csv"
    path.write_text('a,b\n"line one\nline ""two""",2\nplain,3\n')
    df = tables.read_strings(spark, str(path), multiline=True)
    assert df.columns == ["a", "b"] and df.count() == 2
    assert {field.dataType.simpleString() for field in df.schema} == {"string"}
    typed = tables.read_table(spark, str(path), schemas.texts("a", "b"), multiline=True)
    assert [r["a"] for r in typed.orderBy("b").collect()] == ['line one\nline "two"', "plain"]


def test_schema_wins_over_header_and_bad_cells_are_null(spark, tmp_path):
    path = tmp_path / "rates.csv"
    path.write_text("country,rate\nAED,3.9\nXXX,-\n")
    assert tables.read_table(spark, str(path), schemas.RATES).columns == ["currency", "rate"]
    typed = tables.read_table(spark, str(path), "currency string, rate double").orderBy("currency")
    assert [r["rate"] for r in typed.collect()] == [3.9, None]


def test_headerless_folder(spark, tmp_path):
    for i, line in enumerate(["A,Aland,AAA,North", "B,Bland,BBB,South"]):
        (tmp_path / f"part-{i}.csv").write_text(line + "\n")
    df = tables.read_table(spark, str(tmp_path), schemas.COUNTRY_DICTIONARY, header=False)
    assert sorted(r["country_code"] for r in df.collect()) == ["AAA", "BBB"]


def test_report_is_one_file_when_small(spark, tmp_path):
    df = spark.range(1000).repartition(8).withColumn("v", F.lit("x"))
    tables.write_report(df, str(tmp_path / "report"))
    assert len(list((tmp_path / "report").glob("part-*.csv"))) == 1
    assert tables.read_strings(spark, str(tmp_path / "report")).count() == 1000


def test_round_trip_and_overwrite(spark, tmp_path):
    catalog = Catalog(str(tmp_path), str(tmp_path / "out"))
    catalog.save(spark.range(3).withColumn("a %", F.lit(1.5)), "t")
    catalog.save(spark.range(2).withColumn("a %", F.lit(2.5)), "t")
    assert catalog.table(spark, "t").columns == ["id", "a %"]
    assert catalog.table(spark, "t").count() == 2
    tables.write_table(spark.range(4).withColumn("v", F.lit(1)), str(tmp_path / "p"), partition_by=["id"])
    assert tables.read_parquet(spark, str(tmp_path / "p")).count() == 4


def test_rows_table_is_local(spark):
    df = tables.rows_table(spark, [("a", [1, 2]), (None, None)], "k string, v array<int>")
    assert [tuple(r) for r in df.collect()] == [("a", [1, 2]), (None, None)]
    assert tables.rows_table(spark, [], "k string").count() == 0
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan


def test_staged_tables_go_to_the_named_folder(spark):
    folder = spark.conf.get(session.CHECKPOINT_KEY)
    assert session.shared_folder(spark) == folder.rstrip("/")
    staged = session.stage(spark.range(5), "t")
    assert staged.count() == 5 and staged.inputFiles()[0].startswith(f"file://{folder}/staged/t-")


def test_unset_folder_is_in_the_warehouse():
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return {session.WAREHOUSE_KEY: "hdfs://x/warehouse"}.get(key, default)

    assert session.shared_folder(Session) == "hdfs://x/warehouse/_staged"


def test_staged_tables_are_deleted_on_request(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_staged", [])
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    staged = session.stage(spark.range(5), "t")
    assert staged.count() == 5 and len(list((tmp_path / "staged").iterdir())) == 1
    session.clear_staged(spark)
    assert not list((tmp_path / "staged").iterdir())


def test_headers_that_differ_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"2\n3"\n')
    (tmp_path / "b.csv").write_text("y,x\n5,4\n")
    for multiline in (True, False):
        with pytest.raises(Exception, match="header"):
            tables.read_strings(spark, str(tmp_path / "*.csv"), multiline).collect()
    (tmp_path / "b.csv").write_text("x,y\n4,5\n")
    found = tables.read_strings(spark, str(tmp_path / "*.csv"), True)
    assert sorted(map(tuple, found.collect())) == [("1", "2\n3"), ("4", "5")]


def test_sorted_reports(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = spark.range(500).select((F.col("id") * 7 % 500).alias("n"), F.lit("t").alias("s"))
        tables.write_report(df, str(tmp_path / "r"), [F.desc("n")])
    finally:
        spark.conf.set(key, before)
    files = sorted(p for p in (tmp_path / "r").iterdir() if p.name.startswith("part-"))
    lines = [line for p in files for line in p.read_text().splitlines()[1:]]
    assert len(files) > 1 and [int(line.split(",")[0]) for line in lines] == list(range(499, -1, -1))


def test_files_with_headers_of_their_own(spark, tmp_path, rows):
    from tallyloom.sources.tables import read_by_header

    (tmp_path / "a.csv").write_text('author,date,post\nann,d1,"one, two\nthree"\n')
    (tmp_path / "b.csv").write_text("post,author,date,extra\nfour,bob,d2,x\n")
    (tmp_path / "c[1].csv").write_text("date,post\nd3,five\n")
    (tmp_path / "d.csv").write_text("author,date,post\ncid,d4,six\n")
    (tmp_path / "e.csv").write_text("")
    found = read_by_header(spark, str(tmp_path / "*"), multiline=True).select("author", "date", "post", "extra")
    assert rows(found) == sorted(
        [("ann", "d1", "one, two\nthree", None), ("bob", "d2", "four", "x"), (None, "d3", "five", None), ("cid", "d4", "six", None)],
        key=repr,
    )
    with pytest.raises(ValueError, match="no file"):
        read_by_header(spark, str(tmp_path / "e.csv"))
