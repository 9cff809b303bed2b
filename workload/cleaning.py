"""Cell cleaning, filters, conforming, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import cleaning as clean
from tallyloom.functions.dates import in_season, in_years
from tallyloom.operators.conform import conform, convert_currency, name_list, overlap, unmatched
from tallyloom.operators.links import extract_links, resolved_links
from tallyloom.operators.profile import profile
from tallyloom.operators.shaping import (
    clean_columns,
    drop_null_measures,
    drop_outliers,
    enrich,
    exclude,
    fill_sentinels,
    rename_strict,
    unmapped_labels,
)
from tallyloom.operators.star import DimSpec, IndicatorSpec, build_dim, build_indicator_fact
from tallyloom.operators.suggest import suggest_entries
from tallyloom.sources.tables import rows_table
from workload.registry import query, rounded, table

POPULATION = """CASE o_orderpriority WHEN '1-URGENT' THEN '-' WHEN '2-HIGH' THEN NULL
    WHEN '3-MEDIUM' THEN concat(o_custkey, ' ', o_orderkey)
    WHEN '4-NOT SPECIFIED' THEN concat(o_custkey, ',', o_orderkey)
    ELSE concat(o_orderkey, '.5') END"""


@query(f"""SELECT o_orderkey, CASE WHEN regexp_matches(t, '^[0-9]+$') THEN TRY_CAST(t AS INTEGER) END AS population
    FROM (SELECT o_orderkey, regexp_replace({POPULATION}, '[ ,]', '', 'g') AS t FROM orders)""")
def parse_population(spark, sf):
    text = F.expr(POPULATION)
    return table(spark, sf, "orders").select("o_orderkey", clean.parse_int(text).alias("population"))


MEASURE = """CASE o_orderpriority WHEN '1-URGENT' THEN '-' WHEN '2-HIGH' THEN '--'
    WHEN '3-MEDIUM' THEN concat(o_custkey, ',', o_orderkey, '.25')
    WHEN '4-NOT SPECIFIED' THEN concat(o_orderkey, ' units') ELSE concat(' ', o_custkey) END"""


@query(f"""SELECT o_orderkey, TRY_CAST(regexp_replace({MEASURE}, '[ ,]', '', 'g') AS DOUBLE) AS measure FROM orders""")
def parse_measures(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", clean.parse_float(F.expr(MEASURE)).alias("measure")
    )


@query("""SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS text,
    lower(nullif(c_mktsegment, 'MACHINERY')) AS label,
    CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN NULL ELSE c_mktsegment END AS flag FROM customer""")
def clean_labels(spark, sf):
    segment = F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        "c_custkey",
        clean.null_markers(segment, ["MACHINERY"]).alias("text"),
        clean.lower_label(segment, ["MACHINERY"]).alias("label"),
        clean.null_markers(segment, ["MACHINERY", "BUILDING"]).alias("flag"),
    )


MONEY = """CASE o_orderstatus WHEN 'O' THEN concat(o_custkey, ',', o_orderkey, ' usd')
    WHEN 'F' THEN concat(o_orderkey, '10EUR') ELSE '-' END"""


@query(f"""SELECT o_orderkey, nullif(regexp_extract(upper(t), '[A-Z]{{3}}'), '') AS currency,
    TRY_CAST(regexp_replace(regexp_extract(upper(t), '^(.*?).[A-Z]{{3}}', 1), '[ ,]', '', 'g') AS DOUBLE) AS amount,
    TRY_CAST(regexp_replace(regexp_extract(upper(t), '^(.*?)[A-Z]{{3}}', 1), '[ ,]', '', 'g') AS DOUBLE) AS strict_amount
    FROM (SELECT o_orderkey, {MONEY} AS t FROM orders)""")
def currency_text(spark, sf):
    text = F.expr(MONEY)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        clean.currency_code(text).alias("currency"),
        clean.currency_amount(text).alias("amount"),
        clean.currency_amount(text, strict=True).alias("strict_amount"),
    )


@query("""SELECT doc_id, regexp_replace(text, '[^0-9]+', '', 'g') AS digits,
    md5(regexp_replace(text, '[\n\r]', ' ', 'g')) AS one_line FROM documents""")
def digits_and_newlines(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        clean.digits_only(text).alias("digits"),
        F.md5(clean.strip_newlines(text, " ")).alias("one_line"),
    )


PRIORITY = {"1-URGENT": "U", "2-HIGH": "H", "3-MEDIUM": "M", "5-LOW": "L"}


def _coded_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        clean.label_code(F.col("o_orderpriority"), PRIORITY, ["5-LOW"]).alias("code"),
    )


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'H'
    WHEN '3-MEDIUM' THEN 'M' END AS code FROM orders""")
def label_codes(spark, sf):
    return _coded_orders(spark, sf).select("o_orderkey", "code")


@query("""SELECT 'o_orderpriority' AS "column", o_orderpriority AS label, count(*) AS rows FROM orders
    WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') GROUP BY 2""")
def unmapped_label_report(spark, sf):
    return unmapped_labels(_coded_orders(spark, sf), {"o_orderpriority": "code"})


@query("""SELECT p_partkey, array_to_string(list_slice(w, 4, len(w) - 1), ' ') AS entity
    FROM (SELECT p_partkey, string_split(concat('One Two Three ', p_name, ' ', p_type, ' 2020'), ' ') AS w FROM part)""")
def title_entities(spark, sf):
    title = F.expr("concat('One Two Three ', p_name, ' ', p_type, ' 2020')")
    return table(spark, sf, "part").select("p_partkey", clean.title_entity(title).alias("entity"))


@query("""SELECT p_partkey, list_transform(string_split(concat(p_name, ',', p_type), ','), lambda x: trim(x))[2] AS second,
    2 AS items FROM part""")
def list_cells(spark, sf):
    cell = F.expr("""concat("['", p_name, "', '", p_type, "']")""")
    items = clean.list_cell(cell)
    return table(spark, sf, "part").select(
        "p_partkey", F.element_at(items, 2).alias("second"), F.size(items).alias("items")
    )


@query("""SELECT c_custkey AS id, lower(c_name) AS name, coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, -1) AS balance,
    coalesce(nullif(lower(c_mktsegment), 'machinery'), 'no_info') AS segment FROM customer""")
def reshaped_customers(spark, sf):
    df = table(spark, sf, "customer").drop("c_nationkey")
    cleaned = clean_columns(
        df,
        {
            "c_name": F.lower,
            "c_acctbal": lambda c: F.when(c >= 0, c),
            "c_mktsegment": lambda c: clean.lower_label(c, ["MACHINERY"]),
        },
    )
    renamed = rename_strict(
        cleaned,
        {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"},
    )
    return fill_sentinels(renamed, {"balance": -1.0, "segment": "no_info"})


@query("""SELECT l_orderkey, l_linenumber, q AS quantity, p AS price FROM
    (SELECT l_orderkey, l_linenumber, nullif(l_quantity, 7) AS q, l_extendedprice / 1000 AS p, l_shipdate FROM lineitem)
    WHERE year(l_shipdate) BETWEEN 1996 AND 1999 AND q IS NOT NULL AND q <= 45 AND p <= 90""")
def measure_filters(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("nullif(l_quantity, 7)").alias("quantity"),
        (F.col("l_extendedprice") / 1000).alias("price"),
        F.date_format("l_shipdate", "yyyy").alias("year"),
    )
    kept = df.where(in_years(F.col("year"), 1996, 1999))
    kept = drop_outliers(drop_outliers(kept, ["quantity"], 45), ["price"], 90)
    return drop_null_measures(kept, ["quantity", "price"]).drop("year")


@query("""SELECT o_orderkey FROM orders WHERE month(o_orderdate) BETWEEN 1 AND 4
    AND year(o_orderdate) IN (1995, 1996, 1997)""")
def season_window(spark, sf):
    df = table(spark, sf, "orders")
    return df.where(in_season(F.col("o_orderdate"), 1, 4, [1995, 1996, 1997])).select("o_orderkey")


@query("SELECT event_id, event_type FROM events WHERE event_type <> 'error'")
def excluded_community(spark, sf):
    return exclude(table(spark, sf, "events"), "event_type", ["error"]).select(
        "event_id", "event_type"
    )


def _nations(spark, sf):
    """The entity dictionary: raw name, official name, code, region."""
    region = table(spark, sf, "region")
    return enrich(
        table(spark, sf, "nation").withColumn("r_regionkey", F.col("n_regionkey")),
        region,
        ["r_regionkey"],
        ["r_name"],
    ).select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("entry"),
        F.col("n_name").alias("country_name"),
        F.col("n_nationkey").alias("country_code"),
        F.col("r_name").alias("un_region"),
    )


def _named_customers(spark, sf):
    """Customers with a raw nation name; nations 20 and up are spelt in a way the dictionary lacks."""
    return table(spark, sf, "customer").withColumn(
        "raw_name",
        F.when(F.col("c_nationkey") < 20, F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))
        .otherwise(F.concat(F.lit("?"), F.col("c_nationkey").cast("string"))),
    )


NAMED = """named AS (SELECT *, CASE WHEN c_nationkey < 20 THEN concat('N', c_nationkey) ELSE concat('?', c_nationkey) END
    AS raw_name FROM customer), dict AS (SELECT concat('N', n_nationkey) AS entry, n_name AS country_name,
    n_nationkey AS country_code, r_name AS un_region FROM nation JOIN region ON n_regionkey = r_regionkey)"""


@query(f"""WITH {NAMED} SELECT c_custkey, raw_name, country_name, country_code, un_region
    FROM named LEFT JOIN dict ON raw_name = entry""")
def conformed_entities(spark, sf):
    added = ["country_name", "country_code", "un_region"]
    df = conform(_named_customers(spark, sf), "raw_name", _nations(spark, sf), "entry", added)
    return df.select("c_custkey", "raw_name", *added)


@query(f"""WITH {NAMED} SELECT country_name, count(c_custkey) AS customers FROM named RIGHT JOIN dict ON raw_name = entry
    GROUP BY 1""")
def all_entities_kept(spark, sf):
    df = conform(
        _named_customers(spark, sf), "raw_name", _nations(spark, sf), "entry", ["country_name"], "right"
    )
    return df.groupBy("country_name").agg(F.count("c_custkey").alias("customers"))


@query(f"WITH {NAMED} SELECT raw_name, count(*) AS rows FROM named WHERE raw_name NOT IN (SELECT entry FROM dict) GROUP BY 1")
def unmatched_entities(spark, sf):
    return unmatched(_named_customers(spark, sf), "raw_name", _nations(spark, sf), "entry")


@query(f"WITH {NAMED} SELECT raw_name, count(*) AS rows FROM named GROUP BY 1")
def entity_list(spark, sf):
    return name_list(_named_customers(spark, sf), "raw_name")


@query(f"""WITH {NAMED} SELECT count(DISTINCT raw_name) AS names, count(DISTINCT entry) AS matched_names,
    count(*) AS rows, count(entry) AS matched_rows, count(DISTINCT country_code) AS codes
    FROM named LEFT JOIN dict ON raw_name = entry""")
def entity_overlap(spark, sf):
    return overlap(
        _named_customers(spark, sf), "raw_name", _nations(spark, sf), "entry", "country_code"
    )


RATES = [("USD", "1.25"), ("EUR", "0.8"), ("CAD", "1.5")]


@query("""SELECT o_orderkey, round(o_totalprice / CASE o_orderstatus WHEN 'O' THEN 1.25 WHEN 'F' THEN 0.8 END * 1.5, 6)
    AS total_cad FROM orders""")
def converted_currency(spark, sf):
    df = table(spark, sf, "orders").withColumn(
        "currency",
        F.expr("CASE o_orderstatus WHEN 'O' THEN 'USD' WHEN 'F' THEN 'EUR' ELSE 'XXX' END"),
    )
    rates = rows_table(spark, RATES, "currency string, rate string")
    done = convert_currency(df, "o_totalprice", "currency", rates, "CAD", "total_cad")
    return rounded(done.select("o_orderkey", "total_cad"), ["total_cad"])


@query("""SELECT c_custkey AS country_code, CAST(floor(c_acctbal) AS INTEGER) AS population,
    lower(c_mktsegment) AS income_group FROM customer""")
def customer_dimension(spark, sf):
    raw = table(spark, sf, "customer").withColumn(
        "pop", F.floor("c_acctbal").cast("string")
    )
    spec = DimSpec(
        "customer",
        ["c_custkey", "pop", "c_mktsegment"],
        {"pop": clean.parse_int, "c_mktsegment": clean.lower_label},
        {"c_custkey": "country_code", "pop": "population", "c_mktsegment": "income_group"},
    )
    return build_dim(raw, spec)


@query("""SELECT p_partkey AS id, CASE p_type WHEN 'SMALL' THEN 1.0 WHEN 'MEDIUM' THEN 2.0 WHEN 'LARGE' THEN 3.0 END AS band,
    CASE WHEN p_size = 10 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS size, p_retailprice AS price FROM part""")
def part_dimension(spark, sf):
    raw = table(spark, sf, "part").select(
        "p_partkey",
        "p_type",
        F.expr("CASE WHEN p_size = 10 THEN '--' ELSE cast(p_size AS string) END").alias("p_size"),
        F.col("p_retailprice").cast("string").alias("p_retailprice"),
    )
    bands = {"SMALL": 1.0, "MEDIUM": 2.0, "LARGE": 3.0}
    spec = DimSpec(
        "part",
        ["p_partkey", "p_type", "p_size", "p_retailprice"],
        {
            "p_type": lambda c: clean.label_code(c, bands, clean.DASHES),
            "p_size": clean.parse_float,
            "p_retailprice": clean.parse_float,
        },
        {"p_partkey": "id", "p_type": "band", "p_size": "size", "p_retailprice": "price"},
    )
    return build_dim(raw, spec)


def _country_table(spark, sf):
    return _nations(spark, sf).select("country_name", "country_code", "un_region")


COUNTRY = """country AS (SELECT n_name AS country_name, n_nationkey AS country_code, r_name AS un_region
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 22)"""


def _raw_indicator(spark, sf):
    """Line items as indicator rows of their supplier's nation, all cells as text. The codes of some
    nations are unknown to the entity table."""
    lines = table(spark, sf, "lineitem").withColumn("s_suppkey", F.col("l_suppkey"))
    return enrich(lines, table(spark, sf, "supplier"), ["s_suppkey"], ["s_nationkey"]).select(
        F.expr("CASE WHEN s_nationkey < 22 THEN s_nationkey ELSE -s_nationkey END").alias("Code"),
        F.date_format("l_shipdate", "yyyy").alias("Year"),
        F.col("l_quantity").cast("string").alias("Quantity (%)"),
        F.expr("nullif(l_discount, 0.05)").cast("string").alias("Discount (%)"),
        F.col("l_tax").cast("string").alias("Tax (%)"),
    )


@query(f"""WITH {COUNTRY} SELECT country_name, country_code, un_region, CAST(year(l_shipdate) AS INTEGER) AS year,
    l_quantity AS "quantity_%", nullif(l_discount, 0.05) AS "discount_%", l_tax AS "tax_%" FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey JOIN country ON s_nationkey = country_code
    WHERE year(l_shipdate) BETWEEN 1996 AND 1999 AND l_quantity <= 40 AND l_tax IS NOT NULL""")
def indicator_panel(spark, sf):
    """Bounded panel: the discount is left out of the bounded measures, so its nulls stay."""
    spec = IndicatorSpec(
        "panel",
        {"Quantity (%)": "quantity_%", "Discount (%)": "discount_%", "Tax (%)": "tax_%"},
        years=(1996, 1999),
        bounded=["quantity_%", "tax_%"],
        bound=40,
    )
    countries = _country_table(spark, sf)
    return build_indicator_fact(_raw_indicator(spark, sf), countries, spec)


@query(f"""WITH {COUNTRY} SELECT country_name, country_code, un_region, CAST(year(l_shipdate) AS INTEGER) AS year,
    l_discount AS "male_%", l_tax AS "female_%" FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey JOIN country ON s_nationkey = country_code
    WHERE l_discount <> 0.05 AND year(l_shipdate) BETWEEN 1990 AND 2023""")
def indicator_by_sex(spark, sf):
    """Two measures, rows lacking either dropped."""
    spec = IndicatorSpec(
        "sex", {"Discount (%)": "male_%", "Tax (%)": "female_%"}, required=["male_%", "female_%"]
    )
    countries = _country_table(spark, sf)
    return build_indicator_fact(_raw_indicator(spark, sf), countries, spec)


@query(f"""WITH {COUNTRY} SELECT country_name, country_code, un_region, CAST(2019 AS INTEGER) AS year,
    c_acctbal / 10 AS "rate_%" FROM customer JOIN country ON c_nationkey = country_code
    WHERE c_nationkey < 20 AND c_acctbal / 10 <= 100""")
def indicator_fixed_year(spark, sf):
    """Rates without a year, conformed through their own dictionary before the entity table."""
    dictionary = _nations(spark, sf).select("entry", F.col("country_code").alias("code"))
    raw = _named_customers(spark, sf).withColumn("rate", (F.col("c_acctbal") / 10).cast("string"))
    coded = conform(raw, "raw_name", dictionary, "entry", ["code"])
    spec = IndicatorSpec(
        "rate", {"rate": "rate_%"}, code="code", year=None, years=None, fixed_year=2019, bounded=["rate_%"]
    )
    countries = _country_table(spark, sf)
    return build_indicator_fact(coded, countries, spec)


ORDER_TYPES = [
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]
NUMERIC = {"bigint", "double"}
PROFILE_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", '{kind}' AS type, count(*) AS rows, count(*) - count({name}) AS nulls,
    count(DISTINCT {name}) AS distinct_values, CAST(min({name}) AS VARCHAR) AS min, CAST(max({name}) AS VARCHAR) AS max,
    {f'round(avg({name}), 4)' if kind in NUMERIC else 'CAST(NULL AS DOUBLE)'} AS mean,
    {f'round(stddev_samp({name}), 4)' if kind in NUMERIC else 'CAST(NULL AS DOUBLE)'} AS stddev FROM orders"""
    for name, kind in ORDER_TYPES
)


@query(PROFILE_SQL)
def table_profile(spark, sf):
    return rounded(profile(table(spark, sf, "orders")), ["mean", "stddev"], 4)


LINKS = r"""SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1)) AS href FROM pages"""


@query(LINKS)
def page_links(spark, sf):
    return extract_links(table(spark, sf, "pages"), "page_id", "html")


@query(f"SELECT * FROM ({LINKS}) WHERE contains(href, '/the')")
def page_links_by_part(spark, sf):
    return extract_links(table(spark, sf, "pages"), "page_id", "html", "/the")


@query(f"""SELECT page_id, CAST(i - 1 AS BIGINT) AS place, hrefs[i] AS href, regexp_extract(url, '^[a-z]+://[^/]+') || hrefs[i] AS link
    FROM (SELECT page_id, url, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM (SELECT page_id, url, regexp_extract_all(
    regexp_replace(html, '<!--.*?-->', '', 'gs'), '(?i)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1) AS hrefs FROM pages))""")
def page_links_resolved(spark, sf):
    """Absolute link targets in page order. The tables' links are all rooted paths, so SQL can tell."""
    found = resolved_links(table(spark, sf, "pages"), "page_id", "html", "url")
    return found.withColumn("place", F.col("place").cast("bigint"))


# DuckDB counts edits in bytes: signs beyond ASCII, which no entry has, stand as one byte each.
@query(rf"""WITH names AS (SELECT DISTINCT substr(href, 2) AS name FROM ({LINKS}) WHERE length(href) > 1),
    entries AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS entry FROM benchmark),
    near AS (SELECT name, entry, levenshtein(regexp_replace(lower(name), '[^\x00-\x7F]', '#', 'g'), lower(entry)) AS edits FROM names, entries)
    SELECT name, entry, CAST(edits AS BIGINT) AS edits, row_number() OVER (PARTITION BY name ORDER BY edits, entry) AS rank
    FROM near WHERE edits <= 1""")
def suggested_entries(spark, sf):
    """For each word that pages link to the words of the benchmark at most one edit apart."""
    links = extract_links(table(spark, sf, "pages"), "page_id", "html").where(F.length("href") > 1)
    names = links.select(F.expr("substr(href, 2)").alias("name"))
    words = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("entry")
    found = suggest_entries(names, "name", table(spark, sf, "benchmark").select(words), "entry", 1)
    return found.withColumns({x: F.col(x).cast("bigint") for x in ("edits", "rank")})
