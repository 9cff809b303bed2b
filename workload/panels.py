"""Panel analytics, ranking and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators.ordering import (
    bottom_k,
    decile_values,
    decile_values,
    deciles,
    global_rank,
    leading_key,
    top_bottom,
    top_k,
)
from tallyloom.operators.panel import (
    correlation_matrix,
    entity_panel,
    group_means,
    growth_between,
    mean_by_presence,
    split_by_presence,
    top_bottom_union,
    top_bottom_with_mean,
    worst_group_drilldown,
)
from tallyloom.operators.scoring import (
    composite_index,
    count_present,
    decile_score,
    fill_unreported,
    total_score,
)
from tallyloom.operators.shaping import enrich, fill_sentinels
from tallyloom.session import stage
from workload.registry import query, rounded, table

MEASURES = {
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "discount": "l_discount",
    "tax": "l_tax",
}
NAMES = list(MEASURES)


def _nations(spark, sf):
    nation = table(spark, sf, "nation").withColumn("r_regionkey", F.col("n_regionkey"))
    return enrich(nation, table(spark, sf, "region"), ["r_regionkey"], ["r_name"]).select(
        "n_nationkey", "n_name", "r_name"
    )


def _suppliers(spark, sf):
    supplier = table(spark, sf, "supplier").withColumn("n_nationkey", F.col("s_nationkey"))
    return enrich(supplier, _nations(spark, sf), ["n_nationkey"], ["n_name", "r_name"])


def _panel(spark, sf):
    """Nation x year means of four line item measures."""
    return entity_panel(
        table(spark, sf, "lineitem"),
        "l_suppkey",
        F.year("l_shipdate"),
        MEASURES,
        _suppliers(spark, sf),
        "s_suppkey",
        ["n_name", "r_name"],
    )


PANEL = """panel AS (SELECT n_name, r_name, CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_quantity) AS quantity,
    avg(l_extendedprice) AS price, avg(l_discount) AS discount, avg(l_tax) AS tax
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3)"""

ROUNDED = ", ".join(f"round({name}, 6) AS {name}" for name in NAMES)


@query(f"WITH {PANEL} SELECT n_name, r_name, year, {ROUNDED} FROM panel")
def entity_year_panel(spark, sf):
    return rounded(_panel(spark, sf), NAMES)


@query(f"""WITH {PANEL}, m AS (SELECT n_name, avg(price) AS v FROM panel GROUP BY 1),
    chosen AS (SELECT n_name FROM (SELECT n_name FROM m ORDER BY v DESC NULLS LAST, n_name LIMIT 5)
    UNION SELECT n_name FROM (SELECT n_name FROM m ORDER BY v ASC NULLS FIRST, n_name DESC LIMIT 5))
    SELECT year, n_name, round(price, 6) AS price FROM panel WHERE n_name IN (SELECT n_name FROM chosen)
    UNION ALL SELECT year, 'Mean', round(avg(price), 6) FROM panel GROUP BY year""")
def top_bottom_series(spark, sf):
    return rounded(top_bottom_with_mean(_panel(spark, sf), "n_name", "year", "price"), ["price"])


@query(f"""WITH {PANEL}, w AS (SELECT r_name FROM panel GROUP BY 1 ORDER BY avg(quantity) DESC, r_name LIMIT 1)
    SELECT r_name, n_name, round(avg(quantity), 6) AS quantity FROM panel WHERE r_name IN (SELECT r_name FROM w) GROUP BY 1, 2""")
def worst_region(spark, sf):
    return rounded(
        worst_group_drilldown(_panel(spark, sf), "r_name", "n_name", "quantity"), ["quantity"]
    )


ENRICHED = """enriched AS (SELECT o_orderkey, o_totalprice, o_orderdate, c_mktsegment, n_name, r_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""


def _enriched_orders(spark, sf):
    customer = table(spark, sf, "customer").withColumnsRenamed(
        {"c_custkey": "o_custkey", "c_nationkey": "n_nationkey"}
    )
    orders = enrich(
        table(spark, sf, "orders"), customer, ["o_custkey"], ["n_nationkey", "c_mktsegment"]
    )
    return enrich(orders, _nations(spark, sf), ["n_nationkey"], ["n_name", "r_name"])


@query(f"""WITH {ENRICHED}, w AS (SELECT c_mktsegment FROM enriched GROUP BY 1 ORDER BY avg(o_totalprice) DESC, 1 LIMIT 1)
    SELECT c_mktsegment, n_name, round(avg(o_totalprice), 6) AS o_totalprice FROM enriched
    WHERE c_mktsegment IN (SELECT c_mktsegment FROM w) GROUP BY 1, 2""")
def worst_income_group(spark, sf):
    df = worst_group_drilldown(
        _enriched_orders(spark, sf), "c_mktsegment", "n_name", "o_totalprice"
    )
    return rounded(df, ["o_totalprice"])


@query(f"WITH {ENRICHED} SELECT o_orderkey, c_mktsegment, n_name, r_name FROM enriched")
def enriched_panel(spark, sf):
    return _enriched_orders(spark, sf).select("o_orderkey", "c_mktsegment", "n_name", "r_name")


@query(f"""WITH {PANEL}, y AS (SELECT r_name, year, avg(quantity) AS quantity, avg(tax) AS tax FROM panel GROUP BY 1, 2)
    SELECT a.r_name, round(b.quantity - a.quantity, 6) AS "Quantity growth", round(b.tax - a.tax, 6) AS "Tax growth"
    FROM y a JOIN y b ON a.r_name = b.r_name WHERE a.year = 1995 AND b.year = 2000""")
def growth_by_region(spark, sf):
    df = growth_between(_panel(spark, sf), "r_name", "year", ["quantity", "tax"], 1995, 2000)
    return rounded(df, ["Quantity growth", "Tax growth"])


MEANS = f"SELECT r_name, year, {', '.join(f'avg({n}) AS {n}' for n in NAMES)} FROM panel GROUP BY 1, 2"


@query(f"WITH {PANEL} SELECT r_name, year, {ROUNDED} FROM ({MEANS})")
def region_year_means(spark, sf):
    return rounded(group_means(_panel(spark, sf), ["r_name", "year"], NAMES), NAMES)


CORRELATIONS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {'max(1.0)' if a == b else f'round(corr({a}, {b}), 6)'} AS r FROM m"
    for a in NAMES
    for b in NAMES
)


@query(f"WITH {PANEL}, m AS ({MEANS}) {CORRELATIONS}")
def correlations(spark, sf):
    means = group_means(_panel(spark, sf), ["r_name", "year"], NAMES)
    return rounded(correlation_matrix(means, NAMES), ["r"])


FLAG = "CASE WHEN c_acctbal >= 0 THEN 'programme' END"
UNION = """WITH m AS (SELECT n_name, avg(c_acctbal) AS balance, avg(orders) AS orders FROM customer
    JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"""


def _picks(source: str, key: str, measures: list[str], ascending: bool) -> str:
    picks = [f"(SELECT * FROM {source} ORDER BY {m} DESC NULLS LAST, {key} LIMIT 5)" for m in measures]
    if ascending:
        picks += [f"(SELECT * FROM {source} ORDER BY {m} ASC NULLS FIRST, {key} LIMIT 5)" for m in measures]
    return " UNION ".join(picks)


def _customer_orders(spark, sf):
    """Customers with their nation and number of orders; orders are counted before the join."""
    counts = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("orders"))
    )
    customer = table(spark, sf, "customer").withColumn("n_nationkey", F.col("c_nationkey"))
    return enrich(
        customer.join(counts, "c_custkey"), _nations(spark, sf), ["n_nationkey"], ["n_name", "r_name"]
    )


@query(f"""{UNION} SELECT n_name, round(balance, 6) AS balance, round(orders, 6) AS orders FROM
    ({_picks('m', 'n_name', ['balance', 'orders'], True)})""")
def top_bottom_by_two_measures(spark, sf):
    df = _customer_orders(spark, sf).withColumnRenamed("c_acctbal", "balance")
    df = top_bottom_union(df, ["n_name"], ["balance", "orders"])
    return rounded(rounded(df, ["balance"]), ["orders"])


@query(f"""WITH f AS (SELECT ({FLAG}) IS NOT NULL AS present, c_custkey, c_acctbal, CAST(orders AS BIGINT) AS orders FROM customer
    JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) ON o_custkey = c_custkey),
    a AS (SELECT * FROM f WHERE present), b AS (SELECT * FROM f WHERE NOT present)
    SELECT * FROM ({_picks('a', 'c_custkey', ['c_acctbal', 'orders'], False)})
    UNION ALL SELECT * FROM ({_picks('b', 'c_custkey', ['c_acctbal', 'orders'], False)})""")
def presence_split(spark, sf):
    df = _customer_orders(spark, sf).withColumn("flag", F.expr(FLAG))
    return split_by_presence(df, "flag", "c_custkey", ["c_acctbal", "orders"])


@query(f"""SELECT CASE WHEN ({FLAG}) IS NULL THEN 'No programme' ELSE 'Programme' END AS status,
    round(avg(o_totalprice), 6) AS o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def presence_means(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.expr(FLAG).alias("flag")
    )
    df = enrich(table(spark, sf, "orders"), customer, ["o_custkey"], ["flag"])
    means = mean_by_presence(df, "flag", ["o_totalprice"], "Programme", "No programme")
    return rounded(means, ["o_totalprice"])


@query("""SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_acctbal ELSE -1 END AS balance, n_name, r_name FROM supplier
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def measures_with_sentinel(spark, sf):
    """Suppliers in debt report no balance."""
    known = F.expr("CASE WHEN s_acctbal >= 0 THEN s_acctbal END")
    df = _suppliers(spark, sf).withColumn("balance", known)
    filled = fill_sentinels(df, {"balance": -1.0})
    return filled.select("s_suppkey", "balance", "n_name", "r_name")


@query("""SELECT l_partkey, posts, rank() OVER (ORDER BY posts DESC) AS rank
    FROM (SELECT l_partkey, count(*) AS posts FROM lineitem GROUP BY 1)""")
def ranked_counts(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("posts"))
    return global_rank(counts, "posts").select("l_partkey", "posts", "rank")


@query("""WITH t AS (SELECT p_partkey, p_retailprice FROM part)
    (SELECT *, 'top' AS side FROM t ORDER BY p_retailprice DESC, p_partkey LIMIT 10) UNION ALL
    (SELECT *, 'bottom' AS side FROM t ORDER BY p_retailprice, p_partkey DESC LIMIT 10)""")
def top_and_bottom(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    top = top_k(df, "p_retailprice", "p_partkey", 10).withColumn("side", F.lit("top"))
    bottom = bottom_k(df, "p_retailprice", "p_partkey", 10).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


@query("SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY avg(c_acctbal) DESC, 1 LIMIT 1")
def leading_segment(spark, sf):
    means = group_means(table(spark, sf, "customer"), ["c_mktsegment"], ["c_acctbal"])
    return leading_key(means, "c_acctbal", "c_mktsegment")


# Facility measures by supplier; a supplier with few large shipments reports none.
TENTHS = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
FACILITIES = """facilities AS (SELECT l_suppkey AS s_suppkey, CAST(count(*) AS DOUBLE) AS lines, sum(l_quantity) AS units,
    coalesce(CASE WHEN count(*) FILTER (WHERE l_quantity > 48) >= 2
    THEN CAST(count(*) FILTER (WHERE l_quantity > 48) AS DOUBLE) END, -1) AS large FROM lineitem GROUP BY 1)"""
FACILITY_NAMES = ["lines", "units", "large"]


def _facilities(spark, sf):
    """Staged, as the survey tables are: scoring reads its measures several times."""
    large = F.count_if(F.col("l_quantity") > 48)
    df = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"))
        .agg(
            F.count("*").cast("double").alias("lines"),
            F.sum("l_quantity").alias("units"),
            F.when(large >= 2, large).cast("double").alias("large"),
        )
    )
    return stage(fill_unreported(df, FACILITY_NAMES), "facilities")


def _scores(names: list[str], source: str) -> str:
    cuts = ", ".join(f"quantile_disc({n}, {TENTHS}) AS {n}_cuts" for n in names)
    scores = ", ".join(
        f"CAST(round(0.11 * len(list_filter({n}_cuts, lambda d: d < {n})), 2) AS DOUBLE) AS {n}_score" for n in names
    )
    return f"(SELECT {source}.*, {scores} FROM {source}, (SELECT {cuts} FROM {source}))"


DECILE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    " UNION ALL ".join(
        f"""SELECT '{n}' AS measure, i + 1 AS decile, quantile_disc({n}, {TENTHS})[i + 1] AS value
        FROM lineitem, (SELECT unnest(range(9)) AS i) GROUP BY i"""
        for n in DECILE_MEASURES
    )
)
def exact_deciles(spark, sf):
    df = deciles(table(spark, sf, "lineitem"), DECILE_MEASURES)
    return df.select("measure", F.posexplode("deciles").alias("decile", "value")).withColumn(
        "decile", (F.col("decile") + 1).cast("bigint")
    )


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS measure, CAST(i AS BIGINT) AS decile, true AS within FROM (SELECT unnest(range(1, 10)) AS i)"
        for n in DECILE_MEASURES
    )
)
def approximate_deciles(spark, sf):
    """Whether each approximate decile is within its stated rank error of 0.001."""
    lines = table(spark, sf, "lineitem")
    found = decile_values(lines, DECILE_MEASURES, exact=False)
    checks = []
    for name in DECILE_MEASURES:
        for i, value in enumerate(found[name], 1):
            below, at = F.count_if(F.col(name) < value), F.count_if(F.col(name) <= value)
            wanted, slack = F.count(name) * (i / 10), F.count(name) * 0.001 + 1
            within = (below - slack <= wanted) & (at + slack >= wanted)
            checks.append(
                F.struct(F.lit(name).alias("measure"), F.lit(i).cast("bigint").alias("decile"), within.alias("within"))
            )
    return lines.agg(F.array(*checks).alias("c")).select(F.explode("c").alias("c")).select("c.*")


@query(f"""WITH {FACILITIES} SELECT s_suppkey, {', '.join(f'{n}_score' for n in FACILITY_NAMES)},
    round(lines_score + units_score + large_score, 2) AS facilities_score FROM {_scores(FACILITY_NAMES, 'facilities')}""")
def facility_scores(spark, sf):
    scores = [f"{name}_score" for name in FACILITY_NAMES]
    df = total_score(
        decile_score(_facilities(spark, sf), FACILITY_NAMES), scores, "facilities_score"
    )
    return rounded(df.select("s_suppkey", *scores, "facilities_score"), ["facilities_score"], 2)


BUDGET = "budgets AS (SELECT s_suppkey, coalesce(CASE WHEN s_acctbal >= 0 THEN s_acctbal END, -1) AS budget FROM supplier)"


def _budgets(spark, sf):
    df = table(spark, sf, "supplier").select(
        "s_suppkey", F.expr("CASE WHEN s_acctbal >= 0 THEN s_acctbal END").alias("budget")
    )
    return fill_unreported(df, ["budget"])


@query(f"WITH {BUDGET} SELECT s_suppkey, budget_score FROM {_scores(['budget'], 'budgets')}")
def budget_scores(spark, sf):
    return decile_score(_budgets(spark, sf), ["budget"]).select("s_suppkey", "budget_score")


FLAGS = """flags AS (SELECT s_suppkey, nullif(s_nationkey, 3) AS f1, CASE WHEN s_acctbal > 5000 THEN 'yes' END AS f2,
    nullif(s_name, 'Supplier#000000001') AS f3 FROM supplier)"""


def _flags(spark, sf):
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey",
        "nullif(s_nationkey, 3) AS f1",
        "CASE WHEN s_acctbal > 5000 THEN 'yes' END AS f2",
        "nullif(s_name, 'Supplier#000000001') AS f3",
    )


PRESENT = "CAST((f1 IS NOT NULL)::INT + (f2 IS NOT NULL)::INT + (f3 IS NOT NULL)::INT AS INTEGER)"


@query(f"WITH {FLAGS} SELECT s_suppkey, {PRESENT} AS programme_score FROM flags")
def programme_scores(spark, sf):
    flags = ["f1", "f2", "f3"]
    return count_present(_flags(spark, sf), flags, "programme_score").select(
        "s_suppkey", "programme_score"
    )


COMPOSITE = f"""WITH {FACILITIES}, {BUDGET}, {FLAGS}, composite AS (SELECT a.s_suppkey,
    round(lines_score + units_score + large_score + {PRESENT} + budget_score, 2) AS total_score
    FROM {_scores(FACILITY_NAMES, 'facilities')} a JOIN {_scores(['budget'], 'budgets')} b ON a.s_suppkey = b.s_suppkey
    JOIN flags c ON a.s_suppkey = c.s_suppkey)"""


def _composite(spark, sf):
    parts = [
        facility_scores(spark, sf).select("s_suppkey", "facilities_score"),
        programme_scores(spark, sf),
        budget_scores(spark, sf),
    ]
    df = composite_index(parts, "s_suppkey", ["facilities_score", "programme_score", "budget_score"])
    return rounded(df.select("s_suppkey", "total_score"), ["total_score"], 2)


@query(f"{COMPOSITE} SELECT s_suppkey, total_score FROM composite")
def composite_scores(spark, sf):
    return _composite(spark, sf)


@query(f"""{COMPOSITE} (SELECT * FROM composite ORDER BY total_score DESC, s_suppkey LIMIT 5) UNION ALL
    (SELECT * FROM composite ORDER BY total_score, s_suppkey DESC LIMIT 5)""")
def composite_top_bottom(spark, sf):
    return top_bottom(_composite(spark, sf), "total_score", "s_suppkey")
