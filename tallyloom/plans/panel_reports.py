"""Reports on the prevalence panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.panel import (
    correlation_matrix,
    group_means,
    growth_between,
    top_bottom_union,
    top_bottom_with_mean,
    worst_group_drilldown,
)
from tallyloom.operators.shaping import col, enrich
from tallyloom.plans.indicator_facts import PANEL_MEASURES, SEX_SPLITS
from tallyloom.sources.catalog import Catalog

MEASURES = list(PANEL_MEASURES.values())
GROUPS = ["un_region", "income_group"]


def with_income(panel: DataFrame, basic: DataFrame, countries: DataFrame) -> DataFrame:
    """Panel with population, income group and expenditure of known countries."""
    known = enrich(basic, countries, ["country_code"], ["country_name"])
    return enrich(panel, known, ["country_code"], ["population", "income_group", "expenditure_cad"])


def suicide_columns(suicide: DataFrame, published: bool) -> DataFrame:
    """The two suicide measures that reports show.

    `published=True` follows the published figures, where the male column holds both sexes and the
    female column holds male; otherwise columns are what they say.
    """
    male, female = ("all_suicide_%", "male_suicide_%") if published else (
        "male_suicide_%", "female_suicide_%",
    )
    return suicide.select(
        "country_name",
        "country_code",
        "un_region",
        "year",
        col(male).alias("male_suicide_%"),
        col(female).alias("female_suicide_%"),
    )


def run(spark: SparkSession, catalog: Catalog, published: bool = True) -> None:
    panel = catalog.table(spark, "panel")
    combined = with_income(panel, catalog.table(spark, "basic_info"), catalog.table(spark, "country"))
    catalog.report(panel, "panel")
    for measure in MEASURES:
        stem = measure.removesuffix("_%")
        catalog.report(
            top_bottom_with_mean(panel, "country_name", "year", measure), f"series_{stem}"
        )
        for group in GROUPS:
            catalog.report(
                worst_group_drilldown(combined, group, "country_name", measure),
                f"worst_{group}_{stem}",
            )
        catalog.report(
            growth_between(combined, "un_region", "year", [measure], 1990, 2017), f"growth_{stem}"
        )
    averages = group_means(combined, ["un_region", "year"], MEASURES)
    catalog.report(averages, "region_year_means")
    catalog.report(correlation_matrix(averages, MEASURES), "correlation")
    for spec in SEX_SPLITS:
        catalog.report(catalog.table(spark, spec.name), f"by_sex_{spec.name}")
    suicide = suicide_columns(catalog.table(spark, "suicide"), published)
    catalog.report(
        top_bottom_union(
            suicide, ["un_region", "year"], ["male_suicide_%", "female_suicide_%"]
        ),
        "suicide_by_region",
    )
    catalog.report(
        combined.select("country_code", "income_group")
        .distinct()
        .where(F.col("income_group").isNull()),
        "countries_without_income_group",
    )
