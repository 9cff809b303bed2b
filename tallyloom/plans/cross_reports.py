"""Reports across the survey and the indicators, and the composite score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.ordering import top_bottom
from tallyloom.operators.panel import mean_by_presence, split_by_presence
from tallyloom.operators.scoring import (
    composite_index,
    count_present,
    decile_score,
    fill_unreported,
    total_score,
)
from tallyloom.operators.shaping import clean_columns, col, enrich, fill_sentinels
from tallyloom.plans.panel_reports import suicide_columns
from tallyloom.plans.survey_star import KEY, PROGRAMME_FLAGS
from tallyloom.sources.catalog import Catalog

BUDGET = "govt_exp_mental_health_%_budget"
INSURED = "insurance_and_reimbursement_includes_mental_health"
WORKERS = "num_total_mental_health_workers"

# Nine facility measures are scored, seven of the scores are summed.
SCORED_FACILITIES = [
    "outpatient_facilities_attached_to_hospitals",
    "outpatient_facilities_not_attached_to_hospitals",
    "other_outpatient_facilities",
    "children_specific_outpatient_facilities",
    "inpatient_hospitals",
    "inpatient_psychiatric_units",
    "community_residential_facilities",
    "children_specific_inpatient_facilities",
    "total_community_facilities",
]
SUMMED_FACILITIES = [
    "outpatient_facilities_attached_to_hospitals",
    "children_specific_outpatient_facilities",
    "inpatient_hospitals",
    "inpatient_psychiatric_units",
    "community_residential_facilities",
    "children_specific_inpatient_facilities",
    "total_community_facilities",
]


def expenditure_and_mortality(
    basic: DataFrame, countries: DataFrame, mortality: DataFrame
) -> DataFrame:
    named = enrich(basic, countries, [KEY], ["country_name"])
    return enrich(named, mortality, [KEY], ["suicide_mortality_rate_2019"]).select(
        "expenditure_cad",
        "country_name",
        F.col("suicide_mortality_rate_2019").alias("suicide_mortality_rate"),
    )


def payment_table(expenditure: DataFrame) -> DataFrame:
    """Expenditure dimension with sentinels for what was not reported."""
    return fill_sentinels(
        clean_columns(expenditure, {INSURED: F.lower}),
        {
            BUDGET: -1.0,
            "mh_expenditure_hospital": -1.0,
            "pay_for_services": "no_info",
            "pay_for_medication": "no_info",
            INSURED: "no_info",
        },
    )


def expenditure_and_workforce(
    payments: DataFrame, workforce: DataFrame, basic: DataFrame, countries: DataFrame
) -> DataFrame:
    workers = fill_unreported(workforce.select(KEY, WORKERS), [WORKERS])
    joined = enrich(payments.select(KEY, col(BUDGET)), workers, [KEY], [WORKERS])
    named = enrich(basic, countries, [KEY], ["country_name"])
    return enrich(joined, named, [KEY], ["population", "income_group", "country_name"]).drop(KEY)


def facility_scores(facilities: DataFrame, exact: bool = True) -> DataFrame:
    """Unreported facilities count as -1 when deciles are taken, so they never score."""
    filled = fill_unreported(facilities.select(KEY, *SCORED_FACILITIES), SCORED_FACILITIES)
    scored = decile_score(filled, SCORED_FACILITIES, exact=exact)
    summed = [f"{name}_score" for name in SUMMED_FACILITIES]
    return total_score(scored, summed, "facilities_score").select(KEY, "facilities_score")


def programme_scores(programmes: DataFrame, countries: DataFrame) -> DataFrame:
    named = enrich(programmes, countries, [KEY], ["country_name", "un_region"])
    return count_present(named, PROGRAMME_FLAGS, "programme_score").select(
        KEY, "country_name", "un_region", "programme_score"
    )


def budget_scores(payments: DataFrame, exact: bool = True) -> DataFrame:
    scored = decile_score(payments.select(KEY, col(BUDGET)), [BUDGET], exact=exact)
    return scored.select(KEY, col(f"{BUDGET}_score").alias("budget_score"))


def composite_scores(
    facilities: DataFrame,
    programmes: DataFrame,
    payments: DataFrame,
    countries: DataFrame,
    exact: bool = True,
) -> DataFrame:
    parts = [
        facility_scores(facilities, exact),
        programme_scores(programmes, countries),
        budget_scores(payments, exact),
    ]
    scores = ["facilities_score", "programme_score", "budget_score"]
    return composite_index(parts, KEY, scores).select("country_name", "un_region", "total_score")


def run(spark: SparkSession, catalog: Catalog, published: bool = True) -> None:
    countries = catalog.table(spark, "country")
    basic = catalog.table(spark, "basic_info")
    programmes = catalog.table(spark, "programmes")
    payments = payment_table(catalog.table(spark, "expenditure"))

    catalog.report(
        expenditure_and_mortality(basic, countries, catalog.table(spark, "mortality")),
        "expenditure_and_mortality",
    )

    rates = ["male_suicide_%", "female_suicide_%"]
    suicide = suicide_columns(catalog.table(spark, "suicide"), published)
    known = enrich(programmes, countries, [KEY], [])
    flagged = enrich(
        known.select(KEY, "suicide_prevention_program"), suicide, [KEY], ["country_name", *rates]
    )
    catalog.report(
        split_by_presence(flagged, "suicide_prevention_program", "country_name", rates),
        "suicide_by_programme",
    )
    catalog.report(
        mean_by_presence(
            flagged,
            "suicide_prevention_program",
            rates,
            "Suicide prevention program",
            "No suicide prevention program",
        ),
        "mean_suicide_by_programme",
    )

    catalog.report(
        expenditure_and_workforce(payments, catalog.table(spark, "workforce"), basic, countries),
        "expenditure_and_workforce",
    )

    scores = composite_scores(catalog.table(spark, "facilities"), programmes, payments, countries)
    catalog.save(scores, "composite_score")
    scores = catalog.table(spark, "composite_score")
    catalog.report(scores, "composite_score")
    catalog.report(top_bottom(scores, "total_score", "country_name"), "top_bottom_countries")
