"""Star schema of the country survey: one fact and eight dimensions."""

from __future__ import annotations

from collections.abc import Collection
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions import labels
from tallyloom.functions.cleaning import (
    DASHES,
    currency_amount,
    currency_code,
    label_code,
    lower_label,
    null_markers,
    parse_float,
    parse_int,
    strip_newlines,
)
from tallyloom.operators.conform import conform, convert_currency, overlap, unmatched
from tallyloom.operators.shaping import col, unmapped_labels
from tallyloom.operators.star import DimSpec, build_dim
from tallyloom.sources import schemas
from tallyloom.sources.catalog import Catalog
from tallyloom.sources.tables import read_strings, read_table

KEY = "country_code"
TARGET_CURRENCY = "CAD"


def _payment(c):
    return label_code(strip_newlines(c), labels.PAYMENT)


def _authority(c):
    return label_code(strip_newlines(c, " "), labels.AUTHORITY)


def _share_band(c):
    return label_code(c, labels.SHARE_BAND, DASHES)


# Column names below are fixed values: they are the survey's own headers and the names under which
# the tables are published.

COUNTRY = DimSpec("country", ["country_name", KEY, "un_region"])

BASIC = DimSpec(
    "basic_info",
    [KEY, "population", "income_group", "who_region", "expenditure($)"],
    cleaners={"population": parse_int, "income_group": lower_label, "who_region": lower_label},
)

MORTALITY = DimSpec(
    "mortality",
    [KEY, "smr_2013", "smr_2016", "smr_2019"],
    cleaners={name: parse_float for name in ("smr_2013", "smr_2016", "smr_2019")},
    renames={
        "smr_2013": "suicide_mortality_rate_2013",
        "smr_2016": "suicide_mortality_rate_2016",
        "smr_2019": "suicide_mortality_rate_2019",
    },
)

EXPENDITURE = DimSpec(
    "expenditure",
    [
        KEY, "mh_expenditure", "mh_expenditure_hospital", "service_pay_method",
        "service_pay_medication", "mh_inclusive_schemes",
    ],
    cleaners={
        "mh_expenditure": parse_float,
        "mh_expenditure_hospital": parse_float,
        "service_pay_method": _payment,
        "service_pay_medication": _payment,
        "mh_inclusive_schemes": null_markers,
    },
    renames={
        "mh_expenditure": "govt_exp_mental_health_%_budget",
        "service_pay_method": "pay_for_services",
        "service_pay_medication": "pay_for_medication",
        "mh_inclusive_schemes": "insurance_and_reimbursement_includes_mental_health",
    },
)

_WORKFORCE = {
    "no_psychiatrists": "num_psychiatrists",
    "no_total_health_profs": "num_nurses",
    "no_psychologists": "num_psychologists",
    "no_social_wrks": "num_social_workers",
    "no_other_workers": "num_other_specialized_workers",
    "no_total_workers": "num_total_mental_health_workers",
    "mh_workers_2014": "num_total_mental_health_workers_2014",
    "mh_workers_2017": "num_total_mental_health_workers_2017",
    "mh_workers_2020": "num_total_mental_health_workers_2020",
    "mh_workers_psych": "num_child_psychiatrists",
    "mh_workers_all": "num_child_mental_health_workers",
}
WORKFORCE = DimSpec(
    "workforce", [KEY, *_WORKFORCE], {name: parse_float for name in _WORKFORCE}, _WORKFORCE
)

_FACILITIES = {
    "mh_op_facilities_hosp": "outpatient_facilities_attached_to_hospitals",
    "non_hosp_op_facilities": "outpatient_facilities_not_attached_to_hospitals",
    "other_op_facilities": "other_outpatient_facilities",
    "op_facilities_ca": "children_specific_outpatient_facilities",
    "ip_hosp": "inpatient_hospitals",
    "ip_psych": "inpatient_psychiatric_units",
    "ip_community": "community_residential_facilities",
    "ip_ca": "children_specific_inpatient_facilities",
    "mh_beds": "mental_hospital_beds",
    "psych_bed": "psych_bed",
    "community_beds": "community_beds",
    "caa_beds": "children_specific_beds",
    "total_comm_facilities": "total_community_facilities",
}
FACILITIES = DimSpec(
    "facilities", [KEY, *_FACILITIES], {name: parse_float for name in _FACILITIES}, _FACILITIES
)

_POLICIES = {
    "policy": "mental_health_policy",
    "year_policy": "mental_health_policy_year",
    "hr_resources_plan": "human_resources_for_mental_health_policy",
    "finance_resources_plan": "finance_resources_for_mental_health_policy",
    "mh_law": "mental_health_law",
    "law_year": "mental_health_law_year",
    "dedcated_body": "dedicated_authority",
    "mh_child_policy": "mental_health_child_policy",
    "year_child_policy": "mental_health_child_policy_year",
    "mh_adolescent_policy": "mental_health_adolescent_policy",
    "year_adolescent_policy": "mental_health_adolescent_policy_year",
    "mh_suicide_prevention_policy": "suicide_prevention_policy",
    "year_suicide_prevention_policy": "suicide_prevention_policy_year",
}
POLICIES = DimSpec(
    "policies",
    [KEY, *_POLICIES],
    {**{name: null_markers for name in _POLICIES}, "dedcated_body": _authority},
    _POLICIES,
)

_ADMISSIONS = {
    "ip_adm_2014": "inpatient_admissions_2014",
    "ip_adm_2017": "inpatient_admissions_2017",
    "ip_adm_2020": "inpatient_admissions_2020",
    "op_adm_2014": "outpatient_admissions_2014",
    "op_adm_2017": "outpatient_admissions_2017",
    "op_adm_2020": "outpatient_admissions_2020",
    "ca_services_2014": "community_based_mental_health_services_2014",
    "ca_services_2017": "community_based_mental_health_services_2017",
    "ca_services_2020": "community_based_mental_health_services_2020",
    "hosp_facilities_vists": "hospital_attached_facilities_visits",
    "non_hosp_facilities_visits": "non_hospital_attached_facilities_visits",
    "other_facilities_vists": "other_facilities_visits",
    "op_facilities_ca_visits": "children_specific_facilities_visits",
    "mh_annual": "annual_mental_hospital_admissions",
    "psych_admission": "psych_admission",
    "community_admissions": "community_admissions",
    "ca_adminssions": "ca_adminssions",
    "mh_hosps_total_adm": "mh_hosps_total_adm",
    "involuntary_adms": "total_involuntary_admissions",
    "follow_up": "follow_up_post_discharge",
    "ip_lt_1yr": "inpatients_staying_less_1_year",
    "ip_1_5": "inpatients_staying_1_5_year",
    "ip_gt_5": "inpatients_staying_more_5_year",
    "ip_timely_servies": "received_timely_services",
    "total_pshycosis": "total_psychosis",
    "total_pshycosis_male": "total_psychosis_male",
    "total_pshycosis_female": "total_psychosis_female",
}
ADMISSIONS = DimSpec(
    "admissions",
    [KEY, *_ADMISSIONS],
    {
        **{name: parse_float for name in _ADMISSIONS},
        "follow_up": _share_band,
        "ip_timely_servies": _share_band,
    },
    _ADMISSIONS,
)

_PROGRAMMES = {
    "Suicide prevention programme": "suicide_prevention_program",
    "Mental Health Awareness /Anti- stigma": "awareness_anti_stigma_program",
    "Early Child Development": "early_child_development_program",
    "School based mental health prevention and promotion": "school_based_program",
    "Parental / Maternal mental health promotion and prevention": "parental_health_program",
    "Work-related mental health prevention and promotion": "work_related_program",
    "Mental health and psychosocial component of disaster preparedness, disaster risk reduction": "disaster_preparation_program",
}
PROGRAMMES = DimSpec(
    "programmes",
    [*_PROGRAMMES, KEY],
    {name: partial(null_markers, markers=labels.PROGRAMME_MARKERS) for name in _PROGRAMMES},
    _PROGRAMMES,
)

SURVEY_DIMS = [COUNTRY, MORTALITY, EXPENDITURE, WORKFORCE, FACILITIES, POLICIES, ADMISSIONS]
PROGRAMME_FLAGS = list(_PROGRAMMES.values())


def basic_info(survey: DataFrame, rates: DataFrame) -> DataFrame:
    """Basic facts with the expenditure in the target currency."""
    raw = col("expenditure($)")
    priced = build_dim(survey, BASIC).withColumns(
        {"expenditure_amount": currency_amount(raw), "expenditure_currency": currency_code(raw)}
    )
    converted = convert_currency(
        priced, "expenditure_amount", "expenditure_currency", rates, TARGET_CURRENCY, "expenditure_cad"
    )
    return converted.select(KEY, "population", "income_group", "who_region", "expenditure_cad")


def conformed(df: DataFrame, name: str, dictionary: DataFrame) -> DataFrame:
    return conform(df, name, dictionary, "country", ["country_name", KEY, "un_region"])


#: Labels that are looked up in a code table, and the markers that stand for none.
LABELLED = {_payment: (), _authority: (), _share_band: DASHES}


def label_gaps(survey: DataFrame) -> DataFrame:
    """Labels of the survey that no code table has: (column, label, rows)."""
    coded, pairs = {}, {}
    for spec in SURVEY_DIMS:
        for name, cleaner in spec.cleaners.items():
            if cleaner in LABELLED and name in survey.columns:
                coded[f"{name} label"] = null_markers(col(name), LABELLED[cleaner] or ["-"])
                coded[f"{name} code"] = cleaner(col(name))
                pairs[f"{name} label"] = f"{name} code"
    return unmapped_labels(survey.withColumns(coded), pairs)


def run(spark: SparkSession, catalog: Catalog, optional: Collection[str] = ()) -> None:
    """Build the star, and report names and labels that the dictionaries lack.

    A dimension whose columns the survey lacks is an error unless `optional` names it.
    """
    dictionary = read_table(
        spark, catalog.source("country_dictionary"), schemas.COUNTRY_DICTIONARY, header=False
    )
    rates = read_table(spark, catalog.source("rates"), schemas.RATES)
    survey = conformed(
        read_strings(spark, catalog.source("survey"), multiline=True), "country", dictionary
    ).persist()  # read by every dimension
    try:
        for spec in SURVEY_DIMS:
            missing = sorted(set(spec.columns) - set(survey.columns))
            if not missing:
                catalog.save(build_dim(survey, spec), spec.name)
            elif spec.name not in optional:
                raise ValueError(f"the survey lacks columns of {spec.name}: {missing}")
        catalog.report(unmatched(survey, "country", dictionary, "country"), "unmatched/survey")
        catalog.report(overlap(survey, "country", dictionary, "country", KEY), "unmatched/survey_overlap")
        catalog.report(label_gaps(survey), "unmatched/labels")
        catalog.save(basic_info(survey, rates), BASIC.name)
    finally:
        survey.unpersist()
    programmes = conformed(
        read_strings(spark, catalog.source("programmes"), multiline=True), "Country", dictionary
    )
    catalog.save(build_dim(programmes, PROGRAMMES), PROGRAMMES.name)
    catalog.report(unmatched(programmes, "Country", dictionary, "country"), "unmatched/programmes")
