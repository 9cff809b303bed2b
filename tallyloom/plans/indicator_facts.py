"""Fact tables of the prevalence panel, its split by sex, and suicide rates."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyloom.operators.conform import conform, unmatched
from tallyloom.operators.star import IndicatorSpec, build_indicator_fact
from tallyloom.sources import schemas
from tallyloom.sources.catalog import Catalog
from tallyloom.sources.tables import read_strings, read_table

# Column names are fixed values: raw headers and published names.
PANEL_MEASURES = {
    "Schizophrenia (%)": "schizophrenia_%",
    "Bipolar disorder (%)": "bipolar_disorder_%",
    "Eating disorders (%)": "eating_disorders_%",
    "Anxiety disorders (%)": "anxiety_disorders_%",
    "Drug use disorders (%)": "drug_use_disorders_%",
    "Depression (%)": "depression_%",
    "Alcohol use disorders (%)": "alcohol_use_disorders_%",
}

# Anxiety is not among the bounded measures, as in the published table.
PANEL = IndicatorSpec(
    "panel",
    PANEL_MEASURES,
    bounded=[name for name in PANEL_MEASURES.values() if name != "anxiety_disorders_%"],
)


def sex_split(name: str, disorder: str, stem: str) -> IndicatorSpec:
    """Male and female prevalence of one disorder; rows lacking either are dropped."""
    measures = {
        f"Prevalence - {disorder} - Sex: {sex} - Age: Age-standardized (Percent)": f"{sex.lower()}_{stem}_%"
        for sex in ("Male", "Female")
    }
    return IndicatorSpec(name, measures, required=list(measures.values()))


SEX_SPLITS = [
    sex_split("depression", "Depressive disorders", "depression"),
    sex_split("eating", "Eating disorders", "eating_disorders"),
    sex_split("anxiety", "Anxiety disorders", "anxiety_disorders"),
    sex_split("schizophrenia", "Schizophrenia", "schizophrenia"),
    sex_split("bipolar", "Bipolar disorder", "bipolar_disorder"),
]

# Rates per 100,000 held to the same bound as percentages.
SUICIDE = IndicatorSpec(
    "suicide",
    {
        "rate2019both": "all_suicide_%",
        "rate2019male": "male_suicide_%",
        "rate2019female": "female_suicide_%",
    },
    code="code",
    year=None,
    years=None,
    fixed_year=2019,
    bounded=["all_suicide_%", "male_suicide_%", "female_suicide_%"],
)


def suicide_fact(rates, dictionary, countries, how: str = "inner"):
    """Suicide rates conformed through their own name dictionary. `how="right"` keeps every country."""
    coded = conform(
        rates, "country", dictionary.withColumnRenamed("country_code", "code"), "country", ["code"]
    )
    return build_indicator_fact(coded, countries, SUICIDE, how)


def run(spark: SparkSession, catalog: Catalog) -> None:
    countries = catalog.table(spark, "country")
    for spec in [PANEL, *SEX_SPLITS]:
        raw = read_strings(spark, catalog.source(spec.name))
        catalog.save(build_indicator_fact(raw, countries, spec), spec.name)
    dictionary = read_table(
        spark, catalog.source("suicide_dictionary"), schemas.CODE_DICTIONARY, header=False
    )
    rates = read_strings(spark, catalog.source("suicide"))
    catalog.save(suicide_fact(rates, dictionary, countries), SUICIDE.name)
    catalog.report(unmatched(rates, "country", dictionary, "country"), "unmatched/suicide")
