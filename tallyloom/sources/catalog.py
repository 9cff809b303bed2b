"""Where each table lives. Every job takes its paths from here."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from tallyloom.sources.tables import read_parquet, write_report, write_table


@dataclass(frozen=True)
class Catalog:
    """`inputs` holds the raw CSV files; tables and reports are written below `outputs`."""

    inputs: str
    outputs: str

    # Raw files, below `inputs`. The layout in which the data sets are kept.
    survey: str = "atlas_csv/MH_Database_Combined_Countries.csv"
    programmes: str = "atlas_csv/MH_Database_Table_Combined.csv"
    rates: str = "atlas_csv/rates.csv"
    country_dictionary: str = "atlas_country_dict"
    suicide_dictionary: str = "gmh_sui_2023_country_dict"
    panel: str = "gmh_csv/Mental_health_Depression_disorder_Data.csv"
    depression: str = "gmh_csv/prevalence-of-depression-males-vs-females.csv"
    eating: str = "gmh_csv/prevalence-of-eating-disorders-in-males-vs-females.csv"
    anxiety: str = "gmh_csv/prevalence-of-anxiety-disorders-males-vs-females.csv"
    schizophrenia: str = "gmh_csv/prevalence-of-schizophrenia-in-males-vs-females.csv"
    bipolar: str = "gmh_csv/prevalence-of-bipolar-disorder-in-males-vs-females.csv"
    suicide: str = "gmh_csv/suicide-rate-by-country-2023.csv"

    def source(self, name: str) -> str:
        """Path of a raw file by its field name."""
        return f"{self.inputs.rstrip('/')}/{getattr(self, name)}"

    def table_path(self, name: str) -> str:
        return f"{self.outputs.rstrip('/')}/tables/{name}"

    def save(self, df: DataFrame, name: str) -> None:
        write_table(df, self.table_path(name))

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return read_parquet(spark, self.table_path(name))

    def report(self, df: DataFrame, name: str, order_by: Sequence[Column | str] = ()) -> None:
        write_report(df, f"{self.outputs.rstrip('/')}/reports/{name}", order_by)
