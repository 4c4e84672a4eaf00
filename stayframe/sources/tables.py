"""Readers for the hospital source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns and types each source table must provide.
SCHEMAS = {
    "icustays": "subject_id long, hadm_id long, icustay_id long, intime timestamp_ntz, "
                "outtime timestamp_ntz",
    "admissions": "hadm_id long, subject_id long, admittime timestamp_ntz, "
                  "dischtime timestamp_ntz, deathtime timestamp_ntz",
    "patients": "subject_id long, gender string, dob timestamp_ntz, dod timestamp_ntz",
    "services": "hadm_id long, event_id long, transfertime timestamp_ntz, curr_service string",
    "ventdurations": "icustay_id long, starttime timestamp_ntz, endtime timestamp_ntz",
    "chartevents": "event_id long, subject_id long, icustay_id long, charttime timestamp_ntz, "
                   "itemid int, value string, valuenum double",
    "labevents": "event_id long, subject_id long, charttime timestamp_ntz, itemid int, "
                 "value string, valuenum double, flag string",
    "outputevents": "subject_id long, charttime timestamp_ntz, itemid int, value double",
    "inputevents_cv": "icustay_id long, charttime timestamp_ntz, itemid int, stopped string, "
                      "rate double, amount double",
    "inputevents_mv": "icustay_id long, linkorderid long, itemid int, starttime timestamp_ntz, "
                      "endtime timestamp_ntz, rate double, amount double, statusdescription string",
    "diagnoses_icd": "subject_id long, hadm_id long, icd9_code string",
    "procedures_icd": "subject_id long, hadm_id long, icd9_code string",
    "noteevents": "row_id long, hadm_id long, category string, chartdate timestamp_ntz, text string",
}
# Row id that breaks ties between records of the same time, where the source calls it row_id.
TIE_SOURCES = {"row_id": ("services", "chartevents", "labevents")}
EXTERNAL = {
    "saps": "icustay_id long, saps int",
    "sapsii": "icustay_id long, sapsii int",
    "sofa": "icustay_id long, sofa int",
    "angus_sepsis": "hadm_id long, angus int",
}


def column_names(name: str) -> list[str]:
    return [part.split()[0] for part in SCHEMAS[name].split(", ")]


def conform(df: DataFrame, name: str) -> DataFrame:
    """The table's required columns in the required types; fails on a missing column.

    Extra columns are dropped, so only the needed ones are scanned.
    """
    schema = {**SCHEMAS, **EXTERNAL}[name]
    present = {c.lower(): c for c in df.columns}
    if "event_id" not in present and name in TIE_SOURCES["row_id"] and "row_id" in present:
        df = df.withColumnRenamed(present["row_id"], "event_id")
        present = {c.lower(): c for c in df.columns}
    wanted = [part.split() for part in schema.split(", ")]
    missing = [column for column, _ in wanted if column not in present]
    if missing:
        raise ValueError(f"{name}: missing columns {', '.join(missing)}")
    types = dict(df.dtypes)
    columns = []
    for column, kind in wanted:
        actual = df[present[column]]
        same = types[present[column]] == {"long": "bigint"}.get(kind, kind)
        columns.append((actual if same else actual.cast(kind)).alias(column))
    return df.select(*columns)


def read_tables(spark: SparkSession, folder: str, external=()) -> dict[str, DataFrame]:
    """All source tables as ``<folder>/<name>.parquet`` (or a folder of that name)."""
    return {
        name: conform(spark.read.parquet(f"{folder}/{name}.parquet"), name)
        for name in [*SCHEMAS, *external]
    }
