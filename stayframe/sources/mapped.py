"""Hospital-shaped views over a plain event stream.

The driver's ``events`` table (event_id, ts, user_id, event_type, value, props)
is read as hospital records: a subject is a user and a stay is one user in one
ten-day block. Item ids are small numbers here, so the study runs on the same
code with its own dictionary (``CONCEPTS``).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayframe.functions.numeric import INCH_IN_CM
from stayframe.operators.codes import CodeRule, SepsisRule
from stayframe.operators.cohort import CohortRules
from stayframe.plans.concepts import LAB_PANEL, LABS, Concepts, same
from stayframe.operators.lookback import Item, labels_of
from stayframe.plans.study import Study

EVENT_COLUMNS = """
  event_id, CAST(ts AS TIMESTAMP_NTZ) AS ts, user_id AS subject_id,
  user_id * 10 + (day(ts) - 1) div 10 AS icustay_id, event_type, value,
  CAST(get_json_object(props, '$.k') AS INT) AS k
"""
ADMISSION_COLUMNS = """
  hadm_id, subject_id, intime - INTERVAL '6' HOUR AS admittime,
  outtime + INTERVAL '12' HOUR AS dischtime,
  CASE WHEN icustay_id % 9 = 0 THEN outtime - INTERVAL '1' HOUR
       WHEN icustay_id % 9 = 4 THEN outtime + INTERVAL '6' HOUR END AS deathtime
"""
PATIENT_COLUMNS = """
  subject_id, CASE WHEN subject_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  TIMESTAMP_NTZ '2024-01-01 00:00:00' - make_ym_interval(CAST(10 + subject_id % 70 AS INT), 0) AS dob,
  CASE WHEN subject_id % 5 = 0 THEN TIMESTAMP_NTZ '2024-02-01 00:00:00'
       + make_dt_interval(CAST(subject_id % 60 AS INT), 0, 0, 0) END AS dod
"""
# Columns of each record table and the event types it is read from.
RECORDS = {
    "services": (["signup"], """
        icustay_id AS hadm_id, event_id, ts - INTERVAL '2' DAY AS transfertime,
        CASE k % 8 WHEN 0 THEN 'CSURG' WHEN 1 THEN 'CMED' WHEN 2 THEN 'SURG' WHEN 3 THEN 'ORTHO'
             WHEN 4 THEN 'NB' WHEN 5 THEN 'TRAUM' ELSE 'MED' END AS curr_service"""),
    "ventdurations": (["purchase"], """
        icustay_id, event_id, ts AS starttime, ts + make_dt_interval(0, 0, k, 0) AS endtime"""),
    "chartevents": (["click", "view"], """
        event_id, subject_id, icustay_id, ts AS charttime, k % 20 AS itemid,
        CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS valuenum,
        CASE k % 6 WHEN 0 THEN 'Full Code' WHEN 1 THEN 'Comfort Measures'
             WHEN 2 THEN 'Do Not Resuscitate' WHEN 3 THEN 'Other/Remarks'
             WHEN 4 THEN 'CPR Not Indicated' ELSE 'unmapped' END AS value"""),
    "labevents": (["error", "view"], """
        event_id, subject_id, icustay_id AS hadm_id, ts AS charttime, k % 24 AS itemid,
        value AS valuenum, CASE WHEN k % 3 = 0 THEN 'abnormal' END AS flag,
        CAST(NULL AS STRING) AS value"""),
    "outputevents": (["error", "signup"], """
        event_id, subject_id, icustay_id, ts AS charttime, k % 5 AS itemid, value"""),
    "inputevents_cv": (["click", "view"], """
        event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE icustay_id END AS icustay_id,
        ts AS charttime, k % 2 AS itemid,
        CASE WHEN k % 11 = 0 THEN 'Stopped' WHEN k % 13 = 0 THEN 'D/C\\'d' END AS stopped,
        CASE WHEN k % 5 = 0 THEN NULL WHEN k % 4 = 0 THEN 0.0D ELSE value END AS rate,
        value AS amount"""),
    "inputevents_mv": (["signup", "purchase"], """
        event_id, icustay_id, icustay_id * 10 + k % 4 AS linkorderid, k % 6 AS itemid,
        ts AS starttime, ts + make_dt_interval(0, 0, 30 * (k + 1), 0) AS endtime,
        CASE WHEN k % 7 = 0 THEN NULL ELSE value END AS rate, value AS amount,
        CASE WHEN k % 10 = 0 THEN 'Rewritten' WHEN k % 17 = 0 THEN NULL
             ELSE 'FinishedRunning' END AS statusdescription"""),
    "diagnoses_icd": (["error"], """
        event_id, subject_id, icustay_id AS hadm_id,
        CASE k % 12 WHEN 0 THEN '42731' WHEN 1 THEN '5185 ' WHEN 2 THEN '4280 ' WHEN 3 THEN '4280'
             WHEN 4 THEN '486' WHEN 5 THEN '0389' WHEN 6 THEN '99592' WHEN 7 THEN '2390'
             WHEN 8 THEN '1970' WHEN 9 THEN '5849' WHEN 10 THEN '41401'
             ELSE 'V5861' END AS icd9_code"""),
    "procedures_icd": (["purchase"], """
        event_id, subject_id, icustay_id AS hadm_id,
        CASE WHEN k % 3 = 0 THEN '9671' ELSE '3893' END AS icd9_code"""),
    "noteevents": (["signup"], """
        event_id AS row_id, icustay_id AS hadm_id,
        CASE WHEN k % 4 = 0 THEN 'Radiology' ELSE 'Echo' END AS category,
        CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) AS chartdate,
        concat('Indication: case ', CAST(k AS STRING), char(10),
          CASE WHEN k % 7 = 0 THEN '' ELSE concat('Height: (in) ',
            CASE WHEN k % 5 = 0 THEN '[** num **]' ELSE CAST(55 + k % 25 AS STRING) END,
            char(10)) END,
          'Weight (lb): ', CAST(100 + k AS STRING), char(10),
          'BP (mm Hg): ', CAST(90 + k AS STRING), '/', CAST(50 + k % 40 AS STRING), char(10),
          'HR (bpm): ', CAST(60 + k % 50 AS STRING), char(10),
          CASE WHEN k % 9 = 0 THEN '' ELSE concat('Date/Time: [**2024-1-1**] at ',
            lpad(CAST(hour(ts) AS STRING), 2, '0'), ':', lpad(CAST(minute(ts) AS STRING), 2, '0'),
            char(10)) END,
          'Status: Inpatient', char(10)) AS text"""),
    # Blood gases: parts of one gas share the day they were taken.
    "gasevents": (["error", "view"], """
        event_id, subject_id, icustay_id AS hadm_id,
        CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) + make_dt_interval(0, (hour(ts) div 12) * 12, 0, 0)
          AS charttime,
        100 + k % 3 AS itemid, value * 2 AS valuenum, CAST(NULL AS STRING) AS flag,
        CASE WHEN k % 5 = 0 THEN 'VEN' ELSE 'ART' END AS value"""),
    # Coma scale parts: small whole numbers, verbal 0 marks an intubated subject.
    "gcsevents": (["click", "view"], """
        event_id, subject_id, icustay_id, ts AS charttime, 200 + k % 3 AS itemid,
        CAST((k div 3) % 6 AS DOUBLE) AS valuenum, CAST(NULL AS STRING) AS value"""),
}


def event_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.selectExpr(*_split(EVENT_COLUMNS))


def stays_of(events: DataFrame) -> DataFrame:
    stays = events.groupBy("subject_id", "icustay_id").agg(
        F.min("ts").alias("intime"), F.max("ts").alias("outtime"))
    return stays.select("subject_id", F.col("icustay_id").alias("hadm_id"), "icustay_id", "intime",
                        "outtime")


def from_events(events: DataFrame, name: str) -> DataFrame:
    """One mapped table; the event-type filter reaches the Parquet scan."""
    if name == "icustays":
        return stays_of(events)
    if name == "admissions":
        return stays_of(events).selectExpr(*_split(ADMISSION_COLUMNS))
    if name == "patients":
        return events.select("subject_id").distinct().selectExpr(*_split(PATIENT_COLUMNS))
    types, columns = RECORDS[name]
    return events.filter(F.col("event_type").isin(types)).selectExpr(*_split(columns))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return from_events(event_rows(spark, folder), name)


# Records that are part of a larger source table in the study.
JOINED_RECORDS = {"chartevents": "gcsevents", "labevents": "gasevents"}


class MappedTables(dict):
    """The study's source tables, each mapped on first use."""

    def __init__(self, events: DataFrame):
        super().__init__()
        self.events = events

    def __missing__(self, name: str) -> DataFrame:
        rows = from_events(self.events, name)
        if name in JOINED_RECORDS:
            rows = rows.unionByName(from_events(self.events, JOINED_RECORDS[name]))
        self[name] = rows
        return rows


def tables(spark: SparkSession, folder: str) -> MappedTables:
    return MappedTables(event_rows(spark, folder))


def _split(columns: str) -> list[str]:
    """Split a column list at its top-level commas."""
    parts, depth, start, quoted = [], 0, 0, False
    for i, ch in enumerate(columns):
        if ch == "'" and columns[i - 1] != "\\":
            quoted = not quoted
        elif not quoted and ch in "()":
            depth += 1 if ch == "(" else -1
        elif not quoted and ch == "," and depth == 0:
            parts.append(columns[start:i].strip())
            start = i + 1
    return [*parts, columns[start:].strip()]


def _numbered(labels: list[str]) -> dict[int, Item]:
    return {i: Item(label) for i, label in enumerate(labels)}


LINE_ITEMS = (0, 1, 2)
PANEL_ITEMS = _numbered(labels_of(LAB_PANEL))
LAB_ITEMS = {i: Item(labels_of(LABS)[i % 9]) for i in range(22)}
VITAL_ITEMS = {
    **same("MAP", 3, 4, 11, 12),
    **same("Temperature", 5, 13),
    **same("Temperature", 6, 14, shift=32.0, divisor=1.8),
    **same("HeartRate", 7, 8, 15, 16),
    **same("CVP", 9, 17),
    **same("SpO2", 10, 18),
}
GAS_ITEMS = {
    **same("SPECIMEN", 100, above=0.0),
    **same("FIO2", 101, above=0.0, high=100.0),
    **same("PO2", 102, above=0.0, high=800.0),
}
FIO2_ITEMS = {
    **same("FIO2", 11, factor=100.0, above=0.0, high=1.0, otherwise=Item("", low=21.0, high=100.0)),
    **same("FIO2", 12, 13, 14),
    **same("FIO2", 15, factor=100.0, above=0.20, below=1.0),
}
ORGAN_LAB_ITEMS = {
    **same("BILIRUBIN", 0, 1, 2, 3, high=150.0),
    **same("CREATININE", 4, 5, 6, 7, high=150.0),
    **same("PLATELET", 8, 9, 10, 11, high=10000.0),
}
HEIGHT_ITEMS = {**same("HEIGHT", 18, factor=INCH_IN_CM), **same("HEIGHT", 19)}

CONCEPTS = Concepts(
    arterial_line=LINE_ITEMS,
    mean_pressure=(3, 4, 11, 12),
    vitals=VITAL_ITEMS,
    labs=LAB_ITEMS,
    lab_panel=PANEL_ITEMS,
    gas=GAS_ITEMS,
    fio2=FIO2_ITEMS,
    organ_labs=ORGAN_LAB_ITEMS,
    urine=(0, 1, 2),
    gcs_motor=(200,),
    gcs_verbal=(201,),
    gcs_eyes=(202,),
    weight_admit=same("WEIGHT", 16),
    weight_daily=same("WEIGHT", 11, 12, 13, 14, 15, 17),
    height=HEIGHT_ITEMS,
    vasopressor_points=(0, 1),
    vasopressor_intervals=(0, 1, 2),
    anaesthetic_points=(1,),
    anaesthetic_intervals=(3, 4),
    red_cell_points={"rbc": [0], "rbc_or": [1]},
    red_cell_intervals={"rbc": [0, 1], "rbc_or": [2, 3]},
    code_status_items=(4, 9, 14, 19),
)
# The late exclusion uses fewer items, so that some stays remain in the final tables.
FLAG_CONCEPTS = Concepts(vasopressor_points=(7,), vasopressor_intervals=(5,))
RULES = CohortRules(vent_within_hours=48)


# A cohort of nearly all first stays, without late exclusions, for results of more rows.
NEVER = CodeRule(exact=("none",))
BROAD_CONCEPTS = replace(CONCEPTS, sepsis=SepsisRule(NEVER, NEVER, NEVER, NEVER))
BROAD_FLAGS = Concepts(vasopressor_points=(99,), vasopressor_intervals=(99,))
BROAD_RULES = CohortRules(vent_within_hours=100_000, min_days=-1.0, excluded_services=("none",))


def broad_study(spark: SparkSession, folder: str) -> Study:
    return Study(tables(spark, folder), BROAD_CONCEPTS, BROAD_RULES, BROAD_FLAGS)


def study(spark: SparkSession, folder: str) -> Study:
    return Study(tables(spark, folder), CONCEPTS, RULES, FLAG_CONCEPTS)
