"""Structured fields from free-text reports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from stayframe.functions.numeric import imperial_bmi
from stayframe.functions.text import first_group, guarded_number
from stayframe.functions.timeutil import day_floor, days, position, with_clock
from stayframe.operators.scale import MEASURE, Sizes, join_cohort, written

# Report patterns, group 1 is the field.
CLOCK_PATTERN = r"Date/Time: [\[\]0-9*-]+ at ([0-9:]+)"
FIELD_PATTERNS = {
    "indication": (r"Indication: (.*?)\n", "text"),
    "height_first": (r"Height: \(in\) (.*?)\n", "number"),
    "weight_first": (r"Weight \(lb\): (.*?)\n", "number"),
    "bsa_first": (r"BSA \(m2\): (.*?) m2\n", "number"),
    "bp": (r"BP \(mm Hg\): (.*?)\n", "text"),
    "bpsys": (r"BP \(mm Hg\): ([0-9]+)/[0-9]+?\n", "number"),
    "bpdias": (r"BP \(mm Hg\): [0-9]+/([0-9]+?)\n", "number"),
    "hr": (r"HR \(bpm\): ([0-9]+?)\n", "number"),
    "status": (r"Status: (.*?)\n", "text"),
    "test": (r"Test: (.*?)\n", "text"),
    "doppler": (r"Doppler: (.*?)\n", "text"),
    "contrast": (r"Contrast: (.*?)\n", "text"),
    "technicalquality": (r"Technical Quality: (.*?)\n", "text"),
}


def extract_fields(notes: DataFrame, patterns=None, text: str = "text") -> DataFrame:
    """Add one column per pattern; masked or malformed numbers become NULL."""
    columns = {}
    for name, (pattern, kind) in (patterns or FIELD_PATTERNS).items():
        found = first_group(F.col(text), pattern)
        columns[name] = guarded_number(found) if kind == "number" else found
    return notes.withColumns(columns)


def note_fields(cohort: DataFrame, notes: DataFrame, category: str = "Echo", days_before: int = 7,
                index_time: str = "vent_starttime", sizes: Sizes = MEASURE) -> DataFrame:
    """Fields of each stay's earliest report in the days up to the index time.

    The report's clock time is read from its text; reports without one rank
    last. Only the clock pattern runs on every report, the other patterns run
    on the one report kept per stay.
    """
    keys = ["subject_id", "hadm_id", "icustay_id"]
    narrow = cohort.select(*keys, F.col(index_time).alias("_index"))
    recent = (F.col("chartdate") <= F.col("_index")) & (
        F.col("chartdate") >= day_floor(F.col("_index") - days(days_before)))
    wanted = notes.filter(F.col("category") == category).select("row_id", "hadm_id", "chartdate", "text")
    found = join_cohort(wanted, narrow, ["hadm_id"], recent, sizes)
    timed = found.withColumn(
        "charttime", with_clock(F.col("chartdate"), first_group(F.col("text"), CLOCK_PATTERN)))
    unknown = F.expr("CAST(9e36 AS DECIMAL(38, 0)) + CAST(row_id AS DECIMAL(19, 0))")
    place = F.coalesce(F.expr(position("charttime", "row_id")), unknown)
    first = timed.drop("text").withColumn("_place", place).groupBy("icustay_id").agg(
        *[F.min_by(c, "_place").alias(c) for c in ("row_id", "chartdate", "charttime")])
    first = written(first, "first_notes")
    texts = join_cohort(wanted.select("row_id", "text"), first, ["row_id"], sizes=replace(sizes, small_cohort=None))
    fields = extract_fields(texts).drop("text")
    fields = fields.withColumn("bmi", imperial_bmi(F.col("weight_first"), F.col("height_first")))
    ordered = ["row_id", "chartdate", "charttime", "indication", "height_first", "weight_first",
               "bmi", "bsa_first", "bp", "bpsys", "bpdias", "hr", "status", "test", "doppler",
               "contrast", "technicalquality"]
    return cohort.select(*keys).join(fields, "icustay_id", "left").select(*keys, *ordered)
