"""Organ dysfunction: gas ratio, coma scale with carry-over, total score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayframe.functions.numeric import first_match, oxygen_ratio, threshold_score
from stayframe.functions.timeutil import hours
from stayframe.operators.lookback import Item, item_label, clean_value, lookback, paired_rows, pick_items
from stayframe.operators.ordered import previous_within, together
from stayframe.operators.scale import MEASURE, Sizes, join_cohort, with_cohort, written

# Score steps (operator, bound, points), first match wins.
RESPIRATION_STEPS = [("<", 300, 2), ("<", 400, 1)]
PLATELET_STEPS = [("<", 20, 4), ("<", 50, 3), ("<", 100, 2), ("<", 150, 1)]
BILIRUBIN_STEPS = [(">=", 12.0, 4), (">=", 6.0, 3), (">=", 2.0, 2), (">=", 1.2, 1)]
PRESSURE_STEPS = [("<", 70, 1)]
# Coma scale bands (low, high, points); below 6 gives 4.
COMA_BANDS = [(13, 14, 1), (10, 12, 2), (6, 9, 3)]
# Normal motor, verbal and eye response.
NORMAL_MOTOR, NORMAL_VERBAL, NORMAL_EYES = 6, 5, 4
COMA_PARTS = ["gcsmotor", "gcsverbal", "gcseyes"]
COMPONENTS = ["respiration", "coagulation", "liver", "cardiovascular", "cns", "renal"]


def renal_points(creatinine: Column, urine: Column) -> Column:
    """Creatinine and urine in one ordered rule; NULL when both are missing."""
    def band(low, high):
        return (creatinine >= low) & (creatinine < high)

    return first_match(
        (creatinine >= 5.0, 4),
        (urine < 200, 4),
        (band(3.5, 5.0), 3),
        (urine < 500, 3),
        (band(2.0, 3.5), 2),
        (band(1.2, 2.0), 1),
        (urine.isNotNull() | creatinine.isNotNull(), 0),
    )


def coma_points(score: Column) -> Column:
    bands = [((score >= low) & (score <= high), points) for low, high, points in COMA_BANDS]
    return F.when(score.isNotNull(), first_match(*bands, (score < 6, 4)).otherwise(0))


def gas_rows(labs: DataFrame, cohort: DataFrame, items: dict[int, Item], index_time: str,
             before_hours: float = 24, sizes: Sizes = MEASURE) -> DataFrame:
    """Blood gases with an oxygen pressure: specimen, FiO2 and PO2 of one time side by side."""
    value = F.col("valuenum")
    events = pick_items(labs, items).select(
        "subject_id", "charttime", F.col("value").alias("_text"),
        item_label(F.col("itemid"), items).alias("_label"),
        clean_value(F.col("itemid"), value, items).alias("_clean"))
    narrow = cohort.select("subject_id", "icustay_id", index_time)
    found = lookback(events, narrow, ["subject_id"], index_time, "charttime", before_hours, sizes)

    def only(label, column):
        return F.when(F.col("_label") == label, F.col(column))

    columns = {
        "specimen": only("SPECIMEN", "_text"),
        "fio2": only("FIO2", "_clean"),
        "po2": only("PO2", "_clean"),
    }
    return paired_rows(found, ["icustay_id", "charttime"], columns, "po2")


def asof_ratio(cohort: DataFrame, labs: DataFrame, chart: DataFrame, gas_items: dict[int, Item],
               fio2_items: dict[int, Item], index_time: str = "vent_starttime",
               before_hours: float = 24, tolerance_hours: float = 4,
               sizes: Sizes = MEASURE) -> DataFrame:
    """PaO2/FiO2 of each stay's latest arterial gas.

    FiO2 comes with the gas, else from the latest charted value at most
    ``tolerance_hours`` old. Gases are reduced to the latest per stay before
    the charted values are matched, so each stay matches one time only.
    """
    sizes = with_cohort(sizes, cohort)
    gases = gas_rows(labs, cohort, gas_items, index_time, before_hours, sizes)
    arterial = gases.filter(F.coalesce("specimen", F.lit("ART")) == "ART")
    latest = arterial.groupBy("icustay_id").agg(
        F.max(F.struct("charttime", "po2", "fio2")).alias("_gas"))
    latest = written(latest.select("icustay_id", F.col("_gas.charttime").alias("gas_time"),
                                   "_gas.po2", "_gas.fio2"), "gas")
    charted = pick_items(chart, fio2_items).select(
        "icustay_id", "charttime",
        clean_value(F.col("itemid"), F.col("valuenum"), fio2_items).alias("_charted"))
    recent = F.col("charttime").between(
        F.col("gas_time") - hours(tolerance_hours), F.col("gas_time"))
    matched = join_cohort(charted, latest.select("icustay_id", "gas_time"), ["icustay_id"], recent, sizes)
    fio2 = matched.groupBy("icustay_id").agg(
        F.max(F.struct("charttime", "_charted")).getField("_charted").alias("fio2_chartevents"))
    both = latest.join(fio2, "icustay_id", "left")
    ratio = oxygen_ratio(F.col("po2"), F.coalesce("fio2", "fio2_chartevents"))
    return both.select("icustay_id", F.col("gas_time").alias("charttime"), "po2", "fio2",
                       "fio2_chartevents", ratio.alias("pao2fio2"))


def coma_rows(chart: DataFrame, cohort: DataFrame, motor, verbal, eyes, index_time: str,
              before_hours: float = 24, sizes: Sizes = MEASURE) -> DataFrame:
    """Motor, verbal and eye response of each charted time in the window."""
    ids = [*motor, *verbal, *eyes]
    events = pick_items(chart, ids).select("subject_id", "charttime", "itemid", "valuenum")
    narrow = cohort.select("subject_id", "icustay_id", index_time)
    found = lookback(events, narrow, ["subject_id"], index_time, "charttime", before_hours, sizes)

    found = together(found, ["icustay_id"], sizes)

    def part(group):
        return F.max(F.when(F.col("itemid").isin(list(group)), F.col("valuenum")))

    return found.groupBy("icustay_id", "charttime").agg(
        part(motor).alias("gcsmotor"), part(verbal).alias("gcsverbal"), part(eyes).alias("gcseyes"))


def worst_coma(rows_in: DataFrame, by: list[str], time: str = "charttime",
               sizes: Sizes = MEASURE) -> DataFrame:
    """Lowest total per stay; missing parts come from a row less than 6 h older, else normal.

    Verbal 0 means intubated and scores 15. After an intubated row nothing is
    carried over.
    """
    rows = previous_within(rows_in, by, time, COMA_PARTS, hours(6), sizes=sizes)
    return rows.groupBy(*by).agg(F.min(coma_total()).cast("double").alias("mingcs"))


def coma_total() -> Column:
    """Total of a row's parts and those of the row before (``prev_``)."""
    normal = dict(zip(COMA_PARTS, (NORMAL_MOTOR, NORMAL_VERBAL, NORMAL_EYES)))
    verbal, before = F.col("gcsverbal"), F.col("prev_gcsverbal")
    fresh = sum((F.coalesce(p, F.lit(n)) for p, n in normal.items()), F.lit(0))
    carried = sum((F.coalesce(p, f"prev_{p}", F.lit(n)) for p, n in normal.items()), F.lit(0))
    return (
        F.when(verbal == 0, 15)
        .when(verbal.isNull() & (before == 0), 15)
        .when(before == 0, fresh)
        .otherwise(carried)
    )


def organ_points(parts: DataFrame, keep: list[str]) -> DataFrame:
    """Six component scores (NULL when not measured) and their total."""
    points = {
        "respiration": threshold_score(F.col("pao2fio2"), RESPIRATION_STEPS),
        "coagulation": threshold_score(F.col("platelet_min"), PLATELET_STEPS),
        "liver": threshold_score(F.col("bilirubin_max"), BILIRUBIN_STEPS),
        "cardiovascular": threshold_score(F.col("meanbp_min"), PRESSURE_STEPS),
        "cns": coma_points(F.col("mingcs")),
        "renal": renal_points(F.col("creatinine_max"), F.col("urineoutput")),
    }
    scored = parts.withColumns(points)
    total = sum((F.coalesce(c, F.lit(0)) for c in COMPONENTS), F.lit(0))
    return scored.select(*keep, total.alias("sofa"), *COMPONENTS)


def organ_score(cohort: DataFrame, labs: DataFrame, chart: DataFrame, outputs: DataFrame, concepts,
                index_time: str = "vent_starttime", before_hours: float = 24,
                sizes: Sizes = MEASURE) -> DataFrame:
    """Organ dysfunction in the day before the index time, one row per stay."""
    sizes = with_cohort(sizes, cohort)
    narrow = cohort.select("subject_id", "icustay_id", index_time)

    def window(events, ids, columns):
        wanted = pick_items(events, ids).select("subject_id", "charttime", *columns)
        return lookback(wanted, narrow, ["subject_id"], index_time, "charttime", before_hours, sizes)

    lab_items = concepts.organ_labs
    value = clean_value(F.col("itemid"), F.col("valuenum"), lab_items)
    lab = window(labs.filter(F.col("valuenum") > 0), lab_items, ["itemid", "valuenum"])
    label = item_label(F.col("itemid"), lab_items)
    by_stay = lab.groupBy("icustay_id").agg(
        F.max(F.when(label == "BILIRUBIN", value)).alias("bilirubin_max"),
        F.max(F.when(label == "CREATININE", value)).alias("creatinine_max"),
        F.min(F.when(label == "PLATELET", value)).alias("platelet_min"))
    pressure = window(chart, concepts.mean_pressure, ["valuenum"]).groupBy("icustay_id").agg(
        F.min("valuenum").alias("meanbp_min"))
    urine = window(outputs, concepts.urine, ["value"]).groupBy("icustay_id").agg(
        F.sum("value").alias("urineoutput"))
    ratio = asof_ratio(cohort, labs, chart, concepts.gas, concepts.fio2, index_time, before_hours,
                       sizes=sizes).select("icustay_id", "pao2fio2")
    coma = worst_coma(
        coma_rows(chart, cohort, concepts.gcs_motor, concepts.gcs_verbal, concepts.gcs_eyes,
                  index_time, before_hours, sizes), ["icustay_id"], sizes=sizes)
    parts = cohort.select("subject_id", "hadm_id", "icustay_id")
    for part in (by_stay, pressure, urine, ratio, coma):
        parts = parts.join(part, "icustay_id", "left")
    return organ_points(parts, ["subject_id", "hadm_id", "icustay_id"])
