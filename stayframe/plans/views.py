"""The study's views, one function each, over a dict of source tables.

Every function takes the written cohort and the source (or extracted) tables
and returns a lazy DataFrame with one row per cohort stay or admission.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from stayframe.functions.numeric import flag
from stayframe.operators.codes import code_flags, code_rule_score
from stayframe.operators.episodes import episode_features, ever_exposed, rate_episodes
from stayframe.operators.intervals import merge_intervals, order_intervals, union_episodes
from stayframe.operators.lookback import (
    label_items, labels_of, last_with_flag, lookback, pick_items, reduce_labels)
from stayframe.operators.measures import body_measure, given_volumes
from stayframe.operators.notes import note_fields
from stayframe.operators.ordered import exact_median, together
from stayframe.operators.scale import MEASURE, Sizes, join_cohort, with_cohort, with_largest
from stayframe.operators.scores import organ_score
from stayframe.operators.status import status_history, switch_flags
from stayframe.plans.concepts import HEMATOCRIT_RANGE, LAB_NAMES, Concepts

# Hours before the index time that each view reads from the lab table.
LAB_HOURS = {"labs": 24, "lab_panel": 7 * 24, "sofa": 24}

INDEX = "vent_starttime"
ADMISSION = ["subject_id", "hadm_id"]
STAY = ["subject_id", "hadm_id", "icustay_id"]
Tables = Mapping[str, DataFrame]


def output_name(label: str) -> str:
    return LAB_NAMES.get(label, label.lower())


def labelled_window(events: DataFrame, cohort: DataFrame, items, before_hours: float,
                    columns: list[str], sizes: Sizes) -> DataFrame:
    """Labelled, cleaned events of the cohort in the window before the index time."""
    events = label_items(events, items).select(
        "subject_id", "charttime", "event_id", "label", "valuenum", *columns)
    narrow = cohort.select(*ADMISSION, INDEX)
    return lookback(events, narrow, ["subject_id"], INDEX, "charttime", before_hours, sizes)


def view_labs(cohort: DataFrame, tables: Tables, concepts: Concepts,
              sizes: Sizes = MEASURE) -> DataFrame:
    """Latest value of each lab in the day before the index time."""
    found = labelled_window(tables["labevents"], cohort, concepts.labs, LAB_HOURS["labs"], [], sizes)
    labels = labels_of(concepts.labs)
    last = reduce_labels(found, ADMISSION, labels, "last")
    named = [F.col(n.lower()).alias(f"{output_name(n)}_first") for n in labels]
    last = last.select("hadm_id", *named)
    return cohort.select(*ADMISSION).join(last, "hadm_id", "left")


def view_vitals(cohort: DataFrame, tables: Tables, concepts: Concepts,
                sizes: Sizes = MEASURE) -> DataFrame:
    """Latest value of each vital sign in the day before the index time."""
    found = labelled_window(tables["chartevents"], cohort, concepts.vitals, 24, [], sizes)
    last = reduce_labels(found, ADMISSION, labels_of(concepts.vitals), "last")
    return cohort.select(*ADMISSION).join(last.drop("subject_id"), "hadm_id", "left")


def hematocrit_flag(gender, median):
    """0 inside the sex-specific normal range, 1 outside it or when missing."""
    normal = F.lit(False)
    for number, (low, high) in HEMATOCRIT_RANGE.items():
        normal = normal | ((gender == number) & median.between(low, high))
    return F.when(normal, 0).otherwise(1)


def view_lab_panel(cohort: DataFrame, tables: Tables, concepts: Concepts,
                   sizes: Sizes = MEASURE) -> DataFrame:
    """Latest value and abnormal flag of the wide lab panel in the week before the index time."""
    found = labelled_window(tables["labevents"], cohort, concepts.lab_panel, LAB_HOURS["lab_panel"], ["flag"], sizes)
    labels = labels_of(concepts.lab_panel)
    crit = found.filter(F.col("label") == "HEMATOCRIT")
    crit_value = F.when(F.col("label") == "HEMATOCRIT", F.col("valuenum"))
    last = last_with_flag(found, ["hadm_id"], labels, "abnormal", also=[
        F.min(crit_value).alias("hct_lowest"), F.max(crit_value).alias("hct_highest")])
    middle = exact_median(crit, ["hadm_id"], "valuenum", "hct_med", sizes)
    rows = (
        cohort.select(*ADMISSION, "gender_num")
        .join(last, "hadm_id", "left")
        .join(middle, "hadm_id", "left")
    )
    values = [F.col(n.lower()).alias(f"{output_name(n)}_first") for n in labels]
    marks = [
        F.col(f"{n.lower()}_abnormal_flg").alias(f"{output_name(n)}_abnormal_flg") for n in labels
    ]
    abnormal = hematocrit_flag(F.col("gender_num"), F.col("hct_med"))
    return rows.select(*ADMISSION, "hct_med", "hct_lowest", "hct_highest",
                       abnormal.alias("hct_abnormal_flg"), *values, *marks)


def view_echodata(cohort: DataFrame, tables: Tables, concepts: Concepts,
                  sizes: Sizes = MEASURE) -> DataFrame:
    return note_fields(cohort, tables["noteevents"], sizes=sizes)


def view_bmi(cohort: DataFrame, tables: Tables, concepts: Concepts, echodata: DataFrame,
             sizes: Sizes = MEASURE) -> DataFrame:
    return body_measure(cohort, tables["chartevents"], echodata, concepts.weight_admit,
                        concepts.weight_daily, concepts.height, sizes)


def view_icd(cohort: DataFrame, tables: Tables, concepts: Concepts,
             normalise: bool = False, sizes: Sizes = MEASURE) -> DataFrame:
    return code_flags(cohort, tables["diagnoses_icd"], "hadm_id", concepts.comorbidities, normalise,
                      sizes)


def view_sepsis(cohort: DataFrame, tables: Tables, concepts: Concepts,
                sizes: Sizes = MEASURE) -> DataFrame:
    return code_rule_score(cohort, tables["admissions"], tables["diagnoses_icd"],
                           tables["procedures_icd"], concepts.sepsis, sizes)


def view_sofa(cohort: DataFrame, tables: Tables, concepts: Concepts,
              sizes: Sizes = MEASURE) -> DataFrame:
    return organ_score(cohort, tables["labevents"], tables["chartevents"], tables["outputevents"],
                       concepts, INDEX, LAB_HOURS["sofa"], sizes)


def view_vaso_flg(cohort: DataFrame, tables: Tables, concepts: Concepts,
                  sizes: Sizes = MEASURE) -> DataFrame:
    """Whether the stay ever got a vasopressor at a positive rate, in either system."""
    points = pick_items(tables["inputevents_cv"], concepts.vasopressor_points)
    intervals = pick_items(tables["inputevents_mv"], concepts.vasopressor_intervals)
    running_points = points.filter(F.col("rate") > 0)
    running_intervals = intervals.filter(
        (F.col("rate") > 0) & (F.col("statusdescription") != "Rewritten"))
    return ever_exposed(cohort.select(*STAY), [running_points, running_intervals], "icustay_id",
                        "vaso_flg", sizes)


def drug_episodes(cohort: DataFrame, tables: Tables, point_items, interval_items,
                  merge_across: bool = False, sizes: Sizes = MEASURE) -> DataFrame:
    """Numbered episodes of a drug group, all drugs together, per cohort stay.

    The systems are merged separately and united, so time covered in both
    counts twice. ``merge_across`` merges them into one series instead.
    """
    by = ["icustay_id"]
    keys = cohort.select("icustay_id")
    points = pick_items(tables["inputevents_cv"], point_items).select(
        "icustay_id", "charttime", "itemid", "stopped", "rate", "amount")
    orders = pick_items(tables["inputevents_mv"], interval_items).select(
        "icustay_id", "linkorderid", "starttime", "endtime", "statusdescription")
    sizes = with_cohort(sizes, cohort)
    points, orders = join_cohort(points, keys, by, sizes=sizes), join_cohort(orders, keys, by, sizes=sizes)
    # No later group is larger than a stay's records, so one measurement covers every step.
    sizes = with_largest(sizes, (points, by), (orders, by))
    from_points = rate_episodes(points, "icustay_id", sizes=sizes)
    from_orders = order_intervals(together(orders, by, sizes), ["icustay_id", "linkorderid"])
    systems = [d.select("icustay_id", "starttime", "endtime") for d in (from_points, from_orders)]
    if merge_across:
        systems = [systems[0].unionByName(systems[1])]
    merged = [merge_intervals(d, by, sizes=sizes) for d in systems]
    return union_episodes(merged, by, "number", sizes=sizes)


def view_drug(cohort: DataFrame, tables: Tables, point_items, interval_items, prefix: str,
              early_hours=(3, 6, 12), early_days: float = 0.0, merge_across: bool = False,
              sizes: Sizes = MEASURE) -> DataFrame:
    episodes = drug_episodes(cohort, tables, point_items, interval_items, merge_across, sizes)
    return episode_features(cohort, episodes, "icustay_id", prefix, early_hours, early_days)


def view_vaso(cohort: DataFrame, tables: Tables, concepts: Concepts, **options) -> DataFrame:
    return view_drug(cohort, tables, concepts.vasopressor_points, concepts.vasopressor_intervals,
                     "vaso", **options)


def view_anaesthesia(cohort: DataFrame, tables: Tables, concepts: Concepts, **options) -> DataFrame:
    return view_drug(cohort, tables, concepts.anaesthetic_points, concepts.anaesthetic_intervals,
                     "anes", early_hours=(), **options)


def view_codestatus(cohort: DataFrame, tables: Tables, concepts: Concepts,
                    sizes: Sizes = MEASURE) -> DataFrame:
    """Code status on admission, later and ever."""
    events = pick_items(tables["chartevents"], concepts.code_status_items).select(
        "icustay_id", "charttime", "event_id", "value")
    events = join_cohort(events, cohort.select("icustay_id"), ["icustay_id"], sizes=sizes)
    history = status_history(events, "icustay_id", concepts.code_status)
    rows = cohort.select(*STAY).join(history, "icustay_id", "left")
    flags = switch_flags(rows)
    ever = ["dnr", "cmo", "dncpr", "dni", "fullcode"]
    switched = ["dnr_adm_flg", "dnr_switch_flg", "cmo_switch_flg", "dnr_cmo_switch_flg"]
    return flags.select(*STAY, "firstcodestatus", "lastcodestatus", *ever, *switched)


def view_rbc(cohort: DataFrame, tables: Tables, concepts: Concepts, clip: bool = False,
             sizes: Sizes = MEASURE) -> DataFrame:
    """Transfused red cells: total and first day, ward and operating room."""
    return given_volumes(cohort, tables["inputevents_cv"], tables["inputevents_mv"],
                         concepts.red_cell_points, concepts.red_cell_intervals, clip, sizes)
