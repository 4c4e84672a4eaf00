"""Named queries over the mapped tables, one per operator.

Doubles are rounded to 6 digits so that another engine's order of summation
does not show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayframe.functions import numeric as N, text as X, timeutil as T
from stayframe.operators import (
    asof, cohort as C, episodes as E, intervals as I, lookback as L, measures as M, notes, ordered,
    scores as S)
from stayframe.operators.scale import MEASURE, Sizes, fresh_folder, with_largest, written
from stayframe.plans import study as build, views as V
from stayframe.sources import layout, mapped

STAY = ["subject_id", "hadm_id", "icustay_id"]
CONCEPTS = mapped.CONCEPTS
INDEX = "vent_starttime"
Query = Callable[[SparkSession, str], DataFrame]


def tidy(df: DataFrame) -> DataFrame:
    """Round the double columns."""
    rounded = {
        f.name: F.round(f.name, 6) for f in df.schema.fields if f.dataType.typeName() == "double"
    }
    return df.withColumns(rounded) if rounded else df


def cohort_of(spark: SparkSession, folder: str) -> DataFrame:
    return mapped.study(spark, folder).cohort()


def cohort_and_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, V.Tables]:
    study = mapped.study(spark, folder)
    return study.cohort(), study.tables


def flagged_stays(spark: SparkSession, folder: str) -> DataFrame:
    """Flags of every adult stay, with its position among the subject's stays."""
    found = mapped.tables(spark, folder)
    base = C.cohort_base(found, mapped.RULES)
    stays = written(C.numbered_stays(base), "stays")
    return C.cohort_flags(stays, found, mapped.LINE_ITEMS, mapped.RULES)


# -- scalar functions -------------------------------------------------------

def scalar_time(spark, folder):
    ts = F.col("ts")
    return tidy(mapped.event_rows(spark, folder).select(
        "event_id",
        T.day_of_week(ts).alias("day_num"),
        T.day_name(ts).alias("day_name"),
        F.hour(ts).alias("hour_num"),
        T.day_floor(ts).alias("day_start"),
        T.days_between(T.day_floor(ts), ts).alias("day_share"),
        T.years_between(F.lit("1990-05-17 12:00:00").cast("timestamp_ntz"), ts).alias("age"),
        (ts + T.hours(2)).alias("in_two_hours"),
        (ts - T.days(7)).alias("week_before"),
        (ts - T.years(16)).alias("years_before"),
        N.flag(ts - T.day_floor(ts) <= T.hours(12)).alias("morning"),
    ))


def scalar_text(spark, folder):
    note = mapped.table(spark, folder, "noteevents")
    clock = X.first_group(F.col("text"), notes.CLOCK_PATTERN)
    fields = notes.extract_fields(note)
    return tidy(fields.select(
        "row_id",
        F.date_format("chartdate", "dd-MM-yyyy").alias("date_text"),
        clock.alias("clock"),
        T.with_clock(F.col("chartdate"), clock).alias("charttime"),
        F.concat(F.date_format("chartdate", "dd-MM-yyyy"), clock).alias("stamp"),
        F.substring("text", 1, 10).alias("head"),
        F.contains("text", F.lit("*")).alias("masked"),
        *notes.FIELD_PATTERNS,
    ))


def scalar_numeric(spark, folder):
    rows = mapped.table(spark, folder, "chartevents")
    value, item = F.col("valuenum"), F.col("itemid")
    return tidy(rows.select(
        "event_id",
        N.fahrenheit_to_celsius(value).alias("celsius"),
        (value * N.INCH_IN_CM).alias("centimetres"),
        (value * N.POUND_IN_KG).alias("kilograms"),
        N.round_half_up(value / 3, 2).alias("rounded"),
        N.metric_bmi(value, item / 10).alias("bmi_metric"),
        N.imperial_bmi(value, item + 61.3).alias("bmi_imperial"),
        F.coalesce(F.when(item > 10, value), -value, F.lit(0.0)).alias("fallback"),
        N.sum_of_known(value, F.when(item < 10, item)).alias("known_sum"),
        N.oxygen_ratio(F.lit(90.0), value).alias("oxygen"),
        F.expr("2 div 24").cast("int").alias("whole_division"),
        F.try_divide(value, item.cast("double")).alias("safe_ratio"),
    ))


def null_logic(spark, folder):
    rows = mapped.table(spark, folder, "inputevents_cv")
    rate, stopped = F.col("rate"), F.col("stopped")
    return rows.select(
        "event_id",
        N.first_match((rate > 50, "high"), (rate > 0, "low"), (rate == 0, "zero")).alias("band"),
        N.flag(rate > 0).alias("running"),
        N.flag(stopped != "Stopped").alias("other_stop"),
        N.flag(rate.isNull() | stopped.isNotNull()).alias("open_or_marked"),
        N.flag(~F.col("itemid").isin(0) & (rate <= 10)).alias("small_other"),
        F.when(stopped.isin("Stopped", "D/C'd") & rate.isNull(), 1).alias("stopped_unknown"),
    )


# -- scans and item rules ---------------------------------------------------

def scan_chart_items(spark, folder):
    rows = L.pick_items(mapped.table(spark, folder, "chartevents"), mapped.LINE_ITEMS)
    return rows.filter(F.col("icustay_id").isNotNull() & F.col("valuenum").isNotNull()).select(
        "event_id", "icustay_id", "charttime", "itemid", "valuenum")


def scan_lab_items(spark, folder):
    rows = L.pick_items(mapped.table(spark, folder, "labevents"), mapped.LAB_ITEMS)
    return rows.select("event_id", "subject_id", "charttime", "itemid", "valuenum", "flag")


def item_label(spark, folder):
    rows = L.label_items(mapped.table(spark, folder, "labevents"), mapped.LAB_ITEMS)
    return rows.select("event_id", "itemid", "label", "valuenum")


def unit_clean(spark, folder):
    """Unit rules of vital signs and charted oxygen over all chart rows."""
    rows = mapped.table(spark, folder, "chartevents")
    item, value = F.col("itemid"), F.col("valuenum")
    return tidy(rows.select(
        "event_id",
        L.item_label(item, CONCEPTS.vitals).alias("vital"),
        L.clean_value(item, value, CONCEPTS.vitals).alias("vital_value"),
        L.clean_value(item, value, CONCEPTS.fio2).alias("fio2"),
    ))


def sample_limit(spark, folder):
    rows = mapped.table(spark, folder, "labevents")
    return rows.orderBy("event_id").limit(5).select("event_id", "subject_id", "itemid", "valuenum")


# -- cohort -----------------------------------------------------------------

def cohort_base(spark, folder):
    base = C.cohort_base(mapped.tables(spark, folder), mapped.RULES)
    return base.select(*STAY, "intime", "outtime", "admittime", "dischtime", "deathtime", "gender",
                       "dob", "dod")


def cohort_flags(spark, folder):
    return tidy(flagged_stays(spark, folder))


def cohort_select(spark, folder):
    return tidy(cohort_of(spark, folder))


def cohort_attrition(spark, folder):
    stays = C.all_stays(mapped.tables(spark, folder))
    return C.full_attrition(stays, flagged_stays(spark, folder), mapped.RULES)


def first_event(spark, folder):
    return C.exposure_times(mapped.table(spark, folder, "chartevents"), mapped.LINE_ITEMS)


def interval_summary(spark, folder):
    return tidy(I.interval_summary(mapped.table(spark, folder, "ventdurations"), "icustay_id"))


def asof_service(spark, folder):
    """Service at intake + 2 h of every stay, by the general as-of match."""
    stays = mapped.table(spark, folder, "icustays").select(
        "hadm_id", "icustay_id", (F.col("intime") + T.hours(2)).alias("at"))
    services = mapped.table(spark, folder, "services")
    return asof.asof_join(stays, services, ["hadm_id"], "at", "transfertime", ["curr_service"],
                          "event_id", strict=True)


def order_flag(spark, folder):
    """Ventilated before the line was placed, for every stay."""
    stays = mapped.table(spark, folder, "icustays").select("icustay_id", "intime")
    line = first_event(spark, folder)
    vent = mapped.table(spark, folder, "ventdurations").groupBy("icustay_id").agg(
        F.min("starttime").alias("vent_start"))
    rows = stays.join(line, "icustay_id", "left").join(vent, "icustay_id", "left")
    start, placed = F.col("vent_start"), F.col("starttime_aline")
    early = F.coalesce(start <= F.col("intime") + T.hours(2), F.lit(False))
    late_line = placed > F.col("intime") + T.hours(1)
    return rows.select("icustay_id", N.order_flag(start, placed, early, late_line, placed.isNotNull())
                       .alias("vent_b4_aline"))


# -- lookback ---------------------------------------------------------------

def last_value_pivot(spark, folder):
    """Latest labs and vitals before the index time, side by side."""
    cohort, found = cohort_and_tables(spark, folder)
    labs = V.view_labs(cohort, found, CONCEPTS)
    vitals = V.view_vitals(cohort, found, CONCEPTS)
    return tidy(labs.join(vitals.drop("subject_id"), "hadm_id"))


def lookback_join(spark, folder):
    cohort = cohort_of(spark, folder).select("subject_id", "icustay_id", INDEX)
    rows = mapped.table(spark, folder, "chartevents").drop("icustay_id", "value")
    return L.lookback(rows, cohort, ["subject_id"], INDEX, "charttime", 24)


def lookback_thinned(spark, folder):
    """As ``lookback_join``, for a cohort too large to broadcast: events pass a Bloom filter before the shuffle."""
    cohort = written(cohort_of(spark, folder).select("subject_id", "icustay_id", INDEX), "keys")
    rows = mapped.table(spark, folder, "chartevents").drop("icustay_id", "value")
    return L.lookback(rows, cohort, ["subject_id"], INDEX, "charttime", 24, Sizes(small_cohort=False))


def grouped_scan(spark, folder):
    """As ``scan_lab_items``, from lab rows stored in one folder for each concept group."""
    groups = {"labs": CONCEPTS.labs, "organ": CONCEPTS.organ_labs, "gas": CONCEPTS.gas}
    path = fresh_folder(spark, "labevents")
    layout.store_by_group(mapped.table(spark, folder, "labevents"), path, groups, key="subject_id")
    found = layout.read_by_group(spark, path, groups, CONCEPTS.labs)
    return found.select("event_id", "subject_id", "charttime", "itemid", "valuenum", "flag")


def lookback_left(spark, folder):
    cohort = cohort_of(spark, folder).select("subject_id", "icustay_id", INDEX)
    rows = mapped.table(spark, folder, "labevents").select(
        "event_id", "subject_id", "charttime", "itemid", "valuenum")
    return L.lookback_left(rows, cohort, ["subject_id"], INDEX, "charttime", 24, "icustay_id")


def windowed_sum(spark, folder):
    cohort = cohort_of(spark, folder).select("subject_id", "icustay_id", INDEX)
    rows = L.pick_items(mapped.table(spark, folder, "outputevents"), CONCEPTS.urine).select(
        "subject_id", "charttime", "value")
    found = L.lookback(rows, cohort, ["subject_id"], INDEX, "charttime", 24)
    total = found.groupBy("icustay_id").agg(F.sum("value").alias("urineoutput"))
    return tidy(cohort.select("icustay_id").join(total, "icustay_id", "left"))


def median_measure(spark, folder):
    cohort = cohort_of(spark, folder)
    rows = mapped.table(spark, folder, "chartevents")
    height = M.median_measure(rows, cohort, CONCEPTS.height, "outtime", None, "height_chart")
    return tidy(cohort.select("icustay_id").join(height, "icustay_id", "left"))


def stay_median(spark, folder):
    """Exact median of every stay's chart values, over the whole table."""
    rows = mapped.table(spark, folder, "chartevents")
    return tidy(ordered.exact_median(rows, ["icustay_id"], "valuenum", "median"))


def lab_range(spark, folder):
    """Lowest, highest and median value per stay and lab over the whole table."""
    rows = L.label_items(mapped.table(spark, folder, "labevents"), mapped.PANEL_ITEMS)
    key = ["hadm_id", "label"]
    ends = rows.groupBy(*key).agg(F.min("valuenum").alias("lowest"), F.max("valuenum").alias("highest"))
    middle = ordered.exact_median(rows, key, "valuenum", "median")
    return tidy(ends.join(middle, key, "left"))


def paired_pivot(spark, folder):
    """Blood gases of all subjects with their parts side by side."""
    rows = mapped.table(spark, folder, "gasevents")
    item, value = F.col("itemid"), F.col("valuenum")
    label = L.item_label(item, CONCEPTS.gas)
    clean = L.clean_value(item, value, CONCEPTS.gas)
    columns = {
        "specimen": F.when(label == "SPECIMEN", F.col("value")),
        "fio2": F.when(label == "FIO2", clean),
        "po2": F.when(label == "PO2", clean),
    }
    return tidy(L.paired_rows(rows, ["subject_id", "charttime"], columns, "po2"))


def lab_panel(spark, folder):
    panel = mapped.study(spark, folder).view("labs_all")
    return tidy(panel.select(*[c for c in panel.columns if not c.endswith("_abnormal_flg")]))


def lab_abnormal(spark, folder):
    panel = mapped.study(spark, folder).view("labs_all")
    return panel.select("hadm_id", *[c for c in panel.columns if c.endswith("_abnormal_flg")])


# -- codes, exposure, status ------------------------------------------------

def code_flags(spark, folder):
    return V.view_icd(*cohort_and_tables(spark, folder), CONCEPTS)


def code_flags_trimmed(spark, folder):
    return V.view_icd(*cohort_and_tables(spark, folder), CONCEPTS, normalise=True)


def code_rule_score(spark, folder):
    return V.view_sepsis(*cohort_and_tables(spark, folder), CONCEPTS)


def ever_exposed(spark, folder):
    return V.view_vaso_flg(*cohort_and_tables(spark, folder), mapped.FLAG_CONCEPTS)


def status_history(spark, folder):
    return V.view_codestatus(*cohort_and_tables(spark, folder), CONCEPTS)


# -- episodes and intervals -------------------------------------------------

def dose_rows(spark, folder):
    """One record per stay, item and time, with the bound of the raw records."""
    doses = mapped.table(spark, folder, "inputevents_cv").filter(F.col("icustay_id").isNotNull())
    key = ["icustay_id", "itemid"]
    sizes = with_largest(MEASURE, (doses, key))
    return E.one_row_per_time(ordered.together(doses, key, sizes), key, "charttime"), sizes


def forward_fill(spark, folder):
    rows, sizes = dose_rows(spark, folder)
    return ordered.carry_forward(rows, ["icustay_id", "itemid"], "charttime", "rate",
                                 "carried_rate", sizes)


def dose_sizes(found: V.Tables) -> Sizes:
    """One bound for all steps: no later group is larger than a stay's dose records."""
    stay = ["icustay_id"]
    points = found["inputevents_cv"].filter(F.col("icustay_id").isNotNull())
    return with_largest(MEASURE, (points, stay), (found["inputevents_mv"], stay))


def rate_episodes(spark, folder):
    return E.rate_episodes(mapped.table(spark, folder, "inputevents_cv"), "icustay_id")


def order_intervals(spark, folder):
    return I.order_intervals(mapped.table(spark, folder, "inputevents_mv"), ["icustay_id", "linkorderid"])


def sized_orders(spark, folder):
    """Order intervals, laid out by stay when no stay is too large, and their bound."""
    rows, stay = mapped.table(spark, folder, "inputevents_mv"), ["icustay_id"]
    sizes = with_largest(MEASURE, (rows, stay))
    return I.order_intervals(ordered.together(rows, stay, sizes), [*stay, "linkorderid"]), sizes


def merge_intervals(spark, folder):
    orders, sizes = sized_orders(spark, folder)
    return I.merge_intervals(orders, ["icustay_id"], sizes=sizes)


def overlap_pairs(spark, folder):
    """Every drug order with every ventilation of its stay that it overlaps."""
    orders, sizes = sized_orders(spark, folder)
    return I.overlapping_pairs(orders, mapped.table(spark, folder, "ventdurations").select("icustay_id", "starttime", "endtime"), ["icustay_id"], prefix="vent_", sizes=sizes)


def anti_overlap(spark, folder):
    orders, sizes = sized_orders(spark, folder)
    return I.uncovered_starts(orders, ["icustay_id"], sizes=sizes)


def episode_sequence(spark, folder):
    (points, _), sizes = merged_systems(mapped.tables(spark, folder))
    return ordered.numbered(points, ["icustay_id"], ["starttime"], "number", sizes)


def merged_systems(found: V.Tables) -> tuple[list[DataFrame], Sizes]:
    """Merged episodes of each input system and their size bound."""
    stay, sizes = ["icustay_id"], dose_sizes(found)
    systems = [
        E.rate_episodes(found["inputevents_cv"], "icustay_id", sizes=sizes),
        I.order_intervals(ordered.together(found["inputevents_mv"], stay, sizes),
                          ["icustay_id", "linkorderid"]),
    ]
    return [I.merge_intervals(system, stay, sizes=sizes) for system in systems], sizes


def union_episodes(spark, folder):
    systems, sizes = merged_systems(mapped.tables(spark, folder))
    return I.union_episodes(systems, ["icustay_id"], "number", sizes=sizes)


DOSES = ("inputevents_cv", "inputevents_mv")


def episode_features(spark, folder):
    cohort, found, sizes = mapped.study(spark, folder).prepare(*DOSES)
    return tidy(V.view_vaso(cohort, found, CONCEPTS, sizes=sizes))


def episode_features_merged(spark, folder):
    """As ``episode_features``, with time covered in both systems counted once."""
    cohort, found, sizes = mapped.study(spark, folder).prepare(*DOSES)
    return tidy(V.view_vaso(cohort, found, CONCEPTS, merge_across=True, sizes=sizes))


def anaesthesia_features(spark, folder):
    cohort, found, sizes = mapped.study(spark, folder).prepare(*DOSES)
    return tidy(V.view_anaesthesia(cohort, found, CONCEPTS, sizes=sizes))


def prorated_volume(spark, folder):
    return tidy(V.view_rbc(*cohort_and_tables(spark, folder), CONCEPTS))


# -- scores, notes, measures ------------------------------------------------

def asof_ratio(spark, folder):
    cohort, found = cohort_and_tables(spark, folder)
    return tidy(S.asof_ratio(cohort, found["labevents"], found["chartevents"], CONCEPTS.gas,
                             CONCEPTS.fio2))


def asof_values(spark, folder):
    """Every lab row with the latest chart value of the stay at most 4 h before it."""
    labs = mapped.table(spark, folder, "labevents").select(
        F.col("hadm_id").alias("icustay_id"), F.col("event_id").alias("lab_id"),
        F.col("charttime").alias("lab_time"))
    chart = mapped.table(spark, folder, "chartevents").select(
        "icustay_id", "event_id", "charttime", "valuenum")
    return asof.asof_join(labs, chart, ["icustay_id"], "lab_time", "charttime", ["valuenum"],
                          "event_id", tolerance=T.hours(4))


def asof_unknown(spark, folder):
    """As-of match in which some keys and times are unknown on either side."""
    labs = mapped.table(spark, folder, "labevents").select(
        F.when(F.col("event_id") % 5 != 0, F.col("hadm_id")).alias("icustay_id"),
        F.col("event_id").alias("lab_id"), F.col("charttime").alias("lab_time"))
    chart = mapped.table(spark, folder, "chartevents").select(
        F.when(F.col("event_id") % 7 != 0, F.col("icustay_id")).alias("icustay_id"), "event_id",
        F.when(F.col("event_id") % 11 != 0, F.col("charttime")).alias("charttime"), "valuenum")
    return asof.asof_join(labs, chart, ["icustay_id"], "lab_time", "charttime", ["valuenum"], "event_id")


def unknown_orders(spark, folder):
    """Every order twice, some without a stay."""
    orders, _ = sized_orders(spark, folder)
    stay = F.when(F.hour("starttime") % 4 != 0, F.col("icustay_id"))
    return orders.unionByName(orders).withColumn("icustay_id", stay)


def merge_unknown(spark, folder):
    return I.merge_intervals(unknown_orders(spark, folder), ["icustay_id"])


def anti_unknown(spark, folder):
    return I.uncovered_starts(unknown_orders(spark, folder), ["icustay_id"])


def coma_of_all(spark, folder):
    rows, stay = mapped.table(spark, folder, "gcsevents"), ["icustay_id"]
    sizes = with_largest(MEASURE, (rows, stay))
    rows = ordered.together(rows, stay, sizes)

    def part(item):
        return F.max(F.when(F.col("itemid") == item, F.col("valuenum")))

    return rows.groupBy("icustay_id", "charttime").agg(
        part(200).alias("gcsmotor"), part(201).alias("gcsverbal"),
        part(202).alias("gcseyes")), sizes


def prev_value_score(spark, folder):
    """Worst coma score of every stay, over all its records."""
    rows, sizes = coma_of_all(spark, folder)
    return S.worst_coma(rows, ["icustay_id"], sizes=sizes)


def organ_score(spark, folder):
    return mapped.study(spark, folder).view("sofa")


def note_fields(spark, folder):
    return tidy(V.view_echodata(*cohort_and_tables(spark, folder), CONCEPTS))


def body_measure(spark, folder):
    return tidy(mapped.study(spark, folder).view("bmi"))


# -- assembly ---------------------------------------------------------------

def assemble_final(spark, folder):
    return tidy(mapped.study(spark, folder).final())


def assemble_wide(spark, folder):
    return tidy(mapped.study(spark, folder).wide())


def assemble_scored(spark, folder):
    """The wide table with external severity scores, here simple functions of the stay."""
    study = mapped.study(spark, folder)
    stays = study.tables["icustays"]
    score = (F.col("icustay_id") % 20).cast("int")
    study.tables["saps"] = stays.select("icustay_id", score.alias("saps"))
    study.tables["sofa"] = stays.filter(score > 3).select("icustay_id", (score - 3).alias("sofa"))
    study.tables["angus_sepsis"] = stays.filter(score % 4 < 2).select(
        "hadm_id", (score % 4).cast("int").alias("angus"))
    scored = study.wide()
    return scored.select(*STAY, "sapsi_first", "sofa_first", "sepsis_flg", "vaso_flg", "anes_flg")


def build_all(spark, folder):
    return build.build_report(build.build_all(spark, mapped.study(spark, folder)))


def build_rows(spark, folder):
    """Every number in every stored view of a build."""
    return build.build_numbers(build.build_all(spark, mapped.study(spark, folder)))


def final_broad(spark, folder):
    """The analysis table of nearly all first stays."""
    return tidy(mapped.broad_study(spark, folder).final())


def wide_broad(spark, folder):
    return tidy(mapped.broad_study(spark, folder).wide())


def ratio_broad(spark, folder):
    """As ``asof_ratio``, for nearly all first stays."""
    study = mapped.broad_study(spark, folder)
    return tidy(S.asof_ratio(study.cohort(), study.tables["labevents"], study.tables["chartevents"], CONCEPTS.gas, CONCEPTS.fio2))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        scalar_time, scalar_text, scalar_numeric, null_logic, scan_chart_items, scan_lab_items,
        item_label, unit_clean, sample_limit, cohort_base, cohort_flags, cohort_select,
        cohort_attrition, first_event, interval_summary, asof_service, order_flag,
        last_value_pivot, lookback_join, lookback_left, windowed_sum, median_measure, stay_median,
        lab_range, paired_pivot, lab_panel, lab_abnormal, code_flags, code_flags_trimmed,
        code_rule_score, ever_exposed, status_history, forward_fill, rate_episodes,
        order_intervals, merge_intervals, anti_overlap, episode_sequence, union_episodes,
        episode_features, episode_features_merged, anaesthesia_features, prorated_volume,
        asof_ratio, asof_values, asof_unknown, merge_unknown, anti_unknown, prev_value_score, organ_score, note_fields, body_measure,
        assemble_final, assemble_wide, assemble_scored, build_all, build_rows, final_broad, wide_broad, ratio_broad,
        overlap_pairs, lookback_thinned, grouped_scan,
    )
}
