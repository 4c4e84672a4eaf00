"""Cohort selection: stays, flags, index time and the inclusion stack."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stayframe.functions.numeric import flag, order_flag
from stayframe.functions.timeutil import (
    day_name, day_of_week, days, days_between, hours, position, years, years_between)
from stayframe.operators.asof import latest_before
from stayframe.operators.intervals import interval_summary
from stayframe.operators.lookback import first_event, pick_items
from stayframe.operators.ordered import numbered
from stayframe.operators.scale import MEASURE, Sizes, join_cohort, written


@dataclass(frozen=True)
class CohortRules:
    """Inclusion limits of the study."""

    adult_years: int = 16
    exposure_grace_hours: int = 1
    vent_within_hours: int = 12
    min_days: float = 1.0
    service_after_hours: int = 2
    censor_days: int = 150
    excluded_services: tuple[str, ...] = ("CSURG", "VSURG", "TSURG", "NB", "NBB")


def all_stays(tables: dict[str, DataFrame]) -> DataFrame:
    """Stays with their admission and patient columns."""
    admissions = tables["admissions"].select("hadm_id", "admittime", "dischtime", "deathtime")
    patients = tables["patients"].select("subject_id", "gender", "dob", "dod")
    stays = tables["icustays"].select("subject_id", "hadm_id", "icustay_id", "intime", "outtime")
    return stays.join(patients, "subject_id").join(admissions, "hadm_id")


def is_adult(rules: CohortRules = CohortRules()) -> Column:
    return F.col("intime") > F.col("dob") + years(rules.adult_years)


def cohort_base(tables: dict[str, DataFrame], rules: CohortRules = CohortRules()) -> DataFrame:
    """Adult stays with their admission and patient columns."""
    return all_stays(tables).filter(is_adult(rules))


def first_stays(base: DataFrame) -> DataFrame:
    """Each subject's first stay; an unknown admission time ranks last, unknown intake times first.

    Two steps of fixed-width minima, which hash and combine map-side: the earliest admission, then the earliest
    (intake, stay) at it. The other columns are fetched by the stay that is left, and never enter a buffer.
    """
    latest, earliest = (F.lit(t).cast("timestamp_ntz") for t in ("9999-12-31 23:59:59", "0001-01-01 00:00:00"))
    known = base.withColumns({"_admit": F.coalesce("admittime", latest), "_in": F.coalesce("intime", earliest)})
    known = known.withColumn("_place", F.expr(position("_in", "icustay_id"))).drop("_in")
    admitted = known.groupBy("subject_id").agg(F.min("_admit").alias("_admit"))
    at_first = known.select("subject_id", "_admit", "_place").join(admitted, ["subject_id", "_admit"])
    chosen = at_first.groupBy("subject_id").agg(F.min("_place").alias("_place"))
    first = known.join(chosen, ["subject_id", "_place"])
    return first.select(*base.columns, F.lit(1).cast("long").alias("stay_num"))


def numbered_stays(base: DataFrame, sizes: Sizes = MEASURE) -> DataFrame:
    """All stays with their position among the subject's stays; unknown admission times rank last."""
    ranked = base.withColumn("_unknown", F.col("admittime").isNull())
    order = ["_unknown", "admittime", "intime", "icustay_id"]
    return numbered(ranked, ["subject_id"], order, "stay_num", sizes).drop("_unknown")


def service_number(service: Column) -> Column:
    """Surgical services 1, cardiac medicine 2, others 0.

    The third branch of the study's rule is covered by the first and never holds.
    """
    surgical = service.like("%SURG") | service.like("%ORTHO%")
    return F.when(surgical, 1).when(service == "CMED", 2).otherwise(0)


def exposure_times(chart: DataFrame, exposure_items) -> DataFrame:
    """First arterial-line measurement per stay."""
    known = F.col("icustay_id").isNotNull() & F.col("valuenum").isNotNull()
    return first_event(pick_items(chart, exposure_items), "icustay_id", "charttime",
                       "starttime_aline", known)


def cohort_flags(stays: DataFrame, tables: dict[str, DataFrame], exposure_items,
                 rules: CohortRules = CohortRules(), sizes: Sizes = MEASURE) -> DataFrame:
    """Demographic, exposure, ventilation, service and outcome columns per stay.

    ``stays`` is a written table of base rows with ``stay_num``.
    """
    mine = stays.select("icustay_id").distinct()
    exposure = exposure_times(join_cohort(tables["chartevents"], mine, ["icustay_id"], sizes=sizes), exposure_items)
    vent = interval_summary(tables["ventdurations"], "icustay_id").select(
        "icustay_id", F.lit(1).alias("_ventilated"), F.col("total_day").alias("vent_day"),
        F.col("first_start").alias("vent_starttime"), F.col("last_end").alias("vent_endtime"))
    services = tables["services"].select("hadm_id", "transfertime", "curr_service", "event_id")
    service = latest_before(
        services, stays.select("hadm_id", "icustay_id", "intime"), ["hadm_id"], "icustay_id",
        F.col("intime") + hours(rules.service_after_hours), "transfertime", "event_id",
        "curr_service", sizes)
    joined = (
        stays.join(exposure, "icustay_id", "left")
        .join(vent, "icustay_id", "left")
        .join(service, "icustay_id", "left")
    )

    intime, outtime, admittime = F.col("intime"), F.col("outtime"), F.col("admittime")
    line, vent_start, dod = F.col("starttime_aline"), F.col("vent_starttime"), F.col("dod")
    grace = intime + hours(rules.exposure_grace_hours)
    early_vent = F.coalesce(vent_start <= intime + hours(2), F.lit(False))
    death_day = days_between(admittime, dod)
    los = days_between(intime, outtime)
    added = {
        "day_icu_intime": day_name(intime),
        "day_icu_intime_num": day_of_week(intime),
        "hour_icu_intime": F.hour(intime),
        "age": years_between(F.col("dob"), intime),
        "gender_num": flag(F.col("gender") == "M"),
        "aline_flg": flag(line.isNotNull()),
        "aline_time_day": days_between(intime, line),
        "initial_aline_flg": flag(line <= grace),
        "vent_flg": flag(F.col("_ventilated").isNotNull()),
        "vent_1st_12hr": flag(vent_start < intime + hours(12)),
        "vent_1st_24hr": flag(vent_start < intime + hours(24)),
        "vent_b4_aline": order_flag(vent_start, line, early_vent, line > grace, line.isNotNull()),
        "vent_free_day": days_between(F.col("vent_endtime"), outtime),
        "vent_off_day": los - F.col("vent_day"),
        "icu_los_day": los,
        "hospital_los_day": days_between(admittime, F.col("dischtime")),
        "intime_dayofweek": day_of_week(intime),
        "intime_hour": F.hour(intime),
        "service_unit": F.col("curr_service"),
        "service_num": service_number(F.col("curr_service")),
        "hosp_exp_flg": flag(F.col("deathtime").isNotNull()),
        "icu_exp_flg": flag(F.col("deathtime") <= outtime),
        "day_28_flg": flag(dod <= intime + days(28)),
        "mort_day": death_day,
        "mort_day_censored": F.coalesce(death_day, F.lit(float(rules.censor_days))),
        "censor_flg": flag(dod.isNull()),
    }
    return joined.withColumns(added).select(*COHORT_COLUMNS)


# Columns of the cohort table, in order.
COHORT_COLUMNS = [
    "subject_id", "hadm_id", "icustay_id", "intime", "day_icu_intime", "day_icu_intime_num",
    "hour_icu_intime", "outtime", "stay_num", "age", "gender", "gender_num", "starttime_aline",
    "aline_flg", "aline_time_day", "initial_aline_flg", "vent_flg", "vent_1st_12hr",
    "vent_1st_24hr", "vent_b4_aline", "vent_day", "vent_free_day", "vent_off_day",
    "vent_starttime", "vent_endtime", "icu_los_day", "hospital_los_day", "intime_dayofweek",
    "intime_hour", "service_unit", "service_num", "hosp_exp_flg", "icu_exp_flg", "day_28_flg",
    "mort_day", "mort_day_censored", "censor_flg",
]


def inclusion_steps(rules: CohortRules = CohortRules()) -> list[tuple[str, Column]]:
    """Named inclusion predicates, in the order they are counted."""
    vent = F.col("vent_starttime")
    return [
        ("first_stay", F.col("stay_num") == 1),
        ("long_enough", F.col("icu_los_day") > rules.min_days),
        ("not_exposed_at_intake", F.col("initial_aline_flg") == 0),
        ("ventilated", vent.isNotNull()),
        ("ventilated_early", vent < F.col("intime") + hours(rules.vent_within_hours)),
        ("service", ~F.col("service_unit").isin(list(rules.excluded_services))),
    ]


def select_cohort(stays: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows for which every step holds; an unknown predicate excludes the row."""
    for _, predicate in steps:
        stays = stays.filter(predicate)
    return stays


def full_attrition(stays: DataFrame, flagged: DataFrame, rules: CohortRules = CohortRules()) -> DataFrame:
    """Rows left after each step from all stays on: adults first, then ``inclusion_steps``."""
    adult = attrition(stays, [("all_stays", F.lit(True)), ("adult", is_adult(rules))])
    rest = attrition(flagged, inclusion_steps(rules))
    return adult.unionByName(rest.withColumn("step", F.col("step") + 2))


def attrition(stays: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows left after each step, counted in one pass."""
    counts, passed = [], F.lit(True)
    for position, (name, predicate) in enumerate(steps, start=1):
        passed = passed & F.coalesce(predicate, F.lit(False))
        counts.append(F.struct(
            F.lit(position).alias("step"), F.lit(name).alias("name"),
            F.sum(flag(passed)).alias("remaining")))
    return stays.agg(F.array(*counts).alias("_steps")).select(F.inline("_steps"))


def build_cohort(tables: dict[str, DataFrame], exposure_items,
                 rules: CohortRules = CohortRules(), sizes: Sizes = MEASURE) -> DataFrame:
    """The study cohort as a written table.

    The first adult stay is chosen before the flags are computed, so the
    service join only sees one stay per subject.
    """
    stays = written(first_stays(cohort_base(tables, rules)), "stays")
    flagged = cohort_flags(stays, tables, exposure_items, rules, sizes)
    return written(select_cohort(flagged, inclusion_steps(rules)), "cohort")
