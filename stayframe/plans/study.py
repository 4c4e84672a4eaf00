"""Build of all views and the two final tables."""

from __future__ import annotations

import uuid
from collections import ChainMap
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayframe.operators.assemble import View, assemble
from stayframe.operators.cohort import CohortRules, build_cohort
from stayframe.operators.fused import stream
from stayframe.operators.lookback import lookback, pick_items
from stayframe.operators.scale import (
    MEASURE, Sizes, assert_unique, fits_task, fresh_folder, in_parallel, join_cohort, with_cohort, with_largest, written)
from stayframe.operators.scores import COMPONENTS
from stayframe.plans import passes, views
from stayframe.plans.manifest import Run, Step, publish, source_fingerprint
from stayframe.plans.concepts import Concepts
from stayframe.plans.views import INDEX, Tables
from stayframe.sources import files
from stayframe.sources.tables import EXTERNAL, SCHEMAS, column_names

# Columns of the final table that come from the cohort, in order.
FINAL_COHORT = [
    "subject_id", "hadm_id", "icustay_id", "age", "gender_num", "icustay_intime",
    "day_icu_intime_num", "hour_icu_intime", "icustay_outtime", "icu_los_day", "hospital_los_day",
    "hosp_exp_flg", "icu_exp_flg", "mort_day", "day_28_flg", "mort_day_censored", "censor_flg",
    "aline_flg", "aline_time_day",
]
FINAL_VITALS = {
    "map": "map_first", "heartrate": "hr_first", "temperature": "temp_first",
    "spo2": "spo2_first", "cvp": "cvp_first",
}
FINAL_LABS = [
    "bun_first", "creatinine_first", "chloride_first", "hgb_first", "platelet_first",
    "potassium_first", "sodium_first", "tco2_first", "wbc_first",
]
FINAL_ICD = {
    "chf": "chf_flg", "afib": "afib_flg", "renal": "renal_flg", "liver": "liver_flg",
    "copd": "copd_flg", "cad": "cad_flg", "stroke": "stroke_flg", "malignancy": "mal_flg",
    "respfail": "resp_flg", "endocarditis": "endocarditis_flg", "ards": "ards_flg",
    "pneumonia": "pneumonia_flg",
}
FINAL = [
    *FINAL_COHORT, "weight_first", "height_first", "bmi", "service_unit", "sofa_first",
    *FINAL_VITALS.values(), *FINAL_LABS, *FINAL_ICD.values(),
]
SEPSIS = ["subject_id", "hadm_id", "icustay_id", "infection", "explicit_sepsis", "organ_dysfunction", "mech_vent", "angus"]
WIDE_COHORT_1 = [
    "subject_id", "hadm_id", "icustay_id", "icustay_intime", "initial_aline_flg", "aline_flg",
    "aline_time_day", "icu_los_day", "hospital_los_day", "age", "gender_num",
]
WIDE_COHORT_2 = [
    "service_unit", "service_num", "icustay_outtime", "day_icu_intime", "day_icu_intime_num",
    "hour_icu_intime", "hosp_exp_flg", "icu_exp_flg", "mort_day", "day_28_flg",
    "mort_day_censored", "censor_flg", "vent_flg", "vent_1st_12hr", "vent_1st_24hr",
    "vent_b4_aline", "vent_day", "vent_free_day",
]
WIDE_VASO = [
    "vaso_flg", "vaso_day", "vaso_free_day", "vaso_1st_3hr_flg", "vaso_1st_6hr_flg",
    "vaso_1st_12hr_flg", "vaso_b4_aline",
]
WIDE_ANES = ["anes_flg", "anes_day", "anes_free_day", "anes_b4_aline"]
WIDE_VITALS = {"map": "map_1st", "heartrate": "hr_1st", "temperature": "temp_1st", "spo2": "spo2_1st"}
WIDE_CRIT = ["hct_med", "hct_lowest", "hct_highest", "hct_abnormal_flg"]
WIDE_LABS = ["wbc", "hgb", "platelet", "sodium", "potassium", "tco2", "chloride", "bun", "creatinine"]
DOSES = ("inputevents_cv", "inputevents_mv")
WIDE_STATUS = ["dnr_adm_flg", "dnr_switch_flg", "cmo_switch_flg", "dnr_cmo_switch_flg"]


# Key that ties each extracted table to the cohort.
EXTRACT_KEYS = {
    "chartevents": "subject_id", "labevents": "subject_id", "inputevents_cv": "icustay_id",
    "inputevents_mv": "icustay_id",
}


# Longest window before the index time that any view reads, where there is one.
EXTRACT_HOURS = {"labevents": max(views.LAB_HOURS.values())}


def in_span(events: DataFrame, cohort: DataFrame, before_hours: float) -> DataFrame:
    """Events between the cohort's first and last window, as constants the scan can use."""
    return span_filter(cohort)(events, before_hours)


def span_filter(cohort: DataFrame):
    """``in_span`` of a cohort whose span is looked up once."""
    span = cohort.agg(F.min(INDEX).alias("low"), F.max(INDEX).alias("high")).first()

    def within(events: DataFrame, before_hours: float) -> DataFrame:
        if span["low"] is None:
            return events
        low, high = (F.lit(str(time)).cast("timestamp_ntz") for time in (span["low"] - timedelta(hours=before_hours), span["high"]))
        return events.filter(F.col("charttime").between(low, high))

    return within


def flat(groups: dict[str, list[int]]) -> list[int]:
    return [i for group in groups.values() for i in group]


# Key of each optional external score.
EXTERNAL_KEYS = {"saps": "icustay_id", "sofa": "icustay_id", "angus_sepsis": "hadm_id"}


def as_is(*names: str) -> dict[str, str]:
    return {name: name for name in names}


@dataclass
class Study:
    """Source tables, concepts and limits of one run.

    ``tables`` are the 13 source tables and, optionally, the external scores
    ``saps``, ``sapsii``, ``sofa`` (per stay) and ``angus_sepsis`` (per admission).
    """

    tables: Tables
    concepts: Concepts = field(default_factory=Concepts)
    rules: CohortRules = field(default_factory=CohortRules)
    flag_concepts: Concepts | None = None
    sizes: Sizes = MEASURE

    def cohort(self) -> DataFrame:
        return build_cohort(self.tables, self.concepts.arterial_line, self.rules, self.sizes)

    def extract(self, cohort: DataFrame, sizes: Sizes, names: Iterable[str]) -> Tables:
        """The cohort's chart, lab and dose rows of the study's items, written once.

        The largest tables are read by many views; each is scanned once here
        and the views read the much smaller extract.
        """
        c, f = self.concepts, self.flag_concepts or self.concepts
        items = {
            "chartevents": {
                *c.vitals, *c.mean_pressure, *c.fio2, *c.gcs_motor, *c.gcs_verbal, *c.gcs_eyes,
                *c.weight_admit, *c.weight_daily, *c.height, *c.code_status_items},
            "labevents": {*c.labs, *c.lab_panel, *c.gas, *c.organ_labs},
            "inputevents_cv": {
                *c.vasopressor_points, *f.vasopressor_points, *c.anaesthetic_points,
                *flat(c.red_cell_points)},
            "inputevents_mv": {
                *c.vasopressor_intervals, *f.vasopressor_intervals, *c.anaesthetic_intervals,
                *flat(c.red_cell_intervals)},
        }

        def extract_one(name: str) -> DataFrame:
            key, before = EXTRACT_KEYS[name], EXTRACT_HOURS.get(name)
            rows = pick_items(self.tables[name], items[name]).select(*column_names(name))
            if before is None:
                found = join_cohort(rows, cohort.select(key), [key], sizes=sizes)
            else:
                rows = in_span(rows, cohort, before)
                narrow = cohort.select(key, INDEX)
                found = lookback(rows, narrow, [key], INDEX, "charttime", before, sizes).drop(INDEX)
            # few, even files, clustered by the key that all views group by
            return written(found.hint("rebalance", key), name)

        extracted = in_parallel([partial(extract_one, name) for name in names])
        return ChainMap(dict(zip(names, extracted)), self.tables)

    def prepare(self, *names: str, cohort: DataFrame | None = None) -> tuple[DataFrame, Tables, Sizes]:
        """Cohort, tables with the named ones extracted, and one bound for all views.

        The bound is the largest number of extracted rows of a subject or stay.
        """
        cohort = cohort or self.cohort()
        names = names or tuple(EXTRACT_KEYS)
        sizes = with_cohort(self.sizes, cohort)
        tables = self.extract(cohort, sizes, names)
        groups = [(tables[name], [EXTRACT_KEYS[name]]) for name in names]
        return cohort, tables, with_largest(sizes, *groups)

    def base_views(self, cohort: DataFrame, tables: Tables, echodata: DataFrame | None,
                   sizes: Sizes) -> dict[str, DataFrame]:
        c = self.concepts
        flags = self.flag_concepts or c
        found = {} if echodata is None else {"bmi": views.view_bmi(cohort, tables, c, echodata, sizes)}
        return found | {
            "icd": views.view_icd(cohort, tables, c, sizes=sizes),
            "labs": views.view_labs(cohort, tables, c, sizes),
            "sofa": views.view_sofa(cohort, tables, c, sizes),
            "vitals": views.view_vitals(cohort, tables, c, sizes),
            "vaso_flg": views.view_vaso_flg(cohort, tables, flags, sizes),
            "sepsis": views.view_sepsis(cohort, tables, c, sizes),
        }

    def extra_views(self, cohort: DataFrame, tables: Tables, sizes: Sizes) -> dict[str, DataFrame]:
        c = self.concepts
        return {
            "anaesthesia": views.view_anaesthesia(cohort, tables, c, sizes=sizes),
            "codestatus": views.view_codestatus(cohort, tables, c, sizes),
            "labs_all": views.view_lab_panel(cohort, tables, c, sizes),
            "rbc": views.view_rbc(cohort, tables, c, sizes=sizes),
            "vaso": views.view_vaso(cohort, tables, c, sizes=sizes),
        }

    def stats(self, cohort: DataFrame) -> DataFrame | None:
        """Every measurement of each stay in one pass; None when a stay has too many events for one task."""
        c, sizes = self.concepts, with_cohort(self.sizes, cohort)
        events = passes.stay_events(cohort, self.tables, c, self.flag_concepts or c, span_filter(cohort), sizes)
        return passes.stay_stats(events, c) if fits_task(events, ["icustay_id"], self.sizes) else None

    def measured(self, cohort: DataFrame, stats: DataFrame, echodata: DataFrame | None) -> DataFrame:
        return passes.measured(cohort, stats, echodata, self.concepts)

    def view(self, name: str) -> DataFrame:
        """One measurement view straight from the source tables."""
        cohort = self.cohort()
        stats, sizes = self.stats(cohort), with_cohort(self.sizes, cohort)
        echodata = views.view_echodata(cohort, self.tables, self.concepts, sizes) if name == "bmi" else None
        if stats is not None:
            return passes.views_of(self.measured(cohort, stats, echodata), self.concepts)[name]
        cohort, tables, sizes = self.prepare(cohort=cohort)
        return {**self.base_views(cohort, tables, echodata, sizes), **self.extra_views(cohort, tables, sizes)}[name]

    def all_tables(self) -> dict[str, DataFrame]:
        """The source tables and those external scores that are given."""
        found = {name: self.tables[name] for name in SCHEMAS}
        return found | {name: self.tables.get(name) for name in EXTERNAL}

    def measured_apart(self, cohort: DataFrame, echodata: DataFrame) -> DataFrame:
        """As ``measured``, made view by view, for stays too large for one task."""
        c = self.concepts
        cohort, tables, sizes = self.prepare(cohort=cohort)
        found = {**self.base_views(cohort, tables, echodata, sizes), **self.extra_views(cohort, tables, sizes)}
        return passes.side_by_side(cohort, {n: found[n] for n in passes.VIEW_KEYS}, c)

    def final(self) -> DataFrame:
        """The analysis table straight from the source tables."""
        cohort = self.cohort()
        stats, sizes = self.stats(cohort), with_cohort(self.sizes, cohort)
        if stats is None:
            cohort, tables, sizes = self.prepare(cohort=cohort)
            echodata = views.view_echodata(cohort, tables, self.concepts, sizes)
            return self.final_table(cohort, self.base_views(cohort, tables, echodata, sizes))
        echodata = views.view_echodata(cohort, self.tables, self.concepts, sizes)
        codes = passes.code_views(cohort, self.tables, self.concepts, sizes).drop("subject_id", "icustay_id")
        # the score's parts have names of code groups
        rows = self.measured(cohort, stats, echodata).drop(*COMPONENTS).join(codes, "hadm_id", "left")
        names = {
            "icustay_intime": "intime", "icustay_outtime": "outtime", "sofa_first": "sofa", "weight_first": "weight",
            "height_first": "height", **{new: f"vitals_{old}" for old, new in FINAL_VITALS.items()},
            **{n: passes.lab_names(self.concepts)[n] for n in FINAL_LABS}, **{new: old for old, new in FINAL_ICD.items()}}
        return self.chosen(rows, FINAL, names, ["angus", "vaso_flg"])

    @staticmethod
    def chosen(rows: DataFrame, keep: list[str], names: dict[str, str], exclude: list[str]) -> DataFrame:
        """Columns ``keep`` of the rows, some under other names, without the rows with an exclusion flag."""
        rows = assemble(rows, [], rows.columns, exclude, unique="icustay_id")
        return rows.select(*[F.col(names.get(n, n)).alias(n) for n in keep]).orderBy("icustay_id")

    def wide(self) -> DataFrame:
        """The wide covariate table straight from the source tables."""
        c, cohort = self.concepts, self.cohort()
        stats = self.stats(cohort)
        cohort, tables, sizes = self.prepare(*(EXTRACT_KEYS if stats is None else DOSES), cohort=cohort)
        needed = {
            "echodata": views.view_echodata(cohort, tables, c, sizes),
            "icd": views.view_icd(cohort, tables, c, sizes=sizes),
            "vaso": views.view_vaso(cohort, tables, c, sizes=sizes),
            "anaesthesia": views.view_anaesthesia(cohort, tables, c, sizes=sizes),
        }
        if stats is None:
            needed |= {
                "vitals": views.view_vitals(cohort, tables, c, sizes),
                "vaso_flg": views.view_vaso_flg(cohort, tables, self.flag_concepts or c, sizes),
                "codestatus": views.view_codestatus(cohort, tables, c, sizes),
                "labs_all": views.view_lab_panel(cohort, tables, c, sizes),
            }
            return self.wide_table(cohort, needed)
        rows, found = self.measured(cohort, stats, needed["echodata"]), passes.columns_of(c)
        rows = rows.select(*cohort.columns, *[F.col(f"vitals_{old}").alias(new) for old, new in WIDE_VITALS.items()],
                           *found["labs_all"], *[F.col(n) for n in WIDE_STATUS], F.col("vaso_flg").alias("_exposed"))
        return self.wide_table(rows, needed)

    def final_table(self, cohort: DataFrame, v: dict[str, DataFrame]) -> DataFrame:
        """The analysis table: one row per included stay, late exclusions applied."""
        stays = cohort.withColumnsRenamed({"intime": "icustay_intime", "outtime": "icustay_outtime"})
        attached = [
            View("sepsis", v["sepsis"], "icustay_id", {"angus": "_septic"}),
            View("sofa", v["sofa"], "icustay_id", {"sofa": "sofa_first"}),
            View("bmi", v["bmi"], "icustay_id",
                 {"weight": "weight_first", "height": "height_first", "bmi": "bmi"}),
            View("vaso_flg", v["vaso_flg"], "icustay_id", {"vaso_flg": "_exposed"}),
            View("icd", v["icd"], "hadm_id", FINAL_ICD),
            View("vitals", v["vitals"], "hadm_id", FINAL_VITALS),
            View("labs", v["labs"], "hadm_id", as_is(*FINAL_LABS)),
        ]
        return assemble(stays, attached, FINAL, ["_septic", "_exposed"], unique="icustay_id").orderBy("icustay_id")

    def wide_table(self, cohort: DataFrame, v: dict[str, DataFrame]) -> DataFrame:
        """The wide covariate table; missing external scores become typed NULLs.

        ``cohort`` may have the columns of measurement views already; those are not in ``v`` then.
        """
        t = self.tables
        for name, key in EXTERNAL_KEYS.items():
            if t.get(name) is not None:
                assert_unique(t[name], key, name)
        lab_columns = [f"{lab}_{kind}" for lab in WIDE_LABS for kind in ("first", "abnormal_flg")]
        icd = dict(list(FINAL_ICD.items())[:9])
        stays = cohort.withColumnsRenamed({"intime": "icustay_intime", "outtime": "icustay_outtime"})
        attached = [
            View("saps", t.get("saps"), "icustay_id", {"saps": "sapsi_first"}, {"saps": "int"}),
            View("sofa", t.get("sofa"), "icustay_id", {"sofa": "sofa_first"}, {"sofa": "int"}),
            View("angus_sepsis", t.get("angus_sepsis"), "hadm_id", {"angus": "sepsis_flg"},
                 {"angus": "int"}),
            View("echodata", v["echodata"], "icustay_id", as_is("weight_first", "height_first", "bmi")),
            View("vaso", v["vaso"], "icustay_id", as_is(*WIDE_VASO)),
            View("anaesthesia", v["anaesthesia"], "icustay_id", as_is(*WIDE_ANES)),
            View("icd", v["icd"], "hadm_id", icd),
        ]
        measures = {
            "vaso_flg": ("icustay_id", {"vaso_flg": "_exposed"}), "vitals": ("hadm_id", WIDE_VITALS),
            "labs_all": ("hadm_id", as_is(*WIDE_CRIT, *lab_columns)), "codestatus": ("icustay_id", as_is(*WIDE_STATUS)),
        }
        attached += [View(name, v[name], *how) for name, how in measures.items() if name in v]
        keep = [
            *WIDE_COHORT_1, "weight_first", "height_first", "bmi", "sapsi_first", "sofa_first",
            *WIDE_COHORT_2, *WIDE_VASO, *WIDE_ANES, "sepsis_flg", *icd.values(),
            *WIDE_VITALS.values(), *WIDE_CRIT, *lab_columns, *WIDE_STATUS,
        ]
        return assemble(stays, attached, keep, ["sepsis_flg", "_exposed"], unique="icustay_id").orderBy("icustay_id")


VIEW_KEYS = {
    "cohort": "icustay_id", "echodata": "icustay_id", "icd": "hadm_id", "labs": "hadm_id",
    "sofa": "icustay_id", "vitals": "hadm_id", "vaso_flg": "icustay_id", "bmi": "icustay_id",
    "sepsis": "icustay_id", "anaesthesia": "icustay_id", "codestatus": "icustay_id",
    "labs_all": "hadm_id", "rbc": "icustay_id", "vaso": "icustay_id", "data": "icustay_id",
    "data_full": "icustay_id",
}


def drop_build(spark: SparkSession, folder: str) -> None:
    """Delete the folder of an earlier run, wherever it is stored."""
    files.delete(spark, folder)


def build_steps(study: Study) -> list[Step]:
    """Tables of a build in terms of those before them; names in ``VIEW_KEYS`` are the views, others are for them."""
    c = study.concepts

    def measurement(name: str):
        return lambda t: passes.views_of(t["measured"], c)[name]

    def drug(view):
        def make(t: dict[str, DataFrame]) -> DataFrame:
            names, sizes = [f"{n}_rows" for n in DOSES], with_cohort(study.sizes, t["cohort"])
            rows = ChainMap({n: t[r] for n, r in zip(DOSES, names)}, study.tables)
            sizes = with_largest(sizes, *[(t[r], ["icustay_id"]) for r in names])
            return view(t["cohort"], rows, c, sizes=sizes)
        return make

    def dose_rows(name: str):
        return lambda t: study.extract(t["cohort"], with_cohort(study.sizes, t["cohort"]), [name])[name]

    def measured(t: dict[str, DataFrame]) -> DataFrame:
        stats = study.stats(t["cohort"])
        if stats is None:
            return study.measured_apart(t["cohort"], t["echodata"])
        return study.measured(t["cohort"], stats, t["echodata"])

    rows = tuple(f"{n}_rows" for n in DOSES)
    finals = {"data": study.final_table, "data_full": study.wide_table}
    views_needed = [n for n in VIEW_KEYS if n not in finals]
    return [
        Step("cohort", (), lambda t: study.cohort()),
        Step("echodata", ("cohort",), lambda t: views.view_echodata(t["cohort"], study.tables, c, with_cohort(study.sizes, t["cohort"]))),
        Step("codes", ("cohort",), lambda t: passes.code_views(t["cohort"], study.tables, c, with_cohort(study.sizes, t["cohort"]))),
        *[Step(f"{n}_rows", ("cohort",), dose_rows(n)) for n in DOSES],
        Step("measured", ("cohort", "echodata"), measured),
        *[Step(n, ("measured",), measurement(n)) for n in passes.VIEW_KEYS],
        Step("icd", ("codes",), lambda t: t["codes"].select("hadm_id", *c.comorbidities)),
        Step("sepsis", ("codes",), lambda t: t["codes"].select(*SEPSIS)),
        *[Step(n, ("cohort", *rows), drug(view)) for n, view in
          {"vaso": views.view_vaso, "anaesthesia": views.view_anaesthesia, "rbc": views.view_rbc}.items()],
        *[Step(n, tuple(views_needed), lambda t, make=make: make(t["cohort"], t)) for n, make in finals.items()],
    ]


def build_all(spark: SparkSession, study: Study, folder: str | None = None,
              register: bool = False, replaces: str | None = None, root: str | None = None) -> dict[str, DataFrame]:
    """Write every view and both final tables in dependency order.

    All files of a run go to one folder, a new one by default. With the folder of a run that failed it goes on
    with what is complete there (see ``manifest``). ``root`` publishes the run under its name in that folder
    once all views are complete. ``register`` replaces the temp
    views ``study_<name>`` then, and ``replaces`` is the folder of an earlier run to delete.
    """
    if root is not None and folder is None:
        folder = f"{root}/run-{uuid.uuid4().hex}"
    folder = (folder or fresh_folder(spark, "study")).rstrip("/")
    settings = repr([study.concepts, study.flag_concepts, study.rules, study.sizes])
    run = Run(spark, folder, source_fingerprint(spark, dict(study.all_tables()), settings))
    stored = run.all(build_steps(study))
    if root is not None:
        publish(spark, root, folder.removeprefix(f"{root.rstrip('/')}/"), list(VIEW_KEYS))
    if register:
        for name in VIEW_KEYS:
            stored[name].createOrReplaceTempView(f"study_{name}")
    if replaces:
        drop_build(spark, replaces)
    return {name: stored[name] for name in VIEW_KEYS}


def build_numbers(stored: dict[str, DataFrame]) -> DataFrame:
    """(view, id, field, value) for every known number of the stored views, rounded to 6 digits."""
    parts = []
    for name, df in stored.items():
        key = VIEW_KEYS[name]
        cells = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").try_cast("double").alias("value"))
                 for c in df.columns if c != key]
        rows = df.select(F.lit(name).alias("view"), F.col(key).alias("id"), F.inline(F.array(*cells)))
        parts.append(rows.filter("value IS NOT NULL").withColumn("value", F.round("value", 6)))
    return stream(parts)


def build_report(stored: dict[str, DataFrame]) -> DataFrame:
    """Rows and distinct keys of each stored view; equal numbers mean the key is unique."""
    parts = [
        df.agg(F.count("*").alias("n_rows"), F.countDistinct(VIEW_KEYS[name]).alias("n_keys"))
        .select(F.lit(name).alias("view"), "n_rows", "n_keys")
        for name, df in stored.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
