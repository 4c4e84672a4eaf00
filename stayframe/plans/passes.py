"""The study's measurements in one pass over the cohort's events.

``stay_events`` writes one stream of the chart, lab, output and dose rows that any view
needs; each source is scanned once. ``stay_stats`` reduces it to one row per stay with one shuffle. The
``views_of`` are then only columns of that row: no view reads events again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayframe.functions.numeric import first_match, flag, oxygen_ratio
from stayframe.functions.timeutil import hours
from stayframe.operators.codes import flags_per_key
from stayframe.operators.fused import (
    PLACE, STAY, Family, Stat, at_same_time, by_stay, event, of_stay, previous_time, reduced, stream)
from stayframe.operators.lookback import Item, labels_of, pick_items
from stayframe.operators.measures import body_columns, echo_parts
from stayframe.operators.scale import Sizes, join_cohort, with_cohort, written
from stayframe.operators.scores import COMPONENTS, coma_total, organ_points
from stayframe.operators.status import named_history, status_label, switch_flags
from stayframe.plans.concepts import Concepts
from stayframe.plans.views import ADMISSION, INDEX, LAB_HOURS, STAY as KEYS, Tables, hematocrit_flag, output_name

#: columns of the stay that events carry
CARRY = [STAY, INDEX, "outtime"]
#: hours before a blood gas in which a charted FiO2 still counts
FIO2_HOURS = 4
COMA_HOURS = 6


def one_label(ids) -> dict[int, Item]:
    return {i: Item("X") for i in ids}


def families(c: Concepts) -> dict[str, Family]:
    day, used = 24, (F.col("num") != 0)
    found = [
        Family("labs", "lab", c.labs, INDEX, LAB_HOURS["labs"]),
        Family("panel", "lab", c.lab_panel, INDEX, LAB_HOURS["lab_panel"]),
        Family("organ", "lab", c.organ_labs, INDEX, LAB_HOURS["sofa"], where=F.col("num") > 0),
        Family("gas", "lab", c.gas, INDEX, LAB_HOURS["sofa"]),
        Family("vitals", "chart", c.vitals, INDEX, day),
        Family("pressure", "chart", one_label(c.mean_pressure), INDEX, day),
        Family("coma", "chart", one_label([*c.gcs_motor, *c.gcs_verbal, *c.gcs_eyes]), INDEX, day),
        Family("admit", "chart", c.weight_admit, INDEX, day, where=used),
        Family("daily", "chart", c.weight_daily, INDEX, day, where=used),
        Family("height", "chart", c.height, "outtime", None, where=used),
        Family("status", "chart", one_label(c.code_status_items), None, own=True, where=F.col("text") != "Other/Remarks"),
        Family("urine", "output", one_label(c.urine), INDEX, day),
    ]
    return {family.name: family for family in found}


def statistics(f: dict[str, Family]) -> list[Stat]:
    def each(family: str, how: str, suffix: str = "") -> list[Stat]:
        return [Stat(f"{family}_{label.lower()}{suffix}", f[family], label, how) for label in labels_of(dict(f[family].items))]

    def only(name: str, family: str, how: str, label: str | None = None) -> list[Stat]:
        labels = labels_of(dict(f[family].items)) if label is None else [label]
        return [Stat(name, f[family], one, how) for one in labels[:1]]

    return [
        *each("labs", "last"), *each("vitals", "last"), *each("panel", "last"), *each("panel", "marked", "_flg"),
        *only("hct_lowest", "panel", "min", "HEMATOCRIT"), *only("hct_highest", "panel", "max", "HEMATOCRIT"),
        *only("hct_med", "panel", "median", "HEMATOCRIT"),
        *only("bilirubin_max", "organ", "max", "BILIRUBIN"), *only("creatinine_max", "organ", "max", "CREATININE"),
        *only("platelet_min", "organ", "min", "PLATELET"), *only("meanbp_min", "pressure", "min"),
        *only("urineoutput", "urine", "sum"), *only("weight_admit", "admit", "median"),
        *only("weight_daily", "daily", "median"), *only("height_chart", "height", "median"),
    ]


def with_gas(rows: DataFrame, gas: Family, fio2: dict[int, Item]) -> DataFrame:
    """Adds the stay's latest arterial gas, and marks the charted FiO2 rows of the hours before it."""
    def part(name: str, column: str) -> Column:
        return at_same_time(F.col(gas.label) == name, F.col(column))

    rows = rows.withColumns(gas.columns())
    rows = rows.withColumns({"_specimen": part("SPECIMEN", "text"), "_fio2": part("FIO2", gas.value), "_po2": part("PO2", gas.value)})
    arterial = F.col(gas.label).isNotNull() & F.col("_po2").isNotNull() & (F.coalesce("_specimen", F.lit("ART")) == "ART")
    rows = rows.withColumn("_gas", of_stay(F.when(arterial, F.struct("charttime", F.col("_po2").alias("po2"), F.col("_fio2").alias("fio2")))))
    recent = F.col("charttime").between(F.col("_gas.charttime") - hours(FIO2_HOURS), F.col("_gas.charttime"))
    charted = Family("charted", "chart", fio2, None, own=True, where=recent)
    rows = rows.withColumns(charted.columns())
    return rows.withColumn("_charted_time", of_stay(F.when(charted.holds(), F.col("charttime"))))


def gas_columns() -> list[Column]:
    charted = F.max(F.when(F.col("_charted_label").isNotNull() & (F.col("charttime") == F.col("_charted_time")), F.col("_charted_value")))
    po2, fio2 = F.max("_gas.po2"), F.max("_gas.fio2")
    return [oxygen_ratio(po2, F.coalesce(fio2, charted)).alias("pao2fio2")]


def with_coma(rows: DataFrame, coma: Family, c: Concepts) -> DataFrame:
    """Adds the coma total of each charted time, with parts carried over from the time before."""
    mine = F.col(coma.label).isNotNull()
    groups = {"gcsmotor": c.gcs_motor, "gcsverbal": c.gcs_verbal, "gcseyes": c.gcs_eyes}
    rows = rows.withColumn(coma.label, F.when(coma.holds(), F.lit("X")))
    rows = rows.withColumns({n: at_same_time(mine & F.col("itemid").isin(list(ids)), F.col("num")) for n, ids in groups.items()})
    rows = rows.withColumn("_earlier", previous_time(F.when(mine, F.struct("charttime", *groups))))
    recent = F.col("_earlier.charttime") > F.col("charttime") - hours(COMA_HOURS)
    rows = rows.withColumns({f"prev_{n}": F.when(recent, F.col(f"_earlier.{n}")) for n in groups})
    return rows.withColumn("_coma", F.when(mine, coma_total()))


def status_columns(status: Family, mapping: dict[str, str]) -> list[Column]:
    """Codes of the first and the last status, and whether each occurred; NULL without a row."""
    names, label = list(dict.fromkeys(mapping.values())), status_label(F.col("text"), mapping)
    code = first_match(*[(label == name, i) for i, name in enumerate(names)])
    place = F.when(status.holds(), F.col(PLACE))
    ever = [F.max(F.when(status.holds(), flag(label == name))).alias(name.lower()) for name in names]
    return [F.min_by(code, place).alias("_first"), F.max_by(code, place).alias("_last"), *ever]


def stay_events(cohort: DataFrame, tables: Tables, c: Concepts, flags: Concepts, in_span, sizes: Sizes) -> DataFrame:
    """The cohort's rows of all event tables as one written stream, clustered by stay.

    ``in_span`` limits rows to the cohort's overall time span, so that the limits reach the scan.
    """
    sizes = with_cohort(sizes, cohort)
    subjects = cohort.select("subject_id", *CARRY)
    stays = cohort.select(*CARRY)
    known = families(c)

    def ids(source: str) -> set[int]:
        return {i for family in known.values() if family.source == source for i in family.items}

    def of_subject(rows: DataFrame, own: Column) -> DataFrame:
        found = rows.withColumnRenamed(STAY, "_stay") if STAY in rows.columns else rows
        return join_cohort(found, subjects, ["subject_id"], sizes=sizes).withColumn("own", own)

    chart = pick_items(tables["chartevents"], ids("chart") | set(c.fio2)).select(
        "subject_id", STAY, "charttime", "event_id", "itemid", "valuenum", "value")
    lab = in_span(pick_items(tables["labevents"], ids("lab")), max(LAB_HOURS.values())).select(
        "subject_id", "charttime", "event_id", "itemid", "valuenum", "value", "flag")
    output = in_span(pick_items(tables["outputevents"], ids("output")), 24).select("subject_id", "charttime", "itemid", "value")
    points = pick_items(tables["inputevents_cv"], flags.vasopressor_points).filter(F.col("rate") > 0)
    orders = pick_items(tables["inputevents_mv"], flags.vasopressor_intervals).filter(
        (F.col("rate") > 0) & (F.col("statusdescription") != "Rewritten"))
    mine = F.coalesce(F.col("_stay") == F.col(STAY), F.lit(False))
    parts = [
        event(of_subject(chart, mine), "chart", CARRY, own="own", charttime="charttime", event_id="event_id", itemid="itemid",
              num="valuenum", text="value"),
        event(of_subject(lab, F.lit(True)), "lab", CARRY, own="own", charttime="charttime", event_id="event_id", itemid="itemid",
              num="valuenum", text="value", mark="flag"),
        event(of_subject(output, F.lit(True)), "output", CARRY, own="own", charttime="charttime", itemid="itemid", num="value"),
        *[event(join_cohort(rows.select(STAY, "itemid"), stays, [STAY], sizes=sizes), "exposure", CARRY, itemid="itemid")
          for rows in (points, orders)],
    ]
    # few, even files, clustered by the key that the pass groups by
    return written(stream(parts).hint("rebalance", STAY), "events")


def stay_stats(events: DataFrame, c: Concepts) -> DataFrame:
    """One row per stay that has events, with every measurement of the study."""
    f = families(c)
    rows = with_coma(with_gas(by_stay(events), f["gas"], c.fio2), f["coma"], c)
    exposed = F.max(flag(F.col("source") == "exposure")).alias("vaso_flg")
    panel = F.max(flag(F.col(f["panel"].label).isNotNull())).alias("panel_seen")
    also = [*gas_columns(), panel, F.min("_coma").cast("double").alias("mingcs"), exposed, *status_columns(f["status"], c.code_status)]
    return reduced(rows, statistics(f), also)


def measured(cohort: DataFrame, stats: DataFrame, echodata: DataFrame | None, c: Concepts) -> DataFrame:
    """Cohort stays with all measurements, scores, body measures (given reports) and status flags."""
    rows = cohort.join(stats, STAY, "left")
    if echodata is not None:
        rows = body_columns(rows.join(echo_parts(echodata), STAY, "left"))
    rows = named_history(organ_points(rows, rows.columns), c.code_status)
    rows = rows.withColumn("vaso_flg", F.coalesce("vaso_flg", F.lit(0)))
    crit = hematocrit_flag(F.col("gender_num"), F.col("hct_med"))
    return switch_flags(rows).withColumn("hct_abnormal_flg", crit)


def lab_names(c: Concepts) -> dict[str, str]:
    return {f"{output_name(n)}_first": f"labs_{n.lower()}" for n in labels_of(c.labs)}


def vital_names(c: Concepts) -> dict[str, str]:
    return {n.lower(): f"vitals_{n.lower()}" for n in labels_of(c.vitals)}


def panel_names(c: Concepts) -> dict[str, str]:
    labels = labels_of(c.lab_panel)
    return {f"{output_name(n)}_first": f"panel_{n.lower()}" for n in labels} | {
        f"{output_name(n)}_abnormal_flg": f"panel_{n.lower()}_flg" for n in labels}


CRIT = ["hct_med", "hct_lowest", "hct_highest", "hct_abnormal_flg"]
STATUS = ["firstcodestatus", "lastcodestatus", "dnr", "cmo", "dncpr", "dni", "fullcode",
          "dnr_adm_flg", "dnr_switch_flg", "cmo_switch_flg", "dnr_cmo_switch_flg"]
BODY = ["bmi", "height", "weight", "height_chart", "weight_admit", "weight_daily", "height_echo", "weight_echo"]


def columns_of(c: Concepts) -> dict[str, list[Column]]:
    """Columns of each measurement view in terms of ``measured`` rows."""
    def named(names: dict[str, str]) -> list[Column]:
        return [F.col(old).alias(new) for new, old in names.items()]

    panel = panel_names(c)
    marks = [F.when(F.col("panel_seen") == 1, F.coalesce(old, F.lit(0))).alias(new) for new, old in panel.items() if new.endswith("_flg")]
    return {
        "labs": named(lab_names(c)),
        "vitals": named(vital_names(c)),
        "labs_all": [*map(F.col, CRIT), *named({n: o for n, o in panel.items() if not n.endswith("_flg")}), *marks],
        "sofa": [F.col(n) for n in ("sofa", *COMPONENTS)],
        "bmi": [F.col(n) for n in BODY],
        "vaso_flg": [F.col("vaso_flg")],
        "codestatus": [F.col(n) for n in STATUS],
    }


VIEW_KEYS = {"labs": ADMISSION, "vitals": ADMISSION, "labs_all": ADMISSION, "sofa": KEYS, "bmi": [STAY], "vaso_flg": KEYS, "codestatus": KEYS}


def views_of(rows: DataFrame, c: Concepts) -> dict[str, DataFrame]:
    """The study's measurement views from ``measured`` rows."""
    given = {name: columns for name, columns in columns_of(c).items() if name != "bmi" or "height_echo" in rows.columns}
    return {name: rows.select(*VIEW_KEYS[name], *columns) for name, columns in given.items()}


def side_by_side(cohort: DataFrame, views: dict[str, DataFrame], c: Concepts) -> DataFrame:
    """``measured`` rows from views that were made one by one."""
    rows = cohort
    for name, columns in columns_of(c).items():
        view, key = views[name], VIEW_KEYS[name][-1]
        internal = [F.col(new).alias(old) for new, old in _renamed(name, c).items()]
        rows = rows.join(view.select(key, *internal), key, "left")
    mark = next(old for new, old in panel_names(c).items() if new.endswith("_flg"))
    return rows.withColumn("panel_seen", F.when(F.col(mark).isNotNull(), 1))


def _renamed(view: str, c: Concepts) -> dict[str, str]:
    """Name in ``measured`` rows of each column of a view."""
    given = {"labs": lab_names(c), "vitals": vital_names(c), "labs_all": {n: n for n in CRIT} | panel_names(c)}
    same = {"sofa": ["sofa", *COMPONENTS], "bmi": BODY, "vaso_flg": ["vaso_flg"], "codestatus": STATUS}
    return given.get(view) or {n: n for n in same[view]}


def code_views(cohort: DataFrame, tables: Tables, c: Concepts, sizes: Sizes) -> DataFrame:
    """Comorbidity flags and the sepsis verdict of each admission; diagnoses are read once.

    The cohort's stays all have an admission.
    """
    by, rule = "hadm_id", c.sepsis
    diagnosed = {"_infection": rule.infection, "_explicit": rule.explicit_sepsis, "_organ": rule.organ_dysfunction}
    found = flags_per_key(tables["diagnoses_icd"], cohort, by, {**c.comorbidities, **diagnosed}, sizes=sizes)
    treated = flags_per_key(tables["procedures_icd"], cohort, by, {"_vent": rule.mech_vent}, sizes=sizes)
    rows = cohort.select("subject_id", by, STAY).join(found, by, "left").join(treated, by, "left")
    rows = rows.withColumns({n: F.coalesce(n, F.lit(0)) for n in (*c.comorbidities, *diagnosed, "_vent")})
    septic = (F.col("_explicit") == 1) | ((F.col("_infection") == 1) & ((F.col("_organ") == 1) | (F.col("_vent") == 1)))
    return rows.select("subject_id", by, STAY, *c.comorbidities, F.col("_infection").alias("infection"),
                       F.col("_explicit").alias("explicit_sepsis"), F.col("_organ").alias("organ_dysfunction"),
                       F.col("_vent").alias("mech_vent"), flag(septic).alias("angus"))
