"""Hand-made cases for the rules of each operator."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayframe.functions import numeric as N, text as X, timeutil as T
from stayframe.operators import asof, codes, episodes as E, intervals as I, lookback as L, ordered
from stayframe.operators import scores as S
from stayframe.operators.assemble import View, assemble
from stayframe.operators.cohort import first_stays, select_cohort, inclusion_steps
from stayframe.operators.status import status_history, switch_flags
from stayframe.plans.concepts import CHARTED_FIO2, CODE_STATUS, COMORBIDITIES, GAS, SEPSIS
from stayframe.plans.views import hematocrit_flag


def at(hour, minute=0, day=1):
    return f"2150-01-{day:02d} {hour:02d}:{minute:02d}:00"


def clock(value):
    return value.strftime("%H:%M") if value else None


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def spans(df):
    return sorted((r["starttime"].hour, r["endtime"].hour) for r in df.collect())


# -- scalars ----------------------------------------------------------------

def test_time_functions_ignore_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        a = F.lit("2021-03-14 00:00:00").cast("timestamp_ntz")
        b = F.lit("2021-03-15 00:00:00").cast("timestamp_ntz")
        row = one(spark, T.days_between(a, b).alias("d"), T.day_of_week(a).alias("w"),
                  T.day_name(a).alias("n"), T.day_floor(b).alias("f"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row["d"], row["w"], row["n"]) == (1.0, 0, "sunday")
    assert row["f"] == dt.datetime(2021, 3, 15)


@pytest.mark.parametrize("text,wanted", [
    ("9:30", "09:30"), ("14:30", "14:30"), ("14:30:59", "14:30"), ("25:00", None),
    ("10:75", None), ("", None), (None, None)])
def test_clock(spark, text, wanted):
    day = F.lit("2150-01-01 17:00:00").cast("timestamp_ntz")
    assert clock(one(spark, T.with_clock(day, F.lit(text)).alias("t"))["t"]) == wanted


def test_first_group(spark):
    def found(text, pattern):
        return one(spark, X.first_group(F.lit(text), pattern).alias("v"))["v"]

    assert found("abc", r"x: (.*?)\n") is None
    assert found("x: \ny", r"x: (.*?)\n") == ""
    assert found("x: 1\nx: 2\n", r"x: (.*?)\n") == "1"
    assert found("BSA (m2): 1\n2 m2\n", r"BSA \(m2\): (.*?) m2\n") == "1\n2"
    assert found(None, r"x: (.*?)\n") is None


@pytest.mark.parametrize("text,wanted", [
    ("65", 65.0), (" 65.5 ", 65.5), ("[** 3 **]", None), ("5d", None), ("", None), (None, None)])
def test_guarded_number(spark, text, wanted):
    assert one(spark, X.guarded_number(F.lit(text)).alias("v"))["v"] == wanted


def test_round_half_up(spark):
    values = [one(spark, N.round_half_up(F.lit(v), 2).alias("v"))["v"] for v in (2.345, 3.275, -2.345)]
    assert values == [2.35, 3.28, -2.35]


@pytest.mark.parametrize("fio2,wanted", [(100.0, None), (None, None), (0.0, None), (50.0, 180.0)])
def test_oxygen_ratio(spark, fio2, wanted):
    ratio = N.oxygen_ratio(F.lit(90.0), F.lit(fio2).cast("double"))
    assert one(spark, ratio.alias("v"))["v"] == wanted


def test_sum_of_known(spark):
    n = F.lit(None).cast("double")
    row = one(spark, N.sum_of_known(F.lit(1.0), F.lit(2.0)).alias("a"),
              N.sum_of_known(F.lit(1.0), n).alias("b"), N.sum_of_known(n, n).alias("c"))
    assert tuple(row) == (3.0, 1.0, None)


@pytest.mark.parametrize("gender,median,wanted", [
    (1, 45.0, 0), (1, 40.0, 1), (0, 40.0, 0), (0, 45.0, 1), (1, None, 1)])
def test_hematocrit_flag(spark, gender, median, wanted):
    flag = hematocrit_flag(F.lit(gender), F.lit(median).cast("double"))
    assert one(spark, flag.alias("v"))["v"] == wanted


@pytest.mark.parametrize("item,value,wanted", [
    (223835, 0.4, 40.0), (223835, 10.0, None), (223835, 21.0, 21.0), (223835, 100.0, 100.0),
    (223835, 101.0, None), (223835, 0.0, None), (3420, 500.0, 500.0), (190, 0.2, None),
    (190, 0.5, 50.0), (190, 1.0, None), (1, 50.0, None)])
def test_charted_oxygen(spark, item, value, wanted):
    clean = L.clean_value(F.lit(item), F.lit(value), CHARTED_FIO2)
    assert one(spark, clean.alias("v"))["v"] == wanted


@pytest.mark.parametrize("creatinine,urine,wanted", [
    (5.0, 1000.0, 4), (1.0, 100.0, 4), (4.0, 1000.0, 3), (2.5, 400.0, 3), (2.5, 1000.0, 2),
    (1.5, None, 1), (1.0, None, 0), (None, 600.0, 0), (None, None, None)])
def test_renal_points(spark, creatinine, urine, wanted):
    points = S.renal_points(F.lit(creatinine).cast("double"), F.lit(urine).cast("double"))
    assert one(spark, points.alias("v"))["v"] == wanted


@pytest.mark.parametrize("score,wanted", [
    (15, 0), (14, 1), (12, 2), (9, 3), (6, 3), (5, 4), (None, None)])
def test_coma_points(spark, score, wanted):
    assert one(spark, S.coma_points(F.lit(score).cast("double")).alias("v"))["v"] == wanted


# -- intervals and episodes -------------------------------------------------

INTERVAL = "icustay_id long, starttime time, endtime time"


@pytest.mark.parametrize("rows,wanted", [
    ([(1, 3), (3, 5), (7, 8), (2, 4)], [(1, 5), (7, 8)]),
    ([(9, 2)], []),
    ([(9, 2), (20, 22)], [(20, 22)]),
    ([(1, 10), (2, 3), (4, 5), (11, 12)], [(1, 10), (11, 12)]),
    ([(1, 1), (1, 2), (1, 2)], [(1, 2)]),
])
def test_merge_intervals(table, rows, wanted):
    df = table(INTERVAL, [(1, at(a), at(b)) for a, b in rows])
    assert spans(I.merge_intervals(df, ["icustay_id"])) == wanted


DOSE = "icustay_id long, itemid int, charttime time, stopped string, rate double, amount double"


def doses(table, rates, stops=()):
    return table(DOSE, [
        (1, 1, at(i), "Stopped" if i in stops else None, rate, 1.0)
        for i, rate in enumerate(rates, start=1)])


@pytest.mark.parametrize("rates,stops,wanted", [
    ([5.0, 0.0, 0.0, 4.0, 3.0], (), [(1, 2), (4, 5)]),
    ([5.0, 0.0, 0.0, 4.0], (), [(1, 2)]),
    ([5.0, 6.0, 7.0], (1,), [(2, 3)]),
    ([None, 0.0, 0.0], (), []),
    ([5.0, None, None, 6.0], (), [(1, 4)]),
    ([5.0, None, 6.0, None, 7.0], (3,), [(1, 3), (5, 5)]),
    ([None, 5.0, 5.0], (), [(2, 3)]),
    ([0.0, None, 3.0, 2.0], (), [(3, 4)]),
])
def test_rate_episodes(table, rates, stops, wanted):
    assert spans(E.rate_episodes(doses(table, rates, stops), "icustay_id")) == wanted


def test_rate_episodes_same_time_records_collapse(table):
    df = table(DOSE, [
        (1, 1, at(1), None, None, 1.0), (1, 1, at(1), None, 5.0, 2.0), (1, 1, at(2), "D/C'd", 5.0, 1.0),
        (None, 1, at(3), None, 9.0, 1.0)])
    assert spans(E.rate_episodes(df, "icustay_id")) == [(1, 2)]


def test_union_keeps_equal_episodes_with_other_numbers(table):
    a = table(INTERVAL, [(1, at(1), at(2)), (1, at(3), at(4))])
    b = table(INTERVAL, [(1, at(3), at(4)), (2, at(1), at(2))])
    rows = I.union_episodes([a, b], ["icustay_id"], "number").collect()
    assert len(rows) == 4
    same = I.union_episodes([a, a], ["icustay_id"], "number").collect()
    assert len(same) == 2


@pytest.mark.parametrize("start,end,clip,wanted", [
    (1, 2, False, 10.0), (4, 8, False, 5.0), (8, 10, False, -10.0), (8, 10, True, 0.0)])
def test_share_before(spark, start, end, clip, wanted):
    def ts(hour):
        return F.lit(at(hour)).cast("timestamp_ntz")

    share = I.share_before(ts(start), ts(end), F.lit(10.0), ts(6), clip)
    assert one(spark, share.alias("v"))["v"] == wanted


def test_early_days_default_means_at_intake(table):
    cohort = table(
        "subject_id long, hadm_id long, icustay_id long, intime time, outtime time, aline_flg int, "
        "initial_aline_flg int, aline_time_day double",
        [(1, 1, 1, at(0), at(0, day=3), 0, 0, None), (2, 2, 2, at(0), at(0, day=3), 1, 0, 0.5)])
    found = table(INTERVAL, [(1, at(1), at(2)), (2, at(6), at(9))])
    rows = {r["icustay_id"]: r for r in E.episode_features(cohort, found, "icustay_id", "vaso").collect()}
    assert (rows[1]["vaso_b4_aline"], rows[2]["vaso_b4_aline"]) == (0, 1)
    late = E.episode_features(cohort, found, "icustay_id", "vaso", early_days=2 / 24).collect()
    assert {r["icustay_id"]: r["vaso_b4_aline"] for r in late}[1] == 1


# -- lookback, as-of, medians -----------------------------------------------

EVENT = "event_id long, subject_id long, charttime time, itemid int, valuenum double"
COHORT = "subject_id long, hadm_id long, icustay_id long, vent_starttime time"


def test_lookback_bounds_are_closed(table):
    events = table(EVENT, [
        (1, 1, at(12, day=1), 1, 1.0), (2, 1, at(11, 59, day=1), 1, 2.0), (3, 1, at(12, day=2), 1, 3.0),
        (4, 1, at(12, 1, day=2), 1, 4.0)])
    cohort = table(COHORT, [(1, 1, 1, at(12, day=2)), (2, 2, 2, at(12, day=2))])
    inner = L.lookback(events, cohort, ["subject_id"], "vent_starttime", "charttime", 24)
    assert sorted(r["event_id"] for r in inner.collect()) == [1, 3]
    left = L.lookback_left(events, cohort, ["subject_id"], "vent_starttime", "charttime", 24, "icustay_id")
    assert sorted((r["subject_id"], r["event_id"]) for r in left.collect() if r["event_id"]) == [(1, 1), (1, 3)]
    assert [r["subject_id"] for r in left.collect() if r["event_id"] is None] == [2]


def test_latest_value_may_be_null(table):
    events = table("subject_id long, event_id long, charttime time, label string, valuenum double", [
        (1, 1, at(1), "BUN", 5.0), (1, 2, at(2), "BUN", None), (1, 3, at(1), "WBC", 1.0),
        (1, 4, at(1), "WBC", 2.0)])
    row = L.reduce_labels(events, ["subject_id"], ["BUN", "WBC", "SODIUM"], "last").first()
    assert (row["bun"], row["wbc"], row["sodium"]) == (None, 2.0, None)
    low = L.reduce_labels(events, ["subject_id"], ["BUN", "WBC"], "min").first()
    assert (low["bun"], low["wbc"]) == (5.0, 1.0)


def test_exact_median(table):
    df = table("icustay_id long, v double", [(1, 1.0), (1, 2.0), (1, 10.0), (1, 20.0), (1, None), (2, 7.0)])
    rows = {r["icustay_id"]: r["m"] for r in ordered.exact_median(df, ["icustay_id"], "v", "m").collect()}
    assert rows == {1: 6.0, 2: 7.0}


def test_asof_bounds(table):
    left = table("k long, t time", [(1, at(12)), (2, at(12)), (3, at(12))])
    right = table("k long, id long, at time, v string", [
        (1, 1, at(8), "four hours"), (2, 1, at(7, 59), "older"), (3, 1, at(12), "same"),
        (3, 2, at(11), "before")])
    found = asof.asof_join(left, right, ["k"], "t", "at", ["v"], "id", tolerance=T.hours(4))
    assert {r["k"]: r["v"] for r in found.collect()} == {1: "four hours", 2: None, 3: "same"}
    strict = asof.asof_join(left, right, ["k"], "t", "at", ["v"], "id", strict=True)
    assert {r["k"]: r["v"] for r in strict.collect()} == {1: "four hours", 2: "older", 3: "before"}


COMA = "icustay_id long, charttime time, gcsmotor double, gcsverbal double, gcseyes double"


@pytest.mark.parametrize("rows,wanted", [
    ([(1, 1.0, 1.0, 1.0)], 3.0),
    ([(1, None, 0.0, 1.0)], 15.0),
    ([(1, 2.0, 0.0, 2.0), (3, 1.0, None, 1.0)], 15.0),
    ([(1, 2.0, 0.0, 2.0), (3, None, 1.0, None)], 11.0),
    ([(1, 2.0, 2.0, 2.0), (6, None, None, 1.0)], 5.0),
    ([(1, 2.0, 2.0, 2.0), (7, None, None, 1.0)], 6.0),
])
def test_worst_coma(table, rows, wanted):
    df = table(COMA, [(1, at(h), m, v, e) for h, m, v, e in rows])
    assert S.worst_coma(df, ["icustay_id"]).first()["mingcs"] == wanted


def test_gap_of_six_hours_is_not_carried(table):
    df = table(COMA, [(1, at(1), 6.0, 1.0, 4.0), (1, at(7), 6.0, None, 4.0)])
    rows = ordered.previous_within(df, ["icustay_id"], "charttime", ["gcsverbal"], T.hours(6)).collect()
    assert [r["prev_gcsverbal"] for r in rows] == [None, None]


def test_gas_ratio_uses_latest_arterial_gas(table):
    cohort = table(COHORT, [(1, 1, 1, at(20))])
    labs = table("event_id long, subject_id long, charttime time, itemid int, value string, valuenum double", [
        (1, 1, at(10), 50821, None, 90.0), (2, 1, at(10), 50800, "ART", None),
        (3, 1, at(12), 50821, None, 80.0), (4, 1, at(12), 50800, "VEN", None),
        (5, 1, at(13), 50816, None, 40.0)])
    chart = table("icustay_id long, charttime time, itemid int, valuenum double", [
        (1, at(6), 3420, 50.0), (1, at(5), 3420, 60.0)])
    row = S.asof_ratio(cohort, labs, chart, GAS, CHARTED_FIO2).first()
    assert (clock(row["charttime"]), row["po2"], row["fio2_chartevents"], row["pao2fio2"]) == ("10:00", 90.0, 50.0, 180.0)


# -- codes, status, cohort, assembly ----------------------------------------

CODE = "subject_id long, hadm_id long, icd9_code string"


def test_code_flags_are_exact_unless_normalised(table):
    cohort = table(COHORT, [(i, i, i, at(1)) for i in range(1, 6)])
    found = table(CODE, [(1, 1, "4280 "), (2, 2, "4280"), (3, 3, "2390"), (4, 4, "239"), (4, 4, "5185 ")])
    rows = {r["hadm_id"]: r for r in codes.code_flags(cohort, found, "hadm_id", COMORBIDITIES).collect()}
    assert [rows[i]["chf"] for i in (1, 2, 5)] == [1, 0, 0]
    assert [rows[i]["malignancy"] for i in (3, 4)] == [0, 1]
    assert (rows[4]["ards"], rows[4]["respfail"]) == (1, 1)
    trimmed = codes.code_flags(cohort, found, "hadm_id", COMORBIDITIES, normalise=True)
    assert {r["hadm_id"]: r["chf"] for r in trimmed.collect()}[2] == 1


def test_sepsis_rule(table):
    cohort = table(COHORT, [(i, i, i, at(1)) for i in range(1, 7)])
    admissions = table("hadm_id long", [(i,) for i in range(1, 6)])
    diagnoses = table(CODE, [(1, 1, "0389"), (2, 2, "0389"), (2, 2, "5849"), (3, 3, "99592"),
                             (4, 4, "5849"), (5, 5, "48230"), (6, 6, "99592")])
    procedures = table(CODE, [(5, 5, "9671"), (4, 4, "9671")])
    rows = codes.code_rule_score(cohort, admissions, diagnoses, procedures, SEPSIS).collect()
    assert {r["hadm_id"]: r["angus"] for r in rows} == {1: 0, 2: 1, 3: 1, 4: 0, 5: 1}


def test_status_history(table):
    rows = table("icustay_id long, event_id long, charttime time, value string", [
        (1, 1, at(1), "Full Code"), (1, 2, at(2), "Do Not Resuscita"), (1, 3, at(3), "Other/Remarks"),
        (2, 1, at(1), "something"), (2, 2, at(2), "Do Not Resuscitate"), (2, 3, at(3), None)])
    found = {r["icustay_id"]: r for r in switch_flags(status_history(rows, "icustay_id", CODE_STATUS)).collect()}
    assert (found[1]["firstcodestatus"], found[1]["lastcodestatus"]) == ("FullCode", "DNR")
    assert (found[1]["dnr_switch_flg"], found[1]["dnr_cmo_switch_flg"], found[1]["fullcode"]) == (1, 1, 1)
    assert (found[2]["firstcodestatus"], found[2]["dnr"], found[2]["dnr_switch_flg"]) == (None, 1, 0)


def test_first_stay_and_unknown_service(table):
    base = table("subject_id long, icustay_id long, admittime time, intime time", [
        (1, 10, at(5), at(6)), (1, 11, at(1), at(2)), (2, 20, at(1), at(1)), (2, 21, at(1), at(2))])
    rows = {r["subject_id"]: r["icustay_id"] for r in first_stays(base).collect()}
    assert rows == {1: 11, 2: 20}
    stays = table(
        "stay_num int, icu_los_day double, initial_aline_flg int, vent_starttime time, intime time, "
        "service_unit string",
        [(1, 2.0, 0, at(2), at(1), "MED"), (1, 2.0, 0, at(2), at(1), None), (1, 2.0, 0, at(2), at(1), "NB"),
         (1, 1.0, 0, at(2), at(1), "MED"), (1, 2.0, 0, at(13), at(1), "MED")])
    assert select_cohort(stays, inclusion_steps()).count() == 1


def test_assemble_checks_keys_and_types_missing_views(table):
    cohort = table(COHORT, [(1, 1, 1, at(1)), (2, 2, 2, at(1))])
    view = table("icustay_id long, flg int", [(1, 1)])
    views = [View("a", view, "icustay_id", {"flg": "seen"}),
             View("b", None, "icustay_id", {"score": "score"}, {"score": "int"})]
    out = assemble(cohort, views, ["icustay_id", "seen", "score"], ["seen"], check=True)
    assert [tuple(r) for r in out.collect()] == [(2, None, None)]
    assert dict(out.dtypes)["score"] == "int"
    twice = View("a", view.union(view), "icustay_id", {"flg": "seen"})
    with pytest.raises(ValueError, match="more than one row"):
        assemble(cohort, [twice], ["icustay_id"], check=True)
