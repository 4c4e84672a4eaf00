"""The whole study on a small hospital with the real item ids."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayframe.plans.study import Study, VIEW_KEYS, build_all, build_report
from stayframe.sources.tables import SCHEMAS, conform, read_tables


def at(hour, minute=0, day=1):
    return dt.datetime(2150, 1, day, hour, minute)


NOTE = ("Indication: murmur\nHeight: (in) 70\nWeight (lb): 154\nBSA (m2): 1.87 m2\nBP (mm Hg): 120/80\n"
        "HR (bpm): 72\nStatus: Inpatient\nDate/Time: [**2150-1-1**] at 9:15\nTest: TTE\nDoppler: Full\n"
        "Contrast: None\nTechnical Quality: Good\n")

ROWS = {
    "icustays": [(s, s * 10, s * 100, at(8), at(20, day=3)) for s in (1, 2, 3, 4)],
    "admissions": [(10, 1, at(6), at(12, day=6), None), (20, 2, at(6), at(12, day=6), at(1, day=6)),
                   (30, 3, at(6), at(12, day=6), None), (40, 4, at(6), at(12, day=6), None)],
    "patients": [(1, "M", dt.datetime(2100, 1, 1), None), (2, "F", dt.datetime(2080, 1, 1), at(0, day=6)),
                 (3, "F", dt.datetime(2140, 1, 1), None), (4, "M", dt.datetime(2100, 1, 1), None)],
    "services": [(10, 1, at(5), "MED"), (10, 2, at(9), "SURG"), (20, 3, at(7), "CMED"),
                 (30, 4, at(5), "MED"), (40, 5, at(5), "CSURG")],
    "ventdurations": [(s * 100, at(14), at(2, day=2)) for s in (1, 2, 3, 4)],
    "chartevents": [
        (1, 1, 100, at(16), 51, None, 120.0),
        (2, 1, 100, at(10), 443, None, 65.0), (3, 1, 100, at(11), 456, None, 80.0),
        (4, 1, 100, at(12), 678, None, 98.6), (5, 1, 100, at(12), 211, None, 90.0),
        (6, 1, 100, at(9), 3420, None, 40.0),
        (7, 1, 100, at(9), 454, None, 5.0), (8, 1, 100, at(9), 723, None, 4.0),
        (9, 1, 100, at(9), 184, None, 3.0),
        (10, 1, 100, at(9), 762, None, 80.0), (11, 1, 100, at(10), 226512, None, 90.0),
        (12, 1, 100, at(9), 920, None, 70.0),
        (13, 1, 100, at(9), 128, "Full Code", None), (14, 1, 100, at(15), 128, "Comfort Measures", None),
    ],
    "labevents": [
        (1, 1, at(10), 51006, None, 20.0, None), (2, 1, at(12), 51006, None, 30.0, "abnormal"),
        (3, 1, at(12), 50912, None, 2.5, None), (4, 1, at(12), 51265, None, 90.0, None),
        (5, 1, at(12), 50885, None, 1.5, None), (6, 1, at(12), 50821, None, 80.0, None),
        (7, 1, at(12), 50800, "ART", None, None), (8, 1, at(11), 51221, None, 46.0, None),
        (9, 1, at(20), 51006, None, 99.0, None), (10, 1, at(11), 50813, None, 4.0, "abnormal"),
    ],
    "outputevents": [(1, at(10), 40055, 300.0), (1, at(12), 226559, 150.0), (1, at(12), 1, 999.0)],
    "inputevents_cv": [(200, at(9), 30047, None, 2.0, 1.0), (200, at(11), 30047, "Stopped", 2.0, 1.0),
                       (100, at(9), 30131, None, 1.0, 1.0), (100, at(13), 30131, None, 0.0, 0.0),
                       (100, at(10), 30001, None, None, 250.0), (100, at(10, day=2), 30001, None, None, 100.0)],
    "inputevents_mv": [(200, 5, 221906, at(10), at(15), 1.0, 1.0, "FinishedRunning"),
                       (100, 6, 220996, at(6, day=2), at(10, day=2), 1.0, 300.0, "FinishedRunning"),
                       (100, 7, 222168, at(12), at(14), 1.0, 1.0, "Rewritten")],
    "diagnoses_icd": [(1, 10, "42731"), (2, 20, "4280 "), (1, 10, "5185 ")],
    "procedures_icd": [(1, 10, "9671")],
    "noteevents": [(1, 10, "Echo", at(0), NOTE), (2, 10, "Echo", at(0), "Height: (in) 99\n")],
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hospital"))
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(ROWS[name], schema).write.parquet(f"{folder}/{name}.parquet")
    return build_all(spark, Study(read_tables(spark, folder)), register=True)


def row(df, key, value):
    found = df.filter(F.col(key) == value).collect()
    assert len(found) == 1
    return found[0]


def test_cohort(built):
    rows = {r["subject_id"]: r for r in built["cohort"].collect()}
    assert set(rows) == {1, 2}
    one, two = rows[1], rows[2]
    assert (one["service_unit"], one["service_num"], two["service_num"]) == ("SURG", 1, 2)
    assert (one["aline_flg"], one["aline_time_day"], one["vent_b4_aline"]) == (1, 8 / 24, 1)
    assert (two["aline_flg"], two["vent_b4_aline"], two["hosp_exp_flg"], two["icu_exp_flg"]) == (0, 0, 1, 0)
    assert (one["vent_day"], one["icu_los_day"], one["mort_day_censored"], two["day_28_flg"]) == (0.5, 2.5, 150.0, 1)


def test_labs_vitals_and_scores(built):
    labs = row(built["labs"], "hadm_id", 10)
    assert (labs["bun_first"], labs["creatinine_first"], labs["wbc_first"]) == (30.0, 2.5, None)
    vitals = row(built["vitals"], "hadm_id", 10)
    assert (vitals["map"], vitals["heartrate"]) == (80.0, 90.0)
    assert vitals["temperature"] == pytest.approx(37.0)
    sofa = row(built["sofa"], "icustay_id", 100)
    assert [sofa[c] for c in ("respiration", "coagulation", "liver", "cardiovascular", "cns", "renal")] == [2, 2, 1, 1, 2, 3]
    assert (sofa["sofa"], row(built["sofa"], "icustay_id", 200)["sofa"]) == (11, 0)
    panel = row(built["labs_all"], "hadm_id", 10)
    assert (panel["hct_med"], panel["hct_abnormal_flg"], panel["bun_abnormal_flg"]) == (46.0, 0, 1)
    assert (panel["lactate_first"], panel["lactate_abnormal_flg"], panel["wbc_abnormal_flg"]) == (4.0, 1, 0)
    assert row(built["labs_all"], "hadm_id", 20)["hct_abnormal_flg"] == 1


def test_notes_and_body(built):
    echo = row(built["echodata"], "icustay_id", 100)
    assert (echo["row_id"], echo["charttime"], echo["height_first"]) == (1, at(9, 15), 70.0)
    assert (echo["bsa_first"], echo["bpsys"], echo["bpdias"], echo["technicalquality"]) == (1.87, 120.0, 80.0, "Good")
    assert echo["bmi"] == pytest.approx(22.094, abs=1e-3)
    body = row(built["bmi"], "icustay_id", 100)
    assert (body["weight"], body["height_chart"]) == (85.0, 70 * 2.54)
    assert body["bmi"] == pytest.approx(85 / 1.778 ** 2)


def test_drugs_status_and_volumes(built):
    vaso = row(built["vaso"], "icustay_id", 200)
    assert (vaso["vaso_flg"], vaso["vaso_day"], vaso["vaso_b4_aline"]) == (1, pytest.approx(7 / 24), 0)
    assert (vaso["vaso_1st_3hr_flg"], vaso["vaso_start_day"]) == (1, pytest.approx(1 / 24))
    anes = row(built["anaesthesia"], "icustay_id", 100)
    assert (anes["anes_day"], anes["anes_b4_aline"]) == (pytest.approx(4 / 24), 1)
    status = row(built["codestatus"], "icustay_id", 100)
    assert (status["lastcodestatus"], status["cmo_switch_flg"], status["dnr_cmo_switch_flg"]) == ("CMO", 1, 1)
    cells = row(built["rbc"], "icustay_id", 100)
    assert (cells["rbc"], cells["rbc_day1"], cells["rbc_or"]) == (650.0, 250.0 + 150.0, None)


def test_final_tables(built):
    final = built["data"].collect()
    assert [r["icustay_id"] for r in final] == [100] and len(built["data"].columns) == 50
    assert (final[0]["sofa_first"], final[0]["afib_flg"], final[0]["ards_flg"]) == (11, 1, 1)
    assert [r["icustay_id"] for r in built["data_full"].collect()] == [100]
    assert len(built["data_full"].columns) == 85


def test_report_and_registered_views(spark, built):
    report = {r["view"]: (r["n_rows"], r["n_keys"]) for r in build_report(built).collect()}
    assert set(report) == set(VIEW_KEYS)
    assert all(n == k for n, k in report.values())
    assert spark.table("study_sofa").count() == 2


def test_external_scores_are_used(spark, built):
    study = Study({name: spark.createDataFrame(ROWS[name], SCHEMAS[name]) for name in SCHEMAS})
    study.tables |= {
        "saps": spark.createDataFrame([(100, 14)], "icustay_id long, saps int"),
        "sofa": spark.createDataFrame([(100, 5)], "icustay_id long, sofa int"),
        "angus_sepsis": spark.createDataFrame([(20, 1)], "hadm_id long, angus int"),
    }
    out = study.wide_table(built["cohort"], built).collect()
    assert [(r["icustay_id"], r["sapsi_first"], r["sofa_first"]) for r in out] == [(100, 14, 5)]


def test_conform_checks_columns(spark):
    rows = spark.createDataFrame([(1, 2, "MED", "x")], "ROW_ID int, hadm_id int, curr_service string, more string")
    with pytest.raises(ValueError, match="transfertime"):
        conform(rows, "services")
    full = rows.withColumn("transfertime", F.current_timestamp())
    assert conform(full, "services").dtypes == [
        ("hadm_id", "bigint"), ("event_id", "bigint"), ("transfertime", "timestamp_ntz"),
        ("curr_service", "string")]
