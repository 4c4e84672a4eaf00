"""Physical plans: what is pushed down, broadcast and shuffled."""

import io
import re
from contextlib import redirect_stdout

import pytest
from stayframe.operators import episodes as E, intervals as I, lookback as L
from stayframe.operators.scale import MEASURE, Sizes, written
from stayframe.plans import views as V
from stayframe.plans.concepts import Concepts, LABS
from stayframe.sources import mapped


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def events(spark):
    """A stored lab table with real item ids."""
    rows = spark.range(2000).selectExpr(
        "id AS event_id", "id % 50 AS subject_id",
        "TIMESTAMP_NTZ '2150-01-01' + make_dt_interval(0, CAST(id % 200 AS INT)) AS charttime",
        "CAST(50800 + id % 520 AS INT) AS itemid", "CAST(id AS DOUBLE) AS valuenum",
        "'x' AS value", "'abnormal' AS flag", "'unused' AS comment")
    return written(rows, "events")


@pytest.fixture(scope="module")
def cohort(spark):
    rows = spark.range(50).selectExpr(
        "id AS subject_id", "id AS hadm_id", "id AS icustay_id",
        "TIMESTAMP_NTZ '2150-01-05 00:00:00' AS vent_starttime")
    return written(rows, "small")


def test_item_filter_and_columns_reach_the_scan(events, cohort):
    text = plan(V.view_labs(cohort, {"labevents": events}, Concepts(), MEASURE))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    lab_scan = next(s for s in scans if "itemid" in s)
    assert "comment" not in lab_scan and "flag" not in lab_scan
    assert re.search(r"PushedFilters: \[[^\n]*In\(itemid", text)


def test_lookback_broadcasts_a_small_cohort(events, cohort):
    rows = L.label_items(events, LABS).select("subject_id", "charttime", "valuenum")
    narrow = cohort.select("subject_id", "vent_starttime")
    text = plan(L.lookback(rows, narrow, ["subject_id"], "vent_starttime", "charttime", 24))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    every = events.select("subject_id", "charttime", "valuenum")
    spread = plan(L.lookback(every, narrow, ["subject_id"], "vent_starttime", "charttime", 24,
                             Sizes(small_cohort=False, group_limit=5)))
    assert re.search(r"Right keys \[2\]: \[subject_id#\d+L, _salt", spread)


def test_latest_values_need_one_shuffle_of_the_events(events, cohort):
    found = V.labelled_window(events, cohort, LABS, 24, [], MEASURE)
    text = plan(L.reduce_labels(found, ["hadm_id"], ["BUN", "WBC"], "last"))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    assert "Window" not in text


def test_merging_has_no_loop_join_and_one_sort_order(spark, folder):
    orders = I.order_intervals(mapped.table(spark, folder, "inputevents_mv"), ["icustay_id", "linkorderid"])
    text = plan(I.merge_intervals(orders, ["icustay_id"]))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "single" not in " ".join(re.findall(r"Exchange.*", text)).lower()


def test_episodes_to_union_need_one_shuffle_per_system(spark, folder):
    found = mapped.tables(spark, folder)
    known = Sizes(largest=100)
    points = E.rate_episodes(found["inputevents_cv"], "icustay_id", sizes=known)
    text = plan(I.merge_intervals(points, ["icustay_id"], sizes=known))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1


def test_mapped_records_push_the_event_type(spark, folder):
    text = plan(mapped.table(spark, folder, "services").select("hadm_id", "curr_service"))
    assert re.search(r"PushedFilters: \[[^\n]*event_type", text)
    assert "value:double" not in text


@pytest.mark.parametrize("make, scans, broadcasts", [("final", 12, 8), ("wide", 24, 12)])
def test_events_are_read_once(spark, folder, make, scans, broadcasts):
    text = plan(getattr(mapped.study(spark, folder), make)())
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) <= scans
    assert len(re.findall(r"^\(\d+\) BroadcastExchange", text, re.M)) <= broadcasts
    assert len(re.findall(r"/events-", text)) == 1


def test_a_pass_shuffles_once(spark, folder):
    study = mapped.study(spark, folder)
    text = plan(study.stats(study.cohort()))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1


def test_no_python_workers(spark, folder):
    study = mapped.study(spark, folder)
    text = plan(study.final())
    assert "Python" not in text and "Pandas" not in text
