"""NULL keys, NULL times, equal rows: the cases the fixtures of the study do not have."""

import pytest
from pyspark.sql import functions as F

from stayframe.functions import numeric as N
from stayframe.operators import asof, cohort as C, intervals as I, lookback as L, ordered, status
from stayframe.operators.assemble import View, assemble
from stayframe.operators.scale import Sizes, largest_group, spread_join
from stayframe.plans.study import drop_build

LAYOUTS = [Sizes(), Sizes(group_limit=20)]


@pytest.mark.parametrize("sizes", LAYOUTS)
def test_unknown_keys_and_times_match_nothing(table, sizes):
    left = table("k bigint, at time", [(1, "2020-01-01 10:00:00"), (None, "2020-01-01 10:00:00"), (1, None)])
    right = table("k bigint, seen time, v int, id bigint", [
        (None, "2020-01-01 09:00:00", 7, 1), (1, None, 8, 2), (1, "2020-01-01 08:00:00", 9, 3)])
    found = asof.asof_join(left, right, ["k"], "at", "seen", ["v"], "id", sizes=sizes)
    got = {(r["k"], r["at"] is None): r["v"] for r in found.collect()}
    assert got == {(1, False): 9, (None, False): None, (1, True): None}


def test_unknown_key_is_no_entity(table):
    spans = table("k bigint, starttime time, endtime time", [
        (None, "2020-01-01 01:00:00", "2020-01-01 05:00:00"), (None, "2020-01-01 02:00:00", "2020-01-01 03:00:00"),
        (1, "2020-01-01 01:00:00", "2020-01-01 02:00:00"), (1, "2020-01-01 02:00:00", "2020-01-01 03:00:00")])
    assert [r["k"] for r in I.merge_intervals(spans, ["k"]).collect()] == [1]
    free = I.uncovered_starts(spans, ["k"]).collect()
    assert sorted((r["k"] or 0, r["starttime"].hour) for r in free) == [(0, 1), (0, 2), (1, 1)]


def test_equal_rows_are_spread(spark):
    rows = spark.range(1000).select(F.lit(1).alias("k"), F.lit(5).alias("t"), F.lit(2.0).alias("v"))
    laid = ordered.arrange(rows, ["k"], ["t"], Sizes(group_limit=20))
    assert largest_group(laid, [ordered.CHUNK])[0] <= 60
    total = ordered.numbered(rows, ["k"], ["t"], "n", Sizes(group_limit=20))
    assert sorted(r["n"] for r in total.collect()) == list(range(1, 1001))
    joined = spread_join(rows, spark.createDataFrame([(1, "x")], "k int, w string"), ["k"], 20)
    assert joined.count() == 1000


def test_median_does_not_depend_on_other_groups(spark):
    rows = [(1, 0.1), (1, 0.7)] + [(2, float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, v double")
    medians = [{r["k"]: r["m"] for r in ordered.exact_median(df, ["k"], "v", "m", s).collect()} for s in LAYOUTS]
    assert medians[0] == medians[1] and medians[0][1] == 0.5 * 0.1 + 0.5 * 0.7


def test_unknown_admission_ranks_last(table):
    stays = table("subject_id bigint, admittime time, intime time, icustay_id bigint", [
        (1, None, "2020-01-01 01:00:00", 5), (1, "2020-01-02 01:00:00", "2020-01-02 02:00:00", 6)])
    assert [r["icustay_id"] for r in C.first_stays(stays).collect()] == [6]
    assert {r["icustay_id"]: r["stay_num"] for r in C.numbered_stays(stays).collect()} == {6: 1, 5: 2}


def test_unknown_time_is_neither_first_nor_last(table):
    events = table("k bigint, charttime time, event_id bigint, value string", [
        (1, None, 1, "a"), (1, "2020-01-01 01:00:00", 2, "b"), (1, "2020-01-01 02:00:00", 3, "odd")])
    got = status.status_history(events, "k", {"a": "DNR", "b": "CMO"}).first()
    assert (got["firstcodestatus"], got["lastcodestatus"], got["dnr"], got["cmo"]) == ("CMO", None, 1, 1)


def test_rounding_of_huge_numbers(spark):
    df = spark.createDataFrame([(1e30,), (2.5,)], "v double")
    assert [r[0] for r in df.select(N.round_half_up(F.col("v"), 0)).collect()] == [None, 3.0]


def test_latest_and_first_are_hash_aggregates(table):
    events = table("k bigint, charttime time, event_id bigint, label string, valuenum double, value string, flag string", [
        (1, "2020-01-01 01:00:00", 2, "A", 1.0, "b", "x"), (1, "2020-01-01 01:00:00", 3, "A", 2.0, "c", None)])
    for found in (L.reduce_labels(events, ["k"], ["A"], "last"), L.last_with_flag(events, ["k"], ["A"], "x"),
                  status.status_history(events, "k", {"b": "DNR", "c": "CMO"})):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert L.reduce_labels(events, ["k"], ["A"], "last").first()["a"] == 2.0


def test_repeated_view_key_fails(spark):
    cohort = spark.createDataFrame([(1,), (2,)], "icustay_id long")
    view = lambda rows: [View("v", spark.createDataFrame(rows, "icustay_id long, x int"), "icustay_id", {"x": "y"})]
    found = assemble(cohort, view([(1, 5)]), ["icustay_id", "y"], unique="icustay_id").orderBy("icustay_id")
    assert [tuple(r) for r in found.collect()] == [(1, 5), (2, None)]
    with pytest.raises(Exception, match="more than one row for icustay_id 1"):
        assemble(cohort, view([(1, 5), (1, 6)]), ["icustay_id", "y"], unique="icustay_id").collect()


def test_old_build_is_dropped(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "old" / "cohort"))
    drop_build(spark, str(tmp_path / "old"))
    assert not (tmp_path / "old").exists()
