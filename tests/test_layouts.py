"""Stored layouts, Bloom prefilter, byte limits, overlap pairs and first stays: rows and plans."""

import io
import random
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from stayframe.operators import asof, bloom, cohort as C, intervals as I, ordered
from stayframe.operators.scale import Sizes, broadcast_bytes, fits_broadcast, join_cohort, written
from stayframe.plans.concepts import LABS, LAB_PANEL
from stayframe.sources import layout, mapped

KNOWN = Sizes(small_cohort=True, largest=100)


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def events(spark):
    rows = spark.range(4000).selectExpr(
        "id AS event_id", "id % 300 AS subject_id", "TIMESTAMP_NTZ '2150-01-01' + make_dt_interval(0, CAST(id % 200 AS INT)) AS charttime",
        "CAST(50800 + id % 520 AS INT) AS itemid", "CAST(id AS DOUBLE) AS valuenum")
    return written(rows, "events")


def test_groups_share_cells():
    cells = layout.cells_of({"a": [1, 2, 3], "b": [3, 4], "c": [4, 3]})
    assert cells[1] == cells[2] != cells[3] != cells[4] and layout.REST not in cells.values()


def test_scan_opens_only_the_folders_of_its_items(spark, events, tmp_path):
    groups, path = {"labs": list(LABS), "panel": list(LAB_PANEL)}, str(tmp_path / "lab")
    layout.store_by_group(events, path, groups, key="subject_id")
    found = layout.read_by_group(spark, path, groups, LABS)
    assert rows_of(found) == rows_of(events.filter(F.col("itemid").isin(list(LABS))))
    text = plan(found)
    assert re.search(r"PartitionFilters: \[[^\n]*cell", text)
    other = layout.read_by_group(spark, path, groups, [50801])
    assert rows_of(other) == rows_of(events.filter("itemid = 50801"))
    folders = lambda df: {re.search(r"cell=(\d+)", f)[1] for f in df.select("event_id", F.input_file_name().alias("f")).rdd.map(lambda r: r["f"]).collect()}
    assert folders(other) <= {"0"}


def test_bucketed_events_need_no_exchange(spark, events):
    stored = layout.store_by_stay(events, "subject_id", ["charttime", "event_id"], 4)
    assert rows_of(stored) == rows_of(events)
    for df in (ordered.carry_forward(stored, ["subject_id"], "charttime", "valuenum", "kept", KNOWN),
               ordered.numbered(stored, ["subject_id"], ["charttime", "event_id"], "n", KNOWN),
               ordered.previous_within(stored, ["subject_id"], "charttime", ["valuenum"], F.expr("INTERVAL 6 HOUR"), sizes=KNOWN),
               stored.groupBy("subject_id").agg(F.max("valuenum"))):
        assert "Exchange" not in plan(df)
    plain = ordered.numbered(events, ["subject_id"], ["charttime", "event_id"], "n", KNOWN)
    assert rows_of(ordered.numbered(stored, ["subject_id"], ["charttime", "event_id"], "n", KNOWN)) == rows_of(plain)
    other = layout.store_by_stay(events.filter("event_id % 7 = 0").select("subject_id", F.col("charttime").alias("at"), F.col("event_id").alias("id")),
                                 "subject_id", ["at"], 4)
    joined = other.join(stored, "subject_id").filter("charttime <= at")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "Exchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bloom_loses_no_key_and_drops_most_others(spark, events):
    keys = written(events.select("subject_id").filter("subject_id % 20 = 3").distinct(), "keys")
    n = keys.count()
    kept = bloom.thinned(events, keys, ["subject_id"], n)
    wanted = events.join(keys, "subject_id", "left_semi").select(events.columns)
    assert set(rows_of(wanted)) <= set(rows_of(kept)) and kept.count() < wanted.count() + 0.1 * events.count()
    full = bloom.thinned(events, keys, ["subject_id"], n, limit=8)  # 64 bits: lets more through, loses none
    assert set(rows_of(wanted)) <= set(rows_of(full))
    nulls = events.withColumn("subject_id", F.when(F.col("subject_id") != 3, F.col("subject_id")))
    assert bloom.thinned(nulls, keys, ["subject_id"], n).filter("subject_id IS NULL").count() == 0
    assert bloom.thinned(events, keys.limit(0), ["subject_id"], 0).count() == 0


def test_large_cohort_thins_events_before_the_shuffle(spark, events):
    cohort = written(events.select("subject_id").filter("subject_id < 30").distinct().withColumn("x", F.lit(1)), "cohort")
    large = join_cohort(events, cohort, ["subject_id"], sizes=Sizes(small_cohort=False))
    small = join_cohort(events, cohort, ["subject_id"], sizes=Sizes(small_cohort=True))
    assert rows_of(large) == rows_of(small)
    text = plan(large)
    assert "Subquery" in text and re.search(r"Filter[^$]*xxhash64", text)


def test_broadcasts_are_sized_in_bytes(spark):
    texts = written(spark.range(100).selectExpr("id", "repeat('é', 50) AS t", "CAST(NULL AS STRING) AS u", "array(id, id) AS a"), "texts")
    assert 100 * (8 + 100) < broadcast_bytes(texts) < 100 * 200
    assert fits_broadcast(texts) and not fits_broadcast(texts, 10_000)
    assert broadcast_bytes(written(spark.range(1000), "ids")) == 1000 * 24


@pytest.mark.parametrize("limit", [10**9, 5])
def test_overlapping_pairs(spark, limit):
    rng = random.Random(4)

    def spans(n, keys):
        out = []
        for i in range(n):
            start = rng.randrange(0, 3000)
            out.append((rng.choice(keys), i, start, start + rng.choice([-5, 0, 10, 200, 2000])))
        return out

    def frame(rows):
        df = spark.createDataFrame(rows, "stay long, id int, a int, b int")
        base = F.lit("2150-01-01 00:00:00").cast("timestamp_ntz")
        return df.select("stay", "id", *[F.when(F.col(c) >= 0, base + F.make_dt_interval(mins=F.col(c))).alias(n) for c, n in (("a", "starttime"), ("b", "endtime"))])

    one, two = spans(150, [1, 1, 1, 2, None]), spans(80, [1, 1, 2, 3, None])
    found = I.overlapping_pairs(frame(one), frame(two), ["stay"], 3600, sizes=Sizes(group_limit=limit))
    assert found.columns == ["stay", "id", "starttime", "endtime", "other_id", "other_starttime", "other_endtime"]
    wanted = sorted((k, i, j) for k, i, a, b in one for m, j, c, d in two
                    if k is not None and k == m and 0 <= a <= b and 0 <= c <= d and a <= d and c <= b)
    assert sorted((r["stay"], r["id"], r["other_id"]) for r in found.collect()) == wanted and len(wanted) > 500
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)


def test_first_stays_sort_nothing(spark, folder):
    base = C.cohort_base(mapped.tables(spark, folder), mapped.RULES)
    first = C.first_stays(base)
    assert "SortAggregate" not in plan(first)
    numbered = C.numbered_stays(base).filter("stay_num = 1")
    columns = sorted(numbered.columns)
    assert rows_of(first.select(columns)) == rows_of(numbered.select(columns))
