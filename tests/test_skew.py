"""The layouts for hot keys give the same rows as the plain ones and as brute force."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from stayframe.functions import timeutil as T
from stayframe.operators import asof, codes, episodes as E, intervals as I, lookback as L, ordered
from stayframe.operators import scores as S
from stayframe.operators.ordered import CHUNK, Running, arrange, running
from stayframe.operators.scale import Sizes, largest_of, shared_folder, spread_join
from stayframe.plans.concepts import COMORBIDITIES
from stayframe.plans.catalog import QUERIES
from stayframe.plans.study import Study
from stayframe.sources import mapped

PLAIN = Sizes(small_cohort=True, group_limit=10**9)
HOT = Sizes(small_cohort=False, group_limit=20)
BASE = "2150-01-01 00:00:00"


def minutes(df, *names):
    for name in names:
        ts = F.lit(BASE).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col(name).cast("int"))
        df = df.withColumn(name, ts)
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def doses(spark):
    """One stay holds most records; a few others are small."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        stay = 1 if rng.random() < 0.6 else rng.randint(2, 30)
        rate = rng.choice([None, 0.0, 0.0, 1.0, 2.5, 4.0])
        rows.append((stay, rng.randint(1, 2), i * 3 + rng.randint(0, 2), rng.choice(["Stopped", None, None, None]),
                     rate, 1.0))
    df = spark.createDataFrame(
        rows, "icustay_id long, itemid int, charttime int, stopped string, rate double, amount double")
    return minutes(df, "charttime")


@pytest.fixture(scope="module")
def spans(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(600):
        start = rng.randint(0, 4000)
        rows.append((1 if rng.random() < 0.6 else rng.randint(2, 20), start, start + rng.randint(-3, 25)))
    return spark.createDataFrame(rows, "icustay_id long, starttime int, endtime int")


def test_chunks_keep_order_and_split_the_hot_group(doses):
    laid = arrange(doses, ["icustay_id"], ["charttime"], HOT)
    chunks = laid.groupBy("icustay_id", CHUNK).agg(
        F.min("charttime").alias("a"), F.max("charttime").alias("b"), F.count("*").alias("n"))
    hot = sorted(((r[CHUNK], r["a"], r["b"], r["n"]) for r in chunks.filter("icustay_id = 1").collect()))
    assert len(hot) > 10
    assert all(x[2] <= y[1] for x, y in zip(hot, hot[1:]))
    assert max(n for *_, n in hot) < 200
    assert CHUNK not in arrange(doses, ["icustay_id"], ["charttime"], PLAIN).columns


def test_running_values(doses):
    by, order = ["icustay_id"], ["charttime"]
    specs = [
        Running("last_in", "last", F.col("rate")), Running("last_ex", "last", F.col("rate"), inclusive=False),
        Running("sum_in", "sum", F.col("rate")), Running("sum_ex", "sum", F.col("rate"), inclusive=False),
        Running("max_ex", "max", F.col("rate"), inclusive=False), Running("top", "total", F.col("charttime")),
    ]
    results = []
    for sizes in (PLAIN, HOT):
        out = ordered.done(running(arrange(doses, by, order, sizes), by, order, specs))
        results.append(rows_of(out.select(*by, *order, "itemid", *[s.name for s in specs])))
    assert results[0] == results[1]


def test_episodes_are_the_same_in_chunks(doses):
    plain = rows_of(E.rate_episodes(doses, "icustay_id", sizes=PLAIN))
    assert len(plain) > 100
    assert plain == rows_of(E.rate_episodes(doses, "icustay_id", sizes=HOT))


def brute_union(rows):
    """Union of closed intervals by repeated merging."""
    found = {}
    for stay, a, b in rows:
        if a > b:
            continue
        group = found.setdefault(stay, [])
        touching = [x for x in group if x[0] <= b and a <= x[1]]
        for x in touching:
            group.remove(x)
        group.append((min([a, *[x[0] for x in touching]]), max([b, *[x[1] for x in touching]])))
    return sorted((stay, a, b) for stay, group in found.items() for a, b in group)


@pytest.mark.parametrize("sizes", [PLAIN, HOT])
def test_merge_intervals_against_brute_force(spans, sizes):
    wanted = brute_union([tuple(r) for r in spans.collect()])
    got = I.merge_intervals(spans, ["icustay_id"], sizes=sizes)
    assert sorted(tuple(r) for r in got.collect()) == wanted
    starts = I.uncovered_starts(spans, ["icustay_id"], sizes=sizes)
    assert sorted(tuple(r) for r in starts.collect()) == [(s, a) for s, a, _ in wanted]


@pytest.mark.parametrize("sizes", [PLAIN, HOT])
def test_median_against_brute_force(spark, sizes):
    rng = random.Random(3)
    rows = [(1 if rng.random() < 0.7 else rng.randint(2, 15), rng.choice([rng.random(), 0.5, None]))
            for _ in range(800)]
    df = spark.createDataFrame(rows, "k long, v double")
    wanted = {}
    for k, v in rows:
        if v is not None:
            wanted.setdefault(k, []).append(v)
    got = {r["k"]: r["m"] for r in ordered.exact_median(df, ["k"], "v", "m", sizes).collect()}
    assert got == {k: statistics.median(v) for k, v in wanted.items()}


@pytest.mark.parametrize("sizes", [PLAIN, HOT])
@pytest.mark.parametrize("strict", [True, False])
def test_asof_against_brute_force(spark, sizes, strict):
    rng = random.Random(5)
    left = [(1 if rng.random() < 0.6 else rng.randint(2, 9), rng.randint(0, 300), i) for i in range(300)]
    right = [(1 if rng.random() < 0.6 else rng.randint(2, 9), rng.randint(0, 300), i) for i in range(300)]
    a = minutes(spark.createDataFrame(left, "k long, t int, n long"), "t")
    b = minutes(spark.createDataFrame(right, "k long, at int, id long"), "at")
    out = asof.asof_join(a, b.withColumn("v", F.col("id")), ["k"], "t", "at", ["v"], "id",
                         tolerance=T.hours(0.25), strict=strict, sizes=sizes)
    wanted = {}
    for k, t, n in left:
        fits = [(u, i) for kk, u, i in right if kk == k and (u < t if strict else u <= t)]
        best = max(fits, default=None)
        wanted[n] = best[1] if best and best[0] >= t - 15 else None
    assert {r["n"]: r["v"] for r in out.collect()} == wanted


def test_salted_join_equals_broadcast(doses, spark):
    cohort = minutes(spark.createDataFrame([(i, 2000 + i) for i in range(1, 25)], "icustay_id long, idx int"), "idx")
    joined = [
        rows_of(L.lookback(doses, cohort, ["icustay_id"], "idx", "charttime", 24, sizes)
                .select("icustay_id", "charttime", "itemid", "rate", "idx"))
        for sizes in (PLAIN, HOT)]
    assert joined[0] == joined[1] and joined[0]


def test_spread_join_splits_the_hot_key(doses, spark):
    cohort = spark.createDataFrame([(i,) for i in range(1, 31)], "icustay_id long")
    joined = spread_join(doses, cohort, ["icustay_id"], 50)
    assert rows_of(joined) == rows_of(doses.select(*joined.columns))
    assert "_salt" in joined._jdf.queryExecution().toString()
    calm = spread_join(doses, cohort, ["icustay_id"], 10**6)
    assert "_salt" not in calm._jdf.queryExecution().toString()


def test_coma_and_codes_on_hot_layout(spark, folder):
    rows = mapped.table(spark, folder, "gcsevents")
    coma = rows.groupBy("icustay_id", "charttime").agg(
        *[F.max(F.when(F.col("itemid") == i, F.col("valuenum"))).alias(n)
          for i, n in ((200, "gcsmotor"), (201, "gcsverbal"), (202, "gcseyes"))])
    plain = rows_of(S.worst_coma(coma, ["icustay_id"], sizes=PLAIN))
    assert plain == rows_of(S.worst_coma(coma, ["icustay_id"], sizes=Sizes(group_limit=5)))
    found = mapped.table(spark, folder, "diagnoses_icd")
    cohort = mapped.table(spark, folder, "icustays")
    flags = [rows_of(codes.code_flags(cohort, found, "hadm_id", COMORBIDITIES, sizes=s)) for s in (PLAIN, HOT)]
    assert flags[0] == flags[1]


def test_whole_study_on_hot_layout(spark, folder):
    base = mapped.study(spark, folder)
    tables, c = base.tables, base.concepts
    hot = Study(tables, c, base.rules, base.flag_concepts, Sizes(small_cohort=False, group_limit=6))
    for make in ("final", "wide"):
        plain = getattr(base, make)()
        other = getattr(hot, make)()
        names = [n for n, t in plain.dtypes if t != "double"]
        assert rows_of(plain.select(*names)) == rows_of(other.select(*names))
        doubles = [F.round(n, 6).alias(n) for n, t in plain.dtypes if t == "double"]
        assert rows_of(plain.select(*doubles)) == rows_of(other.select(*doubles))


def test_largest_group_over_tables(spark):
    a = spark.createDataFrame([(1,)] * 5 + [(2,)], "k long")
    b = spark.createDataFrame([(7,)] * 3, "k long")
    assert largest_of((a, ["k"]), (b, ["k"])) == (5, 9)
    assert largest_of((a.filter("k > 9"), ["k"])) == (0, 0)


class Settings(dict):
    """Stands in for a session that only has settings."""

    @property
    def conf(self):
        return self


def test_shared_folder_is_read_from_the_session():
    assert shared_folder(Settings({"spark.checkpoint.dir": "hdfs:///ck/"})) == "hdfs:///ck"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Settings({"spark.master": "yarn"}))
    own = shared_folder(Settings({"spark.master": "local[2]", "spark.app.id": "a"}))
    assert own == shared_folder(Settings({"spark.master": "local[2]", "spark.app.id": "a"}))


def test_intermediate_tables_go_to_the_shared_folder(spark):
    cohort = QUERIES["cohort_select"](spark, "/root/testdata/sf0.001")
    assert len(cohort.columns) == 37
    assert all(shared_folder(spark) in path for path in cohort.inputFiles())
