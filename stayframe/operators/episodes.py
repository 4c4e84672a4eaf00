"""Treatment episodes from irregular rate records, and their features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayframe.functions.numeric import first_match, flag, order_flag
from stayframe.functions.timeutil import SECONDS_PER_DAY, days_between, seconds_between
from stayframe.operators.ordered import Running, arrange, done, running, together
from stayframe.operators.scale import MEASURE, Sizes, join_cohort, with_cohort, with_largest

# Marks that say a dose was disconnected.
STOP_MARKS = ("Stopped", "D/C'd")


def one_row_per_time(doses: DataFrame, by: list[str], time: str, rate: str = "rate",
                     amount: str = "amount", stopped: str = "stopped",
                     stop_marks=STOP_MARKS) -> DataFrame:
    """Collapse records of the same key and time: highest rate and amount, any stop."""
    return doses.groupBy(*by, time).agg(
        F.max(flag(F.col(stopped).isin(list(stop_marks)))).alias("stopped"),
        F.max(rate).alias("rate"),
        F.max(amount).alias("amount"),
    )


def start_mark(rate: Column, known: Column, previous: Column, previous_stopped: Column) -> Column:
    """1 where a new episode starts, 0 inside a run of zeros, NULL elsewhere.

    ``known`` is the rate carried to this row, ``previous`` the one carried to
    the row before. The order of the cases matters.
    """
    return first_match(
        ((rate > 0) & previous.isNull(), 1),
        ((rate == 0) & (previous == 0), 0),
        ((known == 0) & (previous == 0), 0),
        (previous == 0, 1),
        (previous_stopped == 1, 1),
    )


def rate_episodes(doses: DataFrame, by: str, item: str = "itemid", time: str = "charttime",
                  stop_marks=STOP_MARKS, sizes: Sizes = MEASURE) -> DataFrame:
    """Start and end of each continuous delivery per entity and item.

    An episode starts at the first positive rate, after a zero rate or after a
    stop; it ends at its first stop, zero rate or the last record of the item.
    An episode whose first record is also its end, or that never has a positive
    rate, is dropped, as are records without an entity. The reported start is
    the first record with a rate, so start and end can still coincide.
    """
    key = [by, item]
    real = doses.filter(F.col(by).isNotNull())
    sizes = with_largest(sizes, (real, [by]))
    rows = one_row_per_time(together(real, [by], sizes), key, time, stop_marks=stop_marks)
    laid = arrange(rows, key, [time], sizes)
    rate, previous = F.col("rate"), F.col("_previous")
    seen = running(laid, key, [time], [
        Running("_previous", "last", rate, inclusive=False),
        Running("_previous_stopped", "last", F.col("stopped"), inclusive=False),
        Running("_last_time", "total", F.col(time)),
    ])
    known = F.coalesce(rate, previous)
    marked = seen.withColumn("_start", start_mark(rate, known, previous, F.col("_previous_stopped")))
    grouped = done(running(marked, key, [time], [Running("_episode", "sum", F.col("_start"))]))
    ends = (F.col("stopped") == 1) | (rate == 0) | (F.col(time) == F.col("_last_time"))
    episodes = grouped.filter(F.col("_episode") > 0).groupBy(*key, "_episode").agg(
        F.min(F.when(rate.isNotNull(), F.col(time))).alias("starttime"),
        F.min(F.when(ends, F.col(time))).alias("endtime"),
        F.min(time).alias("_first"),
        F.max("rate").alias("_top"),
    )
    kept = episodes.filter((F.col("_first") != F.col("endtime")) & (F.col("_top") > 0))
    return kept.select(by, item, "starttime", "endtime")


def episode_features(cohort: DataFrame, episodes: DataFrame, by: str, prefix: str,
                     early_hours=(3, 6, 12), early_days: float = 0.0,
                     carry=("subject_id", "hadm_id")) -> DataFrame:
    """Presence, timing, length and order features per cohort stay.

    ``early_days`` is the latest start that counts as "before" for a stay
    without the index exposure. The default 0 means at or before intake.
    """
    totals = episodes.groupBy(by).agg(
        F.min("starttime").alias("_first"),
        F.max("endtime").alias("_last"),
        F.sum(seconds_between(F.col("starttime"), F.col("endtime"))).alias("_seconds"),
    )
    rows = cohort.join(totals, by, "left")
    start = days_between(F.col("intime"), F.col("_first"))
    length = F.col("_seconds").cast("double") / SECONDS_PER_DAY
    stay = days_between(F.col("intime"), F.col("outtime"))
    early = [
        flag(start <= hour / 24).alias(f"{prefix}_1st_{hour}hr_flg") for hour in early_hours
    ]
    order = order_flag(
        start, F.col("aline_time_day"), start <= early_days,
        F.col("initial_aline_flg") == 0, F.col("aline_flg") == 1)
    order = F.when(F.col("initial_aline_flg") == 0, order)
    return rows.select(
        *carry, by,
        flag(start.isNotNull()).alias(f"{prefix}_flg"),
        start.alias(f"{prefix}_start_day"),
        days_between(F.col("_last"), F.col("outtime")).alias(f"{prefix}_free_day"),
        length.alias(f"{prefix}_day"),
        (stay - length).alias(f"{prefix}_off_day"),
        *early,
        order.alias(f"{prefix}_b4_aline"),
    )


def ever_exposed(cohort: DataFrame, tables: list[DataFrame], by: str, name: str,
                 sizes: Sizes = MEASURE) -> DataFrame:
    """1 when the stay has a row in any of the tables."""
    sizes, cohort_keys = with_cohort(sizes, cohort), cohort.select(by)
    # Copies of a key are dropped before a shuffle join, but after a broadcast join.
    rows = [t.select(by) if sizes.small_cohort else t.select(by).distinct() for t in tables]
    keys = [join_cohort(r, cohort_keys, [by], sizes=sizes).distinct() for r in rows]
    union = keys[0]
    for part in keys[1:]:
        union = union.unionByName(part)
    seen = union.distinct().withColumn("_seen", F.lit(1))
    return cohort.join(seen, by, "left").withColumn(name, F.coalesce("_seen", F.lit(0))).drop("_seen")
