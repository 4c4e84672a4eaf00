"""Body measures and given volumes from several sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayframe.functions.numeric import (
    INCH_IN_CM, POUND_IN_KG, metric_bmi, round_half_up, sum_of_known)
from stayframe.functions.timeutil import days
from stayframe.operators.intervals import share_before
from stayframe.operators.lookback import Item, label_items, lookback
from stayframe.operators.ordered import exact_median
from stayframe.operators.scale import MEASURE, Sizes, join_cohort, with_cohort


def median_measure(events: DataFrame, cohort: DataFrame, items: dict[int, Item], index_time: str,
                   before_hours: float | None, name: str, sizes: Sizes = MEASURE) -> DataFrame:
    """Exact median of a subject's non-zero values in the window, per stay."""
    ids = list(items)
    values = events.filter(
        F.col("itemid").isin(ids) & F.col("valuenum").isNotNull() & (F.col("valuenum") != 0))
    labelled = label_items(values, items).select("subject_id", "charttime", "valuenum")
    narrow = cohort.select("subject_id", "icustay_id", index_time)
    found = lookback(labelled, narrow, ["subject_id"], index_time, "charttime", before_hours, sizes)
    return exact_median(found, ["icustay_id"], "valuenum", name, sizes)


def body_measure(cohort: DataFrame, chart: DataFrame, notes: DataFrame, weight_admit: dict[int, Item],
                 weight_daily: dict[int, Item], height: dict[int, Item],
                 sizes: Sizes = MEASURE) -> DataFrame:
    """Weight, height and BMI: charted medians first, then the report's values.

    Weight is rounded to 2 digits, height is not.
    """
    sizes = with_cohort(sizes, cohort)

    def window(items, index_time, before_hours, name):
        return median_measure(chart, cohort, items, index_time, before_hours, name, sizes)

    admit = window(weight_admit, "vent_starttime", 24, "weight_admit")
    daily = window(weight_daily, "vent_starttime", 24, "weight_daily")
    charted = window(height, "outtime", None, "height_chart")
    parts = cohort.select("icustay_id")
    for part in (admit, daily, charted, echo_parts(notes)):
        parts = parts.join(part, "icustay_id", "left")
    return body_columns(parts).select(
        "icustay_id", "bmi", "height", "weight", "height_chart", "weight_admit", "weight_daily", "height_echo", "weight_echo")


def echo_parts(notes: DataFrame) -> DataFrame:
    """Height and weight of the reports in metric units."""
    return notes.select(
        "icustay_id",
        (F.lit(INCH_IN_CM) * F.col("height_first")).alias("height_echo"),
        (F.lit(POUND_IN_KG) * F.col("weight_first")).alias("weight_echo"),
    )


def body_columns(parts: DataFrame) -> DataFrame:
    """Adds weight, height and BMI: charted medians first, then the report's values."""
    weight = round_half_up(F.coalesce("weight_admit", "weight_daily", "weight_echo"), 2)
    height_m = F.coalesce("height_chart", "height_echo") / 100.0
    both = parts.withColumns({"weight": weight, "height": height_m})
    return both.withColumn("bmi", metric_bmi(F.col("weight"), F.col("height")))


def given_volumes(cohort: DataFrame, points: DataFrame, intervals: DataFrame,
                  point_items: dict[str, list[int]], interval_items: dict[str, list[int]],
                  clip: bool = False, sizes: Sizes = MEASURE) -> DataFrame:
    """Total and first-day volume per group of items, from both input systems.

    Point records count whole when charted in the first day. Interval records
    count their share before the end of the first day; their total only takes
    records that start in the first day. A value known in one system only is
    used as it is.
    """
    key = "icustay_id"
    sizes = with_cohort(sizes, cohort)
    narrow = cohort.select(key, (F.col("intime") + days(1)).alias("_day1"))
    amount, day1, item = F.col("amount"), F.col("_day1"), F.col("itemid")

    def ids(groups):
        return sorted({i for group in groups.values() for i in group})

    def sums(values: dict[str, tuple[list[int], Column, Column]]):
        return [
            F.sum(F.when(item.isin(group) & test, value)).alias(name)
            for name, (group, test, value) in values.items()
        ]

    point_rows = join_cohort(
        points.filter(item.isin(ids(point_items))).select(key, "charttime", "itemid", "amount"),
        narrow, [key], sizes=sizes)
    point_sums = {}
    for name, group in point_items.items():
        point_sums[name] = (group, F.lit(True), amount)
        point_sums[f"{name}_day1"] = (group, F.col("charttime") < day1, amount)
    from_points = point_rows.groupBy(key).agg(*sums(point_sums))

    valid = item.isin(ids(interval_items)) & (F.col("statusdescription") != "Rewritten")
    interval_rows = join_cohort(
        intervals.filter(valid).select(key, "starttime", "endtime", "itemid", "amount"),
        narrow, [key], sizes=sizes)
    share = share_before(F.col("starttime"), F.col("endtime"), amount, day1, clip)
    interval_sums = {}
    for name, group in interval_items.items():
        interval_sums[name] = (group, F.col("starttime") <= day1, amount)
        interval_sums[f"{name}_day1"] = (group, F.lit(True), share)
    from_intervals = interval_rows.groupBy(key).agg(*sums(interval_sums))

    names = list(point_sums)
    joined = (
        cohort.select("subject_id", "hadm_id", key)
        .join(from_points.select(key, *[F.col(n).alias(f"_p_{n}") for n in names]), key, "left")
        .join(from_intervals.select(key, *[F.col(n).alias(f"_i_{n}") for n in names]), key, "left")
    )
    volumes = [sum_of_known(F.col(f"_p_{n}"), F.col(f"_i_{n}")).alias(n) for n in names]
    return joined.select("subject_id", "hadm_id", key, *volumes)
