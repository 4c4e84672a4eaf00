"""As-of matching: the latest earlier row of another table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayframe.operators.ordered import Running, arrange, done, running
from stayframe.operators.scale import MEASURE, Sizes, join_cohort


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str,
              columns: list[str], tie: str, tolerance: Column | None = None,
              strict: bool = False, sizes: Sizes = MEASURE) -> DataFrame:
    """Every left row with the columns of the latest right row at or before it.

    ``strict`` excludes equal times, ``tolerance`` is an inclusive age limit,
    ``tie`` decides between right rows of the same time. Both tables are
    sorted together; no pairs are formed. As in SQL, a NULL key or time matches
    nothing: such left rows stay unmatched and are kept out of the sort, where
    they would make the largest group.
    """
    name = right_time if right_time != left_time else f"matched_{right_time}"
    known = F.lit(True)
    for key in by:
        known = known & F.col(key).isNotNull()
    right = right.filter(known & F.col(right_time).isNotNull())
    unmatched = left.filter(~(known & F.col(left_time).isNotNull()))
    left = left.filter(known & F.col(left_time).isNotNull())
    left_side, right_side = (0, 1) if strict else (1, 0)
    payload = F.struct(F.col(right_time).alias("_at"), *columns)
    rows = left.select(
        *by, F.col(left_time).alias("_time"), F.lit(left_side).alias("_side"),
        F.lit(None).cast("long").alias("_tie"), F.struct(*left.columns).alias("_left"))
    matches = right.select(
        *by, F.col(right_time).alias("_time"), F.lit(right_side).alias("_side"),
        F.col(tie).cast("long").alias("_tie"), payload.alias("_right"))
    both = rows.unionByName(matches, allowMissingColumns=True)
    order = ["_time", "_side", "_tie"]
    laid = arrange(both, by, order, sizes)
    found = running(laid, by, order, [Running("_match", "last", F.col("_right"))])
    found = done(found).filter(F.col("_left").isNotNull())
    usable = F.col("_match").isNotNull()
    if tolerance is not None:
        usable = usable & (F.col("_match._at") >= F.col("_time") - tolerance)
    matched = {name: F.when(usable, F.col(f"_match.{name}")) for name in columns}
    matched[name] = F.when(usable, F.col("_match._at"))
    found = found.select("_left.*", *[c.alias(n) for n, c in matched.items()])
    return found.unionByName(unmatched, allowMissingColumns=True)


def latest_before(events: DataFrame, cohort: DataFrame, on: list[str], key: str, before: Column,
                  time: str, tie: str, column: str, sizes: Sizes = MEASURE) -> DataFrame:
    """Per cohort key, the column of the latest event strictly before a time.

    Reduces to one row per key map-side, for when only one time per key matters.
    """
    found = join_cohort(events, cohort, on, F.col(time) < before, sizes)
    return found.groupBy(key).agg(F.max_by(column, F.struct(time, tie)).alias(column))
