"""Running values over time-ordered groups, safe when one group is huge.

Plain case: a window per group. When the largest group is above
``GROUP_ROWS`` the rows are range-partitioned by (group, order) instead, so a
group is split into consecutive chunks of even size. Each chunk runs its own
window, and what earlier chunks contribute is carried in from one summary row
per chunk of a group that spans chunks. That summary is broadcast while it has
``SUMMARY_ROWS`` rows or fewer and joined by shuffle beyond, so the size of
a chunk does not depend on how much data there is. Rows that are equal in group and
order are told apart by a hash of the row and a random number, so they too are spread.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stayframe.operators.scale import MEASURE, Sizes, fits_task, largest_group, written

SUMMARY_ROWS = 200_000
CHUNK = "_chunk"


@dataclass(frozen=True)
class Running:
    """One running column.

    how: ``last`` (latest non-NULL), ``sum``, ``max``, or ``total`` (maximum
    over the whole group). ``inclusive`` counts the current row.
    """

    name: str
    how: str
    column: Column
    inclusive: bool = True


def together(df: DataFrame, by: list[str], sizes: Sizes) -> DataFrame:
    """Put each group into one partition when its known bound allows it.

    Aggregations and windows over the group or a finer key then need no further
    shuffle. With a larger or unknown bound the table is left as it is.
    """
    if sizes.largest is not None and sizes.largest <= sizes.group_limit:
        return df.repartition(*by)
    return df


def arrange(df: DataFrame, by: list[str], order: list[str], sizes: Sizes = MEASURE) -> DataFrame:
    """Add a chunk number when a group is too large for one task.

    A known bound on the group size saves the measurement.
    """
    if sizes.largest is not None and sizes.largest <= sizes.group_limit:
        return df
    top, total = largest_group(df, by)
    if top <= sizes.group_limit:
        return df
    chunks = max(2, math.ceil(2 * total / sizes.group_limit))
    spread = written(df.withColumn("_spread", F.rand()), "spread")
    ranged = spread.repartitionByRange(chunks, *by, *order, "_spread").drop("_spread")
    return written(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def running(df: DataFrame, by: list[str], order: list[str], specs: list[Running]) -> DataFrame:
    """Add the running columns to a table returned by ``arrange``."""
    split = CHUNK in df.columns
    group = [*by, CHUNK] if split else by
    local = df
    for spec in specs:
        local = local.withColumn(spec.name, _local(spec, group, order))
    if not split:
        return local

    names = [spec.name for spec in specs]
    carried = written(_carried(df, by, order, specs), "carried")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*by, CHUNK)]
    if carried.limit(SUMMARY_ROWS + 1).count() <= SUMMARY_ROWS:
        carried = F.broadcast(carried)
    joined = local.alias("l").join(carried.alias("c"), same, "left")
    columns = [F.col(f"l.{c}") for c in df.columns]
    for spec in specs:
        here, before = F.col(f"l.{spec.name}"), F.col(f"c.{spec.name}")
        columns.append(_combine(spec, here, before).alias(spec.name))
    assert len(set(names)) == len(names)
    return joined.select(*columns)


def done(df: DataFrame) -> DataFrame:
    """Drop the chunk number, if any."""
    return df.drop(CHUNK)


def _local(spec: Running, group: list[str], order: list[str]) -> Column:
    if spec.how == "total":
        return F.max(spec.column).over(W.partitionBy(*group))
    end = 0 if spec.inclusive else -1
    frame = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, end)
    if spec.how == "last":
        return F.last(spec.column, ignorenulls=True).over(frame)
    return {"sum": F.sum, "max": F.max}[spec.how](spec.column).over(frame)


def _carried(df: DataFrame, by: list[str], order: list[str], specs: list[Running]) -> DataFrame:
    """Per chunk of a spanning group: what the other chunks contribute."""
    whole = []
    for spec in specs:
        if spec.how == "last":
            position = F.when(spec.column.isNotNull(), F.struct(*order))
            value = F.max_by(spec.column, position)
        else:
            value = F.sum(spec.column) if spec.how == "sum" else F.max(spec.column)
        whole.append(value.alias(spec.name))
    summary = df.groupBy(*by, CHUNK).agg(*whole)
    spanning = summary.withColumn("_parts", F.count("*").over(W.partitionBy(*by)))
    spanning = spanning.filter("_parts > 1")
    earlier = W.partitionBy(*by).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    columns = []
    for spec in specs:
        if spec.how == "total":
            value = F.max(spec.name).over(W.partitionBy(*by))
        elif spec.how == "last":
            value = F.last(spec.name, ignorenulls=True).over(earlier)
        else:
            value = {"sum": F.sum, "max": F.max}[spec.how](spec.name).over(earlier)
        columns.append(value.alias(spec.name))
    return spanning.select(*by, CHUNK, *columns)


def _combine(spec: Running, here: Column, before: Column) -> Column:
    if spec.how == "last":
        return F.coalesce(here, before)
    if spec.how == "sum":
        return F.coalesce(here + before, here, before)
    return F.greatest(here, before)


def carry_forward(df: DataFrame, by: list[str], time: str, column: str, name: str,
                  sizes: Sizes = MEASURE) -> DataFrame:
    """Add the latest known value of ``column`` at each row."""
    laid = arrange(df, by, [time], sizes)
    return done(running(laid, by, [time], [Running(name, "last", F.col(column))]))


def previous_within(df: DataFrame, by: list[str], time: str, columns: list[str],
                    tolerance: Column, prefix: str = "prev_",
                    sizes: Sizes = MEASURE) -> DataFrame:
    """Add the columns of the previous row, if it is less than ``tolerance`` old."""
    laid = arrange(df, by, [time], sizes)
    row = F.struct(time, *columns)
    out = running(laid, by, [time], [Running("_prev", "last", row, inclusive=False)])
    recent = F.col(f"_prev.{time}") > F.col(time) - tolerance
    added = {f"{prefix}{c}": F.when(recent, F.col(f"_prev.{c}")) for c in columns}
    return done(out.withColumns(added).drop("_prev"))


def numbered(df: DataFrame, by: list[str], order: list[str], name: str,
             sizes: Sizes = MEASURE) -> DataFrame:
    """Add the 1-based position of each row in its group."""
    laid = arrange(df, by, order, sizes)
    count = Running(name, "sum", F.lit(1))
    return done(running(laid, by, order, [count]))


def exact_median(df: DataFrame, by: list[str], value: str, name: str,
                 sizes: Sizes = MEASURE) -> DataFrame:
    """Exact interpolated median per group; NULL values are ignored.

    ``percentile`` keeps all distinct values of a group in one buffer. For a
    huge group the values are counted and ranked instead, and only the middle
    values are read. Both ways end in the same sum of halves, bit for bit.
    """
    known = df.filter(F.col(value).isNotNull())
    if fits_task(known, by, sizes):
        return known.groupBy(*by).agg(F.percentile(value, 0.5).alias(name))
    counted = known.groupBy(*by, value).agg(F.count("*").alias("_n"))
    laid = arrange(counted, by, [value], replace(sizes, largest=None))
    ranked = running(laid, by, [value], [Running("_upto", "sum", F.col("_n"))])
    ranked = running(ranked, by, [value], [Running("_size", "total", F.col("_upto"))])
    lower, upper = F.floor((F.col("_size") - 1) / 2), F.floor(F.col("_size") / 2)

    def holds(rank: Column) -> Column:
        return (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))

    middle = ranked.filter(holds(lower) | holds(upper))
    low = F.max(F.when(holds(lower), F.col(value)))
    high = F.max(F.when(holds(upper), F.col(value)))
    ends = middle.groupBy(*by).agg(low.cast("double").alias("_low"), high.cast("double").alias("_high"))
    halves = F.lit(0.5) * F.col("_low") + F.lit(0.5) * F.col("_high")
    return ends.select(*by, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(halves).alias(name))
