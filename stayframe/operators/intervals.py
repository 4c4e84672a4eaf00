"""Intervals: union of overlapping ones, order collapse, summaries, proration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayframe.functions.numeric import flag
from stayframe.functions.timeutil import seconds_between
from stayframe.operators.ordered import Running, arrange, done, numbered, running
from stayframe.operators.scale import MEASURE, Sizes, written


def known(by: list[str]) -> Column:
    """No key is NULL."""
    test = F.lit(True)
    for key in by:
        test = test & F.col(key).isNotNull()
    return test


def interval_summary(intervals: DataFrame, by: str, start: str = "starttime",
                     end: str = "endtime") -> DataFrame:
    """First start, last end and total length in days per entity."""
    seconds = F.sum(seconds_between(F.col(start), F.col(end)))
    return intervals.groupBy(by).agg(
        (seconds.cast("double") / 86_400.0).alias("total_day"),
        F.min(start).alias("first_start"),
        F.max(end).alias("last_end"),
    )


def order_intervals(doses: DataFrame, by: list[str], start: str = "starttime",
                    end: str = "endtime", invalid: str = "Rewritten") -> DataFrame:
    """One interval per linked order; rewritten and unknown statuses are dropped."""
    valid = doses.filter(F.col("statusdescription") != invalid)
    return valid.groupBy(*by).agg(F.min(start).alias(start), F.max(end).alias(end))


def merge_intervals(df: DataFrame, by: list[str], start: str = "starttime", end: str = "endtime",
                    sizes: Sizes = MEASURE) -> DataFrame:
    """Union of closed intervals per entity; touching ones merge, start > end is dropped.

    Sorted by start, an interval opens a new island when it starts after
    everything before it has ended. Equal intervals are one, however many there
    are. A NULL key is no entity: its intervals overlap nothing, not even
    themselves, and are dropped as in a self-join on the key.
    """
    valid = df.filter(F.col(start) <= F.col(end)).filter(known(by)).select(*by, start, end).distinct()
    order = [start, end]
    laid = arrange(valid, by, order, sizes)
    reach = running(laid, by, order, [Running("_reach", "max", F.col(end), inclusive=False)])
    opens = reach.withColumn(
        "_opens", flag(F.col("_reach").isNull() | (F.col(start) > F.col("_reach"))))
    islands = done(running(opens, by, order, [Running("_island", "sum", F.col("_opens"))]))
    merged = islands.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end))
    return merged.drop("_island")


def uncovered_starts(df: DataFrame, by: list[str], start: str = "starttime", end: str = "endtime",
                     sizes: Sizes = MEASURE) -> DataFrame:
    """Distinct starts that no earlier-starting interval of the entity reaches.

    Nothing equals a NULL key, so all starts under one are free.
    """
    every = df.filter(F.col(start) <= F.col(end))
    valid, nameless = every.filter(known(by)), every.filter(~known(by))
    starts = valid.groupBy(*by, start).agg(F.max(end).alias(end))
    laid = arrange(starts, by, [start], sizes)
    reach = running(laid, by, [start], [Running("_reach", "max", F.col(end), inclusive=False)])
    free = F.col("_reach").isNull() | (F.col(start) > F.col("_reach"))
    return done(reach).filter(free).select(*by, start).unionByName(nameless.select(*by, start).distinct())


def bin_numbers(start: Column, end: Column, width_seconds: int) -> tuple[Column, Column]:
    """First and last time bin of a closed interval."""
    def number(time: Column) -> Column:
        since = (time - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second").cast("decimal(18,6)")
        return F.floor(since / width_seconds).cast("long")

    return number(start), number(end)


def overlapping_pairs(left: DataFrame, right: DataFrame, by: list[str], width_seconds: int = 6 * 3600,
                      start: str = "starttime", end: str = "endtime", prefix: str = "other_",
                      sizes: Sizes = MEASURE) -> DataFrame:
    """Every pair of closed intervals of one entity that have a moment in common.

    All columns of ``left``, and those of ``right`` besides the key under ``prefix``. An interval stands in each
    time bin it touches; pairs are made within (key, bin), an equality join, and kept in the first bin they have in common.
    So an entity with many intervals is spread over its bins, and a bin that is still hot over salts: the left rows of
    such a bin are dealt out, the right ones repeated. NULL keys and times and start > end overlap nothing.
    """
    def binned(df: DataFrame, names: dict[str, str], mark: str) -> DataFrame:
        valid = df.filter(known(by)).filter(F.col(start) <= F.col(end)).withColumnsRenamed(names)
        low, high = bin_numbers(F.col(names.get(start, start)), F.col(names.get(end, end)), width_seconds)
        return valid.withColumn(mark, low).withColumn("_bin", F.explode(F.sequence(low, high)))

    rights = {c: f"{prefix}{c}" for c in right.columns if c not in by}
    ours, theirs = binned(left, {}, "_first"), binned(right, rights, "_other_first")
    keys = [*by, "_bin"]
    counts = ours.groupBy(*keys).count()
    hot = written(counts.filter(F.col("count") > sizes.group_limit).select(
        *keys, F.ceil(F.col("count") / sizes.group_limit).cast("int").alias("_salts")), "hot")
    if not hot.isEmpty():
        spread = F.floor(F.rand() * F.coalesce("_salts", F.lit(1))).cast("int")
        ours = written(ours.join(hot, keys, "left").withColumn("_salt", spread).drop("_salts"), "salted")
        each = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
        theirs = theirs.join(hot, keys, "left").withColumn("_salt", each).drop("_salts")
        keys = [*keys, "_salt"]
    pairs = ours.join(theirs, keys).filter(F.col("_bin") == F.greatest("_first", "_other_first"))
    meet = (F.col(start) <= F.col(f"{prefix}{end}")) & (F.col(f"{prefix}{start}") <= F.col(end))
    return pairs.filter(meet).select(*left.columns, *rights.values())


def union_episodes(systems: list[DataFrame], by: list[str], number: str, start: str = "starttime",
                   end: str = "endtime", sizes: Sizes = MEASURE) -> DataFrame:
    """Number each system's episodes per entity and take the distinct union."""
    parts = [
        numbered(df.select(*by, start, end), by, [start, end], number, sizes) for df in systems
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.distinct()


def share_before(start: Column, end: Column, amount: Column, cutoff: Column,
                 clip: bool = False) -> Column:
    """Part of an interval's amount given up to the cut-off, at an even rate.

    An interval that starts after the cut-off gets a negative share unless
    ``clip`` is set. A zero-length interval past the cut-off gives NULL.
    """
    done_seconds = seconds_between(start, cutoff).cast("double")
    all_seconds = seconds_between(start, end).cast("double")
    share = F.try_divide(done_seconds, all_seconds)
    if clip:
        share = F.greatest(share, F.lit(0.0))
    return F.when(end <= cutoff, amount).otherwise(share * amount)
