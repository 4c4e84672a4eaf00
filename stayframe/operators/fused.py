"""Many statistics of each stay's events in one pass.

Event tables of different kinds become one *stream* of narrow rows that carry the
stay and its index times. A ``Family`` picks rows of the stream: source, items with their unit rules
and a window before an index time. A ``Stat`` is one output column: a statistic of a
family's rows with one label. All families and statistics are compiled into one
aggregation by stay, so the stream is read, shuffled and sorted once, however many views need it.

Values that belong together by time (the parts of a blood gas, of a coma score) are put side by side by
windows over (stay, time), which the same shuffle and sort serve. The rows of one stay
are sorted by one task; see ``Sizes.group_limit`` for stays that are too large for that.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stayframe.functions.timeutil import position
from stayframe.operators.lookback import Item, clean_value, in_window, item_label

STAY = "icustay_id"
#: columns of every event of the stream besides the stay's
EVENT = {"source": "string", "own": "boolean", "charttime": "timestamp_ntz", "event_id": "long", "itemid": "int",
         "num": "double", "text": "string", "mark": "string"}
PLACE = "_place"


@dataclass(frozen=True)
class Family:
    """Rows of one source: items, window before ``index`` (all rows if None), and a further test.

    ``own`` takes only rows recorded for the stay itself, not others of the subject.
    """

    name: str
    source: str
    items: Mapping[int, Item]
    index: str | None
    before_hours: float | None = None
    own: bool = False
    where: Column | None = None

    @property
    def label(self) -> str:
        return f"_{self.name}_label"

    @property
    def value(self) -> str:
        return f"_{self.name}_value"

    def holds(self) -> Column:
        test = (F.col("source") == self.source) & F.col("itemid").isin(sorted(self.items))
        if self.own:
            test = test & F.col("own")
        if self.index:
            test = test & in_window(F.col("charttime"), F.col(self.index), self.before_hours)
        return test if self.where is None else test & self.where

    def columns(self) -> dict[str, Column]:
        """Label of the rows that belong to the family, NULL for others, and their clean value."""
        item = F.col("itemid")
        return {self.label: F.when(self.holds(), item_label(item, dict(self.items))),
                self.value: clean_value(item, F.col("num"), dict(self.items))}


@dataclass(frozen=True)
class Stat:
    """One output column.

    how: ``last`` (value of the latest row, even when NULL), ``marked`` (1 when the latest row carries
    the mark, 0 when not, NULL without a row), ``min``, ``max``, ``sum``, ``median`` (exact; these ignore NULL), ``seen``
    (1 when there is a row).
    """

    name: str
    family: Family
    label: str
    how: str
    mark: str = "abnormal"

    def column(self) -> Column:
        mine, value = f"{self.family.label} = '{self.label}'", self.family.value
        form = {
            "last": f"max_by({value}, CASE WHEN {mine} THEN {PLACE} END)",
            "marked": f"max_by(CASE WHEN mark = '{self.mark}' THEN 1 ELSE 0 END, CASE WHEN {mine} THEN {PLACE} END)",
            "median": f"percentile(CASE WHEN {mine} THEN {value} END, 0.5)",
            "seen": f"max(CASE WHEN {mine} THEN 1 ELSE 0 END)",
        }.get(self.how, f"{self.how}(CASE WHEN {mine} THEN {value} END)")
        return F.expr(form).alias(self.name)


def event(rows: DataFrame, source: str, carry: list[str], **columns: Column | str) -> DataFrame:
    """Rows of one source table in the form of the stream; ``carry`` are the stay's columns."""
    given = {n: F.col(c) if isinstance(c, str) else c for n, c in columns.items()} | {"source": F.lit(source)}
    return rows.select(*carry, *[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in EVENT.items()])


def stream(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def at_same_time(test: Column, value: Column) -> Column:
    """Largest value of the stay's rows of this time for which the test holds."""
    return F.max(F.when(test, value)).over(W.partitionBy(STAY, "charttime"))


def of_stay(value: Column) -> Column:
    """Largest value over the rows of the stay."""
    return F.max(value).over(W.partitionBy(STAY))


def previous_time(value: Column) -> Column:
    """Latest non-NULL value of an earlier time of the stay."""
    micros = F.expr("CAST(CAST(CAST(charttime - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND) AS DECIMAL(18, 6)) * 1000000 AS BIGINT)")
    earlier = W.partitionBy(STAY).orderBy(micros).rangeBetween(W.unboundedPreceding, -1)
    return F.last(value, ignorenulls=True).over(earlier)


def by_stay(events: DataFrame) -> DataFrame:
    """The stream with each stay in one partition: the only shuffle of a pass."""
    return events.repartition(STAY)


def reduced(laid: DataFrame, stats: Iterable[Stat], also: Iterable[Column] = ()) -> DataFrame:
    """One row per stay with a column for each statistic, in one aggregation of a stream laid out ``by_stay``."""
    stats = list(stats)
    families = {s.family.name: s.family for s in stats}
    columns = {name: column for family in families.values() for name, column in family.columns().items()}
    rows = laid.withColumns(columns | {PLACE: F.expr(position("charttime", "event_id"))})
    return rows.groupBy(STAY).agg(*[s.column() for s in stats], *also)


__all__ = ["EVENT", "Family", "PLACE", "STAY", "Stat", "at_same_time", "by_stay", "event", "of_stay", "previous_time", "reduced", "stream"]
