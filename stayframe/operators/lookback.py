"""Lookback windows: label events, join them to an index time, reduce them.

Windows are closed: index - before <= event <= index.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from stayframe.functions.numeric import first_match
from stayframe.functions.timeutil import hours, position
from stayframe.operators.scale import MEASURE, Sizes, join_cohort, written


@dataclass(frozen=True)
class Item:
    """How one item id is read: concept label, unit rule and plausible range.

    The cleaned value is ``(value - shift) * factor / divisor``; raw values below ``low``
    or above ``high`` become NULL. ``above`` and ``below`` are the strict forms.
    ``otherwise`` is a second rule for values the first one finds implausible.
    """

    label: str
    factor: float = 1.0
    shift: float = 0.0
    divisor: float = 1.0
    low: float | None = None
    high: float | None = None
    above: float | None = None
    below: float | None = None
    otherwise: "Item | None" = None


def labels_of(items: dict[int, Item]) -> list[str]:
    return list(dict.fromkeys(item.label for item in items.values()))


def pick_items(events: DataFrame, ids) -> DataFrame:
    """Rows of the given item ids; the IN list reaches the Parquet scan."""
    return events.filter(F.col("itemid").isin(sorted(ids)))


def item_label(itemid: Column, items: dict[int, Item]) -> Column:
    cases = [
        (itemid.isin([i for i, item in items.items() if item.label == label]), label)
        for label in labels_of(items)
    ]
    return first_match(*cases)


def converted(value: Column, item: Item) -> Column:
    """The value under the item's unit rule, NULL when it is implausible."""
    plausible = F.lit(True)
    if item.low is not None:
        plausible = plausible & (value >= item.low)
    if item.high is not None:
        plausible = plausible & (value <= item.high)
    if item.above is not None:
        plausible = plausible & (value > item.above)
    if item.below is not None:
        plausible = plausible & (value < item.below)
    result = value if item.shift == 0.0 else value - item.shift
    result = result if item.factor == 1.0 else result * item.factor
    result = result if item.divisor == 1.0 else result / item.divisor
    cases = F.when(plausible, result)
    return cases if item.otherwise is None else cases.otherwise(converted(value, item.otherwise))


def clean_value(itemid: Column, value: Column, items: dict[int, Item]) -> Column:
    """Plausible value in the concept's unit, NULL outside the range."""
    rules: dict[Item, list[int]] = {}
    for i, item in items.items():
        rules.setdefault(replace(item, label=""), []).append(i)
    return first_match(*[(itemid.isin(ids), converted(value, rule)) for rule, ids in rules.items()])


def label_items(events: DataFrame, items: dict[int, Item], value: str = "valuenum") -> DataFrame:
    """Keep the dictionary's items, add ``label`` and replace the value by the clean one."""
    itemid = F.col("itemid")
    return (
        pick_items(events, items)
        .withColumn("label", item_label(itemid, items))
        .withColumn(value, clean_value(itemid, F.col(value), items))
    )


def first_event(events: DataFrame, by: str, time: str, name: str,
                where: Column | None = None) -> DataFrame:
    """Earliest time per entity."""
    rows = events if where is None else events.filter(where)
    return rows.groupBy(by).agg(F.min(time).alias(name))


def in_window(event_time: Column, index_time: Column, before_hours: float | None) -> Column:
    test = event_time <= index_time
    if before_hours is not None:
        test = test & (event_time >= index_time - hours(before_hours))
    return test


def lookback(events: DataFrame, cohort: DataFrame, on: list[str], index_time: str,
             event_time: str, before_hours: float | None, sizes: Sizes = MEASURE) -> DataFrame:
    """Events of the cohort inside the window before the index time."""
    window = in_window(F.col(event_time), F.col(index_time), before_hours)
    return join_cohort(events, cohort, on, window, sizes)


def lookback_left(events: DataFrame, cohort: DataFrame, on: list[str], index_time: str,
                  event_time: str, before_hours: float | None, key: str,
                  sizes: Sizes = MEASURE) -> DataFrame:
    """As ``lookback``, plus one row with NULL event columns per subject without events.

    Built as matches plus the unmatched cohort rows, so that the event table
    is never the build side of an outer join. The matches are written, so the
    events are scanned once. ``key`` is unique in the cohort.
    """
    found = written(
        lookback(events, cohort, on, index_time, event_time, before_hours, sizes), "matches")
    missing = cohort.join(found.select(key).distinct(), key, "left_anti")
    return found.unionByName(missing, allowMissingColumns=True)


def reduce_labels(events: DataFrame, by: list[str], labels: list[str], how: str,
                  time: str = "charttime", tie: str = "event_id", value: str = "valuenum",
                  label: str = "label", suffix: str = "") -> DataFrame:
    """One row per entity, one column per label, in a single aggregation.

    how: ``last`` keeps the value of the latest row even when it is NULL;
    ``first`` the earliest; ``min``, ``max``, ``sum`` ignore NULL; ``ever`` is
    1 when a known, non-zero value occurred.
    """
    form = {
        "last": "max_by({value}, CASE WHEN {mine} THEN {place} END)",
        "first": "min_by({value}, CASE WHEN {mine} THEN {place} END)",
        "ever": "max(CASE WHEN {mine} AND {value} <> 0 THEN 1 ELSE 0 END)",
    }.get(how, how + "(CASE WHEN {mine} THEN {value} END)")
    columns = [
        F.expr(form.format(value=value, place=position(time, tie), mine=f"{label} = '{name}'"))
        .alias(name.lower() + suffix)
        for name in labels
    ]
    return events.groupBy(*by).agg(*columns)


def last_with_flag(events: DataFrame, by: list[str], labels: list[str], mark: str,
                   time: str = "charttime", tie: str = "event_id", value: str = "valuenum",
                   label: str = "label", also: list[Column] = ()) -> DataFrame:
    """Latest value per label and whether that same row carries the mark.

    ``also`` are further aggregates to take in the same pass.
    """
    place = position(time, tie)
    taken = {"v": value, "f": f"CASE WHEN flag = '{mark}' THEN 1 ELSE 0 END"}
    picked = [
        F.expr(f"max_by({taken[part]}, CASE WHEN {label} = '{name}' THEN {place} END)").alias(f"_{name.lower()}_{part}")
        for name in labels for part in taken
    ]
    last = events.groupBy(*by).agg(*picked, *also)
    kept = [c for c in last.columns if not c.startswith("_")]
    values = [f"_{n.lower()}_v AS {n.lower()}" for n in labels]
    flags = [f"coalesce(_{n.lower()}_f, 0) AS {n.lower()}_abnormal_flg" for n in labels]
    return last.selectExpr(*kept, *values, *flags)


def paired_rows(events: DataFrame, by: list[str], columns: dict[str, Column],
                required: str) -> DataFrame:
    """Put labelled rows of the same key side by side; keep rows with ``required``."""
    aggregates = [F.max(column).alias(name) for name, column in columns.items()]
    return events.groupBy(*by).agg(*aggregates).filter(F.col(required).isNotNull())
