"""Stored layouts of the event tables that let scans and joins skip work.

``store_by_group``: one folder for each concept group of the items, so that a view's scan opens only the folders
of its items. Items that belong to the same groups share a *cell*; the cell is the partition column.

``store_by_stay``: the rows of a key clustered into buckets and sorted in each. As-of matching, previous rows,
carry-forward and numbering by that key then need no exchange: a bucket is a partition already.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CELL = "cell"
#: cell of items in no group
REST = 0


def cells_of(groups: Mapping[str, Iterable[int]]) -> dict[int, int]:
    """Cell of each item: items of the same groups have the same one, from 1 on."""
    belongs: dict[int, set[str]] = {}
    for name, ids in groups.items():
        for i in ids:
            belongs.setdefault(i, set()).add(name)
    kinds = sorted({tuple(sorted(names)) for names in belongs.values()})
    return {i: 1 + kinds.index(tuple(sorted(names))) for i, names in belongs.items()}


def _cell(item: Column, cells: Mapping[int, int]) -> Column:
    case = F.lit(REST)
    for cell in sorted(set(cells.values())):
        case = F.when(item.isin(sorted(i for i, c in cells.items() if c == cell)), cell).otherwise(case)
    return case


def store_by_group(events: DataFrame, path: str, groups: Mapping[str, Iterable[int]], item: str = "itemid", key: str | None = None) -> None:
    """Write events with one folder for each cell; rows of a ``key`` lie together in a folder."""
    celled = events.withColumn(CELL, _cell(F.col(item), cells_of(groups)))
    laid = celled.hint("rebalance", CELL, key) if key else celled.hint("rebalance", CELL)
    laid.write.partitionBy(CELL).parquet(path)


def read_by_group(spark: SparkSession, path: str, groups: Mapping[str, Iterable[int]], ids: Iterable[int], item: str = "itemid") -> DataFrame:
    """Rows of the given items; ``groups`` as they were written. Only the folders of their cells are opened."""
    cells, ids = cells_of(groups), sorted(set(ids))
    wanted = sorted({cells.get(i, REST) for i in ids})
    return spark.read.parquet(path).filter(F.col(CELL).isin(wanted) & F.col(item).isin(ids)).drop(CELL)


def store_by_stay(events: DataFrame, key: str, order: list[str], buckets: int, name: str | None = None) -> DataFrame:
    """The events as a table of ``buckets`` buckets by ``key``, each sorted by (key, order), one file to a bucket.

    The table is in the session's warehouse. Rows of NULL keys have a bucket as others do. A key with so many rows that one task
    can't sort them is better left to ``ordered.arrange``.
    """
    table = name or f"events_{uuid.uuid4().hex}"
    laid = events.repartition(buckets, key).sortWithinPartitions(key, *order)
    laid.write.bucketBy(buckets, key).sortBy(key, *order).format("parquet").saveAsTable(table)
    return events.sparkSession.table(table)
