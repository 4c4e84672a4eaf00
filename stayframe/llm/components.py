"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import partitions, written

MAX_ROUNDS = 60
#: links (16 bytes each) that one task joins up at a time
TASK_LINKS = 1_000_000


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of the component of each) by hooking and pointer jumping."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[one], label[two])
        before = label.copy()
        for end in (one, two):
            np.minimum.at(label, before[end], least)
            np.minimum.at(label, end, least)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            return nodes, nodes[label]


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: each node to the smallest it reaches by them."""
    table = pa.Table.from_batches(list(batches), pa.schema([("v", pa.int64()), ("u", pa.int64())]))
    nodes, component = least_reachable(np.asarray(table["v"]), np.asarray(table["u"]))
    other = nodes != component
    yield pa.RecordBatch.from_arrays([pa.array(nodes[other], pa.int64()), pa.array(component[other], pa.int64())], ["v", "u"])


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; component is its smallest node.

    First each task joins up ``task_links`` links of its own, whatever they are, which leaves one
    for a node at most. Then, until nothing changes,
    alternating large-star and small-star steps: every node hands its larger
    neighbours, then its smaller ones, the smallest node it knows. Minima are
    combined before the shuffle and no neighbourhood is gathered, so one node may
    have links to a third of all. Each round is written to the shared folder.
    Ends after O(log^2 n) rounds; NULL ends and loops are left out.
    """
    edges = written(links.filter("a <> b").select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links")
    tasks = partitions(edges.count(), task_links)
    edges = written(edges.repartition(tasks).mapInArrow(_joined_up, "v long, u long"), "forest")
    before = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.filter("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.filter("v <> u").distinct()
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lowest, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        small = small.unionByName(lowest.select("v", F.col("m").alias("u"))).filter("v <> u").distinct()
        edges = written(small, "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
        before = now
    raise RuntimeError(f"components: not settled after {MAX_ROUNDS} rounds")
