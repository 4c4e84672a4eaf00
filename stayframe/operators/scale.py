"""Scale rules shared by the operators.

* A cohort is written once as a Parquet table in the cluster's shared folder,
  so every reader sees the same rows after an executor is lost and its row
  count is cheap to know.
* A cohort is broadcast only when its joined columns take ``BROADCAST_BYTES`` or less.
  Beyond it the join is a shuffle join: event rows that a Bloom filter of the cohort's keys rules out
  go before it, and a key with more than ``GROUP_ROWS`` event rows is spread over several tasks.
* The largest group of a key is measured before an ordered operator decides
  how to lay out its rows (see ``ordered``).
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayframe.operators.bloom import thinned

BROADCAST_BYTES = 64 << 20
#: bytes of a value of a type; a row has ROW_BYTES besides, and texts are measured
ROW_BYTES, TYPE_BYTES = 16, {"tinyint": 1, "smallint": 2, "int": 4, "boolean": 1, "date": 4, "float": 4}
#: columns of a cohort that joins take along
JOINED = ("subject_id", "hadm_id", "icustay_id", "intime", "outtime", "vent_starttime")
GROUP_ROWS = 2_000_000


@dataclass(frozen=True)
class Sizes:
    """What is known about table sizes; unknown parts are measured when needed.

    ``small_cohort``: the cohort is known to fit (or not fit) a broadcast.
    ``largest``: upper bound on the rows of one group in the event table.
    ``group_limit``: rows of one group that a single task may sort.
    """

    small_cohort: bool | None = None
    largest: int | None = None
    group_limit: int = GROUP_ROWS


MEASURE = Sizes()


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables: ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.conf.get("spark.app.id", ""))


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="stayframe-")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a new Parquet table in the shared folder."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_bytes(df: DataFrame) -> int:
    """Bytes of a table's values: by type, texts as they are. Call it on a written table."""
    fixed, texts = ROW_BYTES, [F.lit(0).cast("long")]
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            texts.append(F.coalesce(F.octet_length(F.col(name)).cast("long"), F.lit(0)))
        elif kind.startswith(("array", "map", "struct")):
            texts.append(F.coalesce(F.octet_length(F.to_json(F.struct(name))).cast("long"), F.lit(0)))
        else:
            fixed += TYPE_BYTES.get(kind, 8)
    row = df.agg(F.count("*").alias("n"), F.sum(sum(texts[1:], texts[0])).alias("texts")).first()
    return row["n"] * fixed + (row["texts"] or 0)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the table's values take ``limit`` bytes or less. Call it on a written table."""
    return broadcast_bytes(df) <= limit


def largest_group(df: DataFrame, by: list[str]) -> tuple[int, int]:
    """(rows of the largest key, rows in all); counts are combined map-side."""
    return largest_of((df, by))


def largest_of(*groups: tuple[DataFrame, list[str]]) -> tuple[int, int]:
    """(rows of the largest key, rows in all) over several tables, in one job.

    Keys are compared by hash; a collision can only raise the bound.
    """
    keys = [
        df.select(F.lit(i).alias("_table"), F.xxhash64(*by).alias("_key"))
        for i, (df, by) in enumerate(groups)
    ]
    rows = keys[0]
    for part in keys[1:]:
        rows = rows.unionByName(part)
    counts = rows.groupBy("_table", "_key").count()
    row = counts.agg(F.max("count").alias("top"), F.sum("count").alias("total")).first()
    return (row["top"] or 0, row["total"] or 0)


def in_parallel(jobs: list, workers: int = 4) -> list:
    """Results of independent Spark jobs submitted from several driver threads."""
    with ThreadPoolExecutor(workers) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def with_largest(sizes: Sizes, *groups: tuple[DataFrame, list[str]]) -> Sizes:
    """The sizes with the group bound filled in from the given tables, unless known."""
    if sizes.largest is not None:
        return sizes
    return replace(sizes, largest=largest_of(*groups)[0])


def with_cohort(sizes: Sizes, cohort: DataFrame) -> Sizes:
    """The sizes with the broadcast check of a written cohort done, unless known."""
    if sizes.small_cohort is not None:
        return sizes
    joined = [c for c in JOINED if c in cohort.columns] or cohort.columns
    return replace(sizes, small_cohort=fits_broadcast(cohort.select(*joined)))


def fits_task(df: DataFrame, by: list[str], sizes: Sizes = MEASURE) -> bool:
    """Whether one task can hold any group; measured when the known bound is too high."""
    if sizes.largest is not None and sizes.largest <= sizes.group_limit:
        return True
    return largest_group(df, by)[0] <= sizes.group_limit


def join_cohort(events: DataFrame, cohort: DataFrame, on: list[str],
                residual: Column | None = None, sizes: Sizes = MEASURE) -> DataFrame:
    """Inner join of a large event table with a written, narrow cohort.

    The events stay where they are when the cohort is small enough to
    broadcast. Otherwise it is a shuffle join, with the hot keys spread.
    Columns besides the keys must have different names on the two sides.
    """
    if with_cohort(sizes, cohort).small_cohort:
        joined = events.join(F.broadcast(cohort), on)
    else:
        joined = spread_join(thinned(events, cohort, on, cohort.count()), cohort, on, sizes.group_limit)
    return joined if residual is None else joined.filter(residual)


def spread_join(events: DataFrame, cohort: DataFrame, on: list[str], limit: int) -> DataFrame:
    """Shuffle join in which a key with many event rows is split over several tasks.

    Keys above the limit are counted out first. Their events get a random salt,
    one per ``limit`` rows and fixed by writing them, so that equal rows are spread too; their
    cohort rows are repeated per salt. The table of hot keys is broadcast
    while it takes ``BROADCAST_BYTES`` or less and joined by shuffle beyond.
    """
    counts = events.groupBy(*on).count()
    if (counts.agg(F.max("count").alias("top")).first()["top"] or 0) <= limit:
        return events.join(cohort, on)
    hot = counts.filter(F.col("count") > limit).select(
        *on, F.ceil(F.col("count") / limit).cast("int").alias("_salts"))
    hot = written(hot, "hot")
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    spread = F.floor(F.rand() * F.col("_salts")).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    left = written(events.join(hot, on, "left").withColumn("_salt", F.coalesce(spread, F.lit(0))), "salted")
    right = cohort.join(hot, on, "left").withColumn("_salt", copies)
    joined = left.drop("_salts").join(right.drop("_salts"), [*on, "_salt"])
    return joined.drop("_salt")


def assert_unique(df: DataFrame, key: str, name: str) -> None:
    """Fail when a view has two rows for one key."""
    if not df.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"{name}: more than one row for the same {key}")
