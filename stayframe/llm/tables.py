"""Small helpers the training-data operators share."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.scale import shared_folder, written
from ..sources import files
from .words import tidy_memory

#: rows of two or three longs that one broadcast may hold (about 25 MB)
BROADCAST_KEYS = 1_000_000


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` does, once per application."""
    _ship(spark.sparkContext, spark.sparkContext.applicationId)


@cache
def _ship(context, application: str) -> None:
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, str(source.relative_to(root.parent)))
    handle, path = tempfile.mkstemp(suffix=".zip", prefix=f"{root.name}-")
    with os.fdopen(handle, "wb") as target:
        target.write(packed.getvalue())
    context.addPyFile(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(keys: DataFrame) -> bool:
    """Whether a written table of keys may be broadcast: counted, not guessed."""
    return keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, key, text): the id and a hash that tells rows with one id but other texts apart."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc"),
        F.xxhash64(F.col(text_col)).alias("key"),
        F.col(text_col).alias("text"),
    )


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the user's rows do not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"{wanted}_"
    return wanted


def forget(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more. Folders outside the shared one are left alone."""
    for table in tables:
        shared = shared_folder(table.sparkSession).split(":", 1)[-1].lstrip("/")
        folders = {path.rsplit("/", 1)[0] for path in table.inputFiles()}
        for folder in folders:
            if folder.split(":", 1)[-1].lstrip("/").startswith(f"{shared}/"):
                files.delete(table.sparkSession, folder)


def partitions(rows: int, per_task: int) -> int:
    return max(1, -(-rows // per_task))


__all__ = ["BROADCAST_KEYS", "forget", "free_name", "keyed", "partitions", "read", "ship_code", "small", "tidy_memory", "written"]
