"""Consistent sharding through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size: an offset and a step from the hash of its name. Shards take turns, each
claiming the first slot of its order that is still free, until the table is full. So shards have
slots in proportion to their weights (their turns), to within one turn, and when a
shard leaves, few slots of the others move.

The table has ``size`` rows whatever the data: the smallest prime of ``PER_SHARD`` slots for each shard or more. It is made
once, turn by turn, and joined to the rows as a broadcast; placing a row is one
hash and one lookup. Rows are not shuffled to be placed.

A NULL key is placed like the text ``NULL_KEY``; equal keys go to one shard, so repeated rows stay together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PER_SHARD = 100
NULL_KEY = "\x00null"
SHARDS = tuple(f"shard-{i:02d}" for i in range(64))


def _number(text: str, part: int) -> int:
    """Eight hex digits of the MD5, from digit ``8 * part``."""
    return int(hashlib.md5(text.encode()).hexdigest()[8 * part : 8 * part + 8], 16)


def prime_from(n: int) -> int:
    """The smallest prime of ``n`` or more."""
    while n < 2 or any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def lookup_table(shards: Sequence[str], size: int | None = None, weights: Sequence[int] | None = None) -> list[int]:
    """For each slot, the number of the shard that claimed it."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need different names, and there must be one")
    weights = list(weights or [1] * len(shards))
    if len(weights) != len(shards) or min(weights) < 0 or not sum(weights):
        raise ValueError("one weight for each shard, none negative, one positive")
    size = prime_from(size or PER_SHARD * len(shards))
    at = [_number(s, 0) % size for s in shards]
    step = [_number(s, 1) % (size - 1) + 1 for s in shards]
    table = [-1] * size
    free = size
    while True:
        for i, turns in enumerate(weights):
            for _ in range(turns):
                while table[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % size
                table[at[i]] = i
                free -= 1
                if not free:
                    return table


def slot(key: Column, size: int) -> Column:
    """The slot of a key: the first 60 bits of the MD5 of its text."""
    text = F.coalesce(key.cast("string"), F.lit(NULL_KEY))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % size


def table_frame(spark: SparkSession, shards: Sequence[str], table: Sequence[int]) -> DataFrame:
    """(slot, shard) of the whole table, from two literals."""
    claimed = F.split(F.lit(",".join(map(str, table))), ",")
    names = F.array(*[F.lit(s) for s in shards])
    rows = spark.range(1).select(F.posexplode(claimed).alias("slot", "_shard"))
    return rows.select(F.col("slot").cast("long").alias("slot"), F.get(names, F.col("_shard").cast("int")).alias("shard"))


def place(rows: DataFrame, key_col: str, shards: Sequence[str] = SHARDS, size: int | None = None,
          weights: Sequence[int] | None = None) -> DataFrame:
    """All rows and columns of ``rows`` plus ``slot`` and ``shard`` (replaced if there are such)."""
    table = lookup_table(shards, size, weights)
    frame = F.broadcast(table_frame(rows.sparkSession, shards, table))  # len(table) rows
    return rows.withColumn("slot", slot(F.col(key_col), len(table))).drop("shard").join(frame, "slot").select(
        *[c for c in rows.columns if c not in ("slot", "shard")], "slot", "shard")


def write_shards(rows: DataFrame, key_col: str, path: str, shards: Sequence[str] = SHARDS, rows_per_file: int = 1_000_000) -> None:
    """Write one folder per shard; a shard with many rows is spread over tasks and files."""
    placed = place(rows, key_col, shards)
    placed.hint("rebalance", "shard").write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: Sequence[str] = SHARDS) -> DataFrame:
    """(doc_id, n_bytes, slot, shard) for every row."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return place(slim, "doc_id", shards)


_SIZE = prime_from(PER_SHARD * len(SHARDS))
ORACLE = f"""
WITH RECURSIVE prefer AS MATERIALIZED (
  SELECT i, list((('0x' || substr(md5(shard), 1, 8))::BIGINT
    + j * (('0x' || substr(md5(shard), 9, 8))::BIGINT % {_SIZE - 1} + 1)) % {_SIZE} ORDER BY j) AS slots
  FROM (SELECT i, format('shard-{{:02d}}', i) AS shard FROM range({len(SHARDS)}) AS r(i)), range({_SIZE}) AS q(j)
  GROUP BY i),
turns AS (
  SELECT 0 AS turn, -1::BIGINT AS slot, list_resize([]::BOOLEAN[], {_SIZE}, false) AS taken
  UNION ALL
  SELECT turn + 1, picked, list_concat(list_concat(taken[:picked], [true]), taken[picked + 2:])
  FROM (
    SELECT turn, taken, list_filter(slots, lambda s: NOT taken[s + 1])[1] AS picked
    FROM turns JOIN prefer ON prefer.i = turns.turn % {len(SHARDS)} WHERE turn < {_SIZE})),
claimed AS (SELECT slot, format('shard-{{:02d}}', (turn - 1) % {len(SHARDS)}) AS shard FROM turns WHERE turn > 0),
rows AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0) || 'null')), 1, 15))::BIGINT % {_SIZE} AS slot
  FROM documents)
SELECT doc_id, n_bytes, slot, shard FROM rows JOIN claimed USING (slot)
"""
