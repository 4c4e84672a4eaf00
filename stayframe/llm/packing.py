"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Documents become token ids plus an end id; longer ones are cut into full pieces,
of which only the first may be shorter. Packing is the global best fit decreasing
over all pieces, not one per partition, and needs no piece on the driver:

* Best fit decreasing depends on piece lengths alone, and there are at most
  ``capacity`` of them. Their counts, one row for each length, are all the driver gets.
* ``plan`` replays the method on *runs* of equal bins: a segment tree over the
  remaining capacities finds the tightest open bin in logarithmic time, and a run
  of equal pieces goes into a run of equal bins at once. A run is halved with
  every length that enters it, so the plan has at most 11 rows for each of the
  6,144 runs that 2,048 lengths can make.
* Pieces are numbered within their length by a window over (length, salt) and the
  counts of the salts before, so a length that a third of the pieces have is
  spread over tasks. The plan turns (length, number) into sequence and offset.

NULL is an empty text, which is the end id alone. Rows that repeat an id are
separate documents; pieces of one id and number are placed in the order of their checksums, and those equal in
that too are interchangeable. A text is encoded whole, however long. Extra columns are not read.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from .tables import tidy_memory, written
from .words import chunks

CAPACITY, END = 2048, 0
NUMBERED_ROWS = 500_000


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBPE:
    """Ids of a byte-level BPE file of ``tokenizers``; texts of special tokens are ordinary.

    The file's vocabulary runs in the faster ``tiktoken`` encoder, which gives the
    same ids (see the tests).
    """

    def __init__(self, path: str):
        self.ranks = self.vocabulary(path)
        self.encoder = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    @staticmethod
    def vocabulary(path: str) -> dict[bytes, int]:
        """Bytes and id of each token that is not a special one."""
        table = _byte_of()
        known = Tokenizer.from_file(path).get_vocab()
        return {bytes(table[c] for c in token): i for token, i in known.items() if not token.startswith("<|")}

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        ids = array("I", self.encoder.encode_ordinary(text))
        if sys.byteorder != "little":
            ids.byteswap()
        return ids.tobytes()


@cache
def _encoder(path: str) -> ByteBPE:
    return ByteBPE(path)


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    if length <= capacity:
        return [(0, length)]
    short = length % capacity
    return [(0, short)] * (short > 0) + [(start, capacity) for start in range(short, length, capacity)]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about a chunk of text each."""
    for batch in batches:
        for at, to, _, _ in chunks(batch.column(1)):
            yield batch.slice(at, to - at)


def _pieces(path: str, capacity: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tail = _encoder(path), np.array([end], "<u4").tobytes()
        for batch in _parts(batches):
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = (encoder.ids(text) if text else b"") + tail
                for k, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((i, k, start, length, zlib.crc32(part), part if with_ids else None))
            at, *columns = list(zip(*rows)) or [()] * 6
            out = [batch.column(0).take(pa.array(at, pa.int64()))]
            out += [pa.array(c, k) for c, k in zip(columns, [pa.int32(), *[pa.int64()] * 3, pa.binary()])]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
        tidy_memory()
    return run


class OpenBins:
    """Runs of equal open bins in a segment tree over their remaining capacities."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.open = np.zeros(2 * self.leaves, np.int64)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, left: int, first: int, count: int) -> None:
        if left and count:
            self.runs[left].append((first, count))
            self._change(left, 1)

    def pop(self, left: int) -> tuple[int, int]:
        self._change(left, -1)
        return self.runs[left].pop()

    def _change(self, left: int, by: int) -> None:
        node = left + self.leaves
        while node:
            self.open[node] += by
            node >>= 1

    def tightest(self, length: int) -> int:
        """The smallest remaining capacity of ``length`` or more that an open bin has; 0 if none."""
        node = length + self.leaves
        if self.open[node]:
            return length
        while node > 1 and (node & 1 or not self.open[node + 1]):
            node >>= 1
        if node <= 1:
            return 0
        node += 1
        while node < self.leaves:
            node = 2 * node + (not self.open[2 * node])
        return node - self.leaves


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing over ``counts`` pieces of each length.

    Rows (length, from, each, sequence, offset): pieces of that length numbered
    ``from`` and up go ``each`` to a sequence, to ``sequence`` and the ones after it, from ``offset`` on.
    """
    bins, rows, made = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            left = bins.tightest(length)
            if left:
                first, count = bins.pop(left)
            else:
                left, first = capacity, made
                count = -(-(total - done) // (capacity // length))
                made += count
            each = left // length
            full, rest = divmod(min(total - done, count * each), each)
            rows.append((length, done, each, first, capacity - left))
            bins.add(left - each * length, first, full)
            if rest:
                bins.add(left - rest * length, first + full, 1)
            used = full + (rest > 0)
            bins.add(left, first + used, count - used)
            done += full * each + rest
    return rows


def _place(rows: list[tuple[int, int, int, int, int]]):
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 44) + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (np.asarray(batch.column(batch.schema.get_field_index(n))).astype(np.int64) for n in ("length", "number"))
            _, low, each, first, offset = table[np.searchsorted(keys, (length << 44) + number, "right") - 1].T
            sequence, slot = np.divmod(number - low, np.maximum(each, 1))
            kept = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(n)) for n in kept] + [pa.array(first + sequence), pa.array(offset + slot * length)],
                [*kept, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END,
         vocabulary: str | None = None, with_ids: bool = False, numbered_rows: int = NUMBERED_ROWS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece; with ``ids`` if asked for.

    ``vocabulary``: path of a byte-level BPE file on every executor.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    pieces = texts.mapInArrow(_pieces(str(vocabulary), capacity, end, with_ids), shape)
    pieces = written(pieces if with_ids else pieces.drop("ids"), "pieces")
    lengths = written(pieces.groupBy("length").agg(F.count("*").alias("pieces")), "lengths")
    rows = plan({r["length"]: r["pieces"] for r in lengths.collect()}, capacity)  # ``capacity`` rows at most
    salts = lengths.select("length", F.ceil(F.col("pieces") / numbered_rows).cast("int").alias("_salts"))
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "start"), F.col("_salts")).cast("int")
    salted = pieces.join(F.broadcast(salts), "length").withColumn("_salt", salt).drop("_salts")
    before = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = written(before.select("length", "_salt", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before")), "before")
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = salted.withColumn("_row", F.row_number().over(order) - 1).join(before, ["length", "_salt"])
    numbered = numbered.select(*pieces.columns, (F.col("_row") + F.col("_before")).alias("number"))
    shape = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema), "sequence_id long", "offset long"])
    return numbered.mapInArrow(_place(rows), shape)
