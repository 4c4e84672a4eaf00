"""Language of texts by bit-sliced n-gram filters.

*N-grams* are runs of ``SIZES`` bytes of a text's words (letters of A-Z lower-cased, and all bytes
above 127), each word behind one space, the text closed by one.

*Learning.* Of each language at most ``SAMPLE`` different texts are learned from, those with the smallest
hashes. An n-gram belongs to a language when ``LEAST`` or more of its texts hold it and
their share is at least ``SHARE`` of the highest share that any language has. So a name or a
borrowed word in a few texts doesn't make an n-gram common to all.

*Filters.* All languages' Bloom filters lie side by side in one table of ``ROWS`` rows, one bit of a row
for each language: an n-gram's ``PROBES`` rows, combined by AND, are the languages that
contain it. Its size depends on the number of languages alone, whatever is learned. The bits are combined by OR in Spark;
the driver gets the table in slices, 2 MB for up to eight languages.

*Deciding.* Each language's hits in a text are counted. Of ``n`` n-grams a filter with a share ``f`` of
false positives (the filled part of its bits to the power ``PROBES``) hits ``f`` of those it doesn't
hold, so the share it holds is ``(hits / n - f) / (1 - f)``. The largest share decides, then the
more frequent language, then the name. The score is that share over the sum of all.

NULL texts and texts without a letter are ``und``, with score 1; if nothing could be learned,
all are, with score 0. A text none of whose n-grams is known gets the most frequent language and its share of the
texts. NULL languages are not learned from. Rows that repeat an id are learned from and decided each. Texts are
read whole, in chunks; more than ``LANGUAGES`` languages raise an error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import written
from .words import LOWER, chunks, mix, signed

SIZES = (3, 4, 5)
SAMPLE, LEAST, SHARE = 2_000, 2, 0.25
ROWS, PROBES = 1 << 21, 3
LANGUAGES = 4_096
UNKNOWN = "und"
#: rows of the table in a slice that goes to the driver
SLICE = 1 << 15

_ALL = np.arange(256)
_LETTERS = ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)


def held_out(id_col: str) -> Column:
    """Rows that are not learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each n-gram, its text) of the texts in one chunk; texts in order within each size."""
    data = LOWER[data]
    mark = _LETTERS[data]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begins = mark.copy()
    begins[1:] &= ~mark[:-1]
    begins[inner] = mark[inner]
    first = np.flatnonzero(begins)
    # a word moves on by one place for itself and each word before it
    at = np.flatnonzero(mark)
    stream = np.full(len(at) + len(first) + 1, 32, np.uint64)
    stream[np.arange(len(at)) + np.cumsum(begins[at])] = data[at]
    words = np.searchsorted(first, bounds)
    letters = np.concatenate([[0], np.cumsum(mark)])[bounds]
    edge = letters + words  # the place of each text's first space
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(edge))
    ends = edge[1:][text]
    value, found, texts = stream.copy(), [], []
    for n in range(2, max(SIZES) + 1):
        value = value[:-1] + (stream[n - 1 :] << np.uint64(8 * (n - 1))) if len(value) > 1 else value[:0]
        if n in SIZES:
            inside = np.arange(len(value)) + n - 1 <= ends[: len(value)]
            found.append(mix(value[inside] + np.uint64(n << 56)))
            texts.append(text[: len(value)][inside])
    return np.concatenate(found), np.concatenate(texts)


def probes(hashes: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """Rows of the table for each hash, one array for each probe."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    at = hashes
    for _ in range(PROBES):
        yield (at & np.uint64(rows - 1)).view(np.int64)
        at = at + step


def width(languages: int) -> int:
    """Bytes of a row: 1, 2, 4, or full words of 8."""
    for n in (1, 2, 4):
        if languages <= 8 * n:
            return n
    return -(-languages // 64) * 8


@dataclass
class Filters:
    """All languages' filters: ``table[row, word]`` has a bit for each language; names in order of frequency."""

    names: list[str]
    prior: np.ndarray
    table: np.ndarray

    def __post_init__(self):
        self.bits = self.table.itemsize * 8
        filled = np.array([np.mean((self.table[:, i // self.bits] >> (i % self.bits)) & 1) for i in range(len(self.names))])
        self.wrong = filled**PROBES

    def containing(self, hashes: np.ndarray) -> np.ndarray:
        """Masks of the languages that contain each n-gram."""
        found = None
        for at in probes(hashes, len(self.table)):
            found = self.table[at] if found is None else found & self.table[at]
        return found

    def shares(self, hashes: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams of each text, corrected share of each language in it)."""
        count = np.bincount(text, minlength=texts)
        mask = self.containing(hashes)
        shares = np.zeros((texts, len(self.names)))
        for i, wrong in enumerate(self.wrong):
            if wrong < 1:
                hits = np.bincount(text, (mask[:, i // self.bits] >> (i % self.bits)) & 1, texts)
                shares[:, i] = np.maximum((hits / np.maximum(count, 1) - wrong) / (1 - wrong), 0)
        return count, shares

    def decide(self, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score) of each text."""
        total, best = shares.sum(1), np.argmax(np.round(shares, 12), axis=1)
        top = shares[np.arange(len(shares)), best]
        known = total > 0
        return np.where(known, best, 0), np.where(known, top / np.where(known, total, 1), self.prior[0])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, language, texts that hold it), summed within a chunk."""
    for batch in batches:
        languages = np.asarray(batch.column(0)).astype(np.int64)
        for at, to, data, bounds in chunks(batch.column(1)):
            found, text = grams(data, bounds)
            order = np.lexsort((text, found))
            found, text = found[order], text[order]
            new = np.ones(len(found), bool)
            new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
            found, of = found[new], languages[at:to][text[new]]
            order = np.lexsort((of, found))
            found, of = found[order], of[order]
            first = np.ones(len(found), bool)
            first[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
            starts = np.flatnonzero(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(found[starts])), pa.array(of[starts], pa.int32()), pa.array(np.diff(starts, append=len(found)))],
                ["gram", "language", "texts"])


def _placed(rows: int):
    """(row, bit of a language) for each probe of each n-gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, of = (np.asarray(batch.column(i)) for i in (0, 1))
            for at in probes(np.ascontiguousarray(found).view(np.uint64), rows):
                yield pa.RecordBatch.from_arrays([
                    pa.array(at), pa.array(of // 32, pa.int32()), pa.array(np.int64(1) << (of % 32).astype(np.int64))], ["row", "word", "bits"])
    return run


def _sliced(per_row: int):
    """One slice of the table as bytes, little-endian."""
    def run(rows: pa.Table) -> pa.Table:
        number = rows["slice"][0].as_py()
        words = np.zeros((SLICE, -(-per_row // 4)), "<u4")
        words[np.asarray(rows["row"]) % SLICE, np.asarray(rows["word"])] = np.asarray(rows["bits"])
        data = words.view(np.uint8).reshape(SLICE, -1)[:, :per_row].tobytes()
        return pa.table({"slice": pa.array([number], pa.int64()), "data": pa.array([data], pa.binary())})
    return run


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, rows: int = ROWS) -> Filters | None:
    """Filters of the languages of ``docs``; None without a text and a language."""
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = known.filter("lang IS NOT NULL AND text IS NOT NULL").withColumn("_hash", F.xxhash64("text"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("_hash").alias("texts"))
    counts = counts.limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return None
    counts = sorted(counts, key=lambda r: (-r["n"], r["lang"]))
    spark = docs.sparkSession
    listed = spark.createDataFrame([(r["lang"], i, float(r["texts"])) for i, r in enumerate(counts)], "lang string, language int, texts double")
    place = F.col("_hash") / float(1 << 64) + 0.5
    likely = place * F.col("texts") < 1.25 * sample + 100  # a few more than the sample
    several = known.join(F.broadcast(listed), "lang").filter(likely).dropDuplicates(["language", "_hash"])
    order = Window.partitionBy("language").orderBy("_hash")
    chosen = several.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= sample)
    chosen = written(chosen.select("language", "text").repartition(max(1, min(64, len(counts) * sample // 500))), "texts")
    sizes = chosen.groupBy("language").agg(F.count("*").alias("of"))
    found = chosen.mapInArrow(_counted, "gram long, language int, texts long")
    found = found.groupBy("gram", "language").agg(F.sum("texts").alias("texts")).join(F.broadcast(sizes), "language")
    found = found.withColumn("share", F.col("texts") / F.col("of"))
    found = found.withColumn("_top", F.max("share").over(Window.partitionBy("gram")))
    member = (F.col("texts") >= F.least(F.lit(LEAST), F.col("of"))) & (F.col("share") >= SHARE * F.col("_top"))
    placed = found.filter(member).select("gram", "language").mapInArrow(_placed(rows), "row long, word int, bits long")
    placed = placed.groupBy("row", "word").agg(F.bit_or("bits").alias("bits"))
    per_row = width(len(counts))
    slices = placed.withColumn("slice", F.floor(F.col("row") / SLICE)).groupBy("slice").applyInArrow(_sliced(per_row), "slice long, data binary")
    kind = np.dtype(f"<u{min(per_row, 8)}")
    table = np.zeros((rows, max(1, per_row // 8)), kind)
    for piece in slices.toLocalIterator():
        at = piece["slice"] * SLICE
        part = np.frombuffer(piece["data"], kind).reshape(SLICE, -1)
        table[at : at + SLICE] = part[: rows - at]
    prior = np.array([r["n"] for r in counts]) / sum(r["n"] for r in counts)
    return Filters([r["lang"] for r in counts], prior, table)


def _decided(filters: Filters):
    names = np.array([*filters.names], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = np.asarray(batch.column(2).fill_null(False).to_numpy(zero_copy_only=False), bool)
            for at, to, data, bounds in chunks(batch.column(1)):
                count, shares = filters.shares(*grams(data, bounds), to - at)
                best, score = filters.decide(shares)
                some = lettered[at:to]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, to - at), batch.column(3).slice(at, to - at),
                    pa.array(np.where(some, names[best], UNKNOWN), pa.string()), pa.array(np.where(some, score, 1.0)),
                    pa.array(count)], ["doc_id", "held_out", "lang_pred", "score", "n_grams"])
    return run


def identify(docs: DataFrame, filters: Filters | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_grams) for every document."""
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"), held_out(id_col).alias("held_out"))
    if filters is None:
        return texts.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_grams"))
    return texts.mapInArrow(_decided(filters), "doc_id long, held_out boolean, lang_pred string, score double, n_grams long")


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              sample: int = SAMPLE) -> DataFrame:
    """``identify`` with filters learned from the rows of ``docs`` that are not held out."""
    learned = learn(docs.filter(~held_out(id_col)), text_col, lang_col, sample)
    return identify(docs, learned, id_col, text_col)
