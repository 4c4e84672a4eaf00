"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

*Features* are all lower-cased words of the sample, and those word beginnings (5 to 8 bytes) that tell the
labels apart (chi-squared of ``CHI_SQUARED`` or more), so that the forms of one stem meet. Document frequencies are counted
over all documents. Weights are (1 + ln tf) * idf, times the root of chi-squared where that is ``CHI_SQUARED`` or more,
scaled to length 1. No feature of the sample is left out: a text that shares any word with it has neighbours, and a
copy of an example finds that example.

*Search.* The sample is a block-max inverted index: examples in blocks of
``BLOCK``, a posting list for each feature cut at block borders, and the largest weight
in each block. A text's blocks are visited in the order of their upper bounds, until the
``NEIGHBOURS``-th best cosine found is above the next bound: the result is exact.

*Score.* Neighbours vote with weight 1 / (distance + ``SOFTEN``), distance = 1 - cosine. The
vote becomes a probability by a logistic curve fitted on the sample, each example searched without
itself. Texts without any word of the sample, the empty and NULL ones among them, get the rate of
label 1 among such examples. The evidence is the ids of the neighbours with label 1, best first.

``SAMPLE`` bounds the labelled rows learned from (the smallest hashes of their ids); everything else
covers all documents. NULL labels are not learned from; a document with several labels has the
largest. Rows that repeat an id are scored each. Ties in cosine go to the smaller id. Texts are read whole, in chunks. All
columns of the user's rows come back as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from .tables import free_name, tidy_memory, written
from .words import PLAIN, chunks, signed, words_of

SAMPLE, CHI_SQUARED = 2_500, 30.0
BLOCK, NEIGHBOURS, SOFTEN = 128, 25, 0.05
#: share of the examples (one in so many) from which on a list is long; texts searched at a time
LONG, QUERIES = 16, 256
PREFIXES = (5, 6, 7, 8)
#: bytes of text whose features are found at a time
CHUNK = 1 << 18
#: tasks that read the sample
SPREAD = 16


def held_out(id_col: str) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0. A NULL id is an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc, label, text): at most ``rows`` labelled documents that are not held out, by the hash of their ids."""
    chosen = labels.select(F.col(id_col).cast("long").alias("doc"), F.col(label).cast("int").alias("label"))
    chosen = chosen.filter("doc is not null and label is not null").filter(~held_out("doc"))
    chosen = chosen.groupBy("doc").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc"), "doc").limit(rows)
    chosen = written(chosen, "chosen")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return written(texts.join(F.broadcast(chosen), "doc").dropDuplicates(["doc"]), "sample")


@dataclass
class Known:
    """Hashes of the features, sorted: words first, then word beginnings; features are numbered in this order."""

    words: np.ndarray
    beginnings: np.ndarray

    def __len__(self) -> int:
        return len(self.words) + len(self.beginnings)


def _places(table: np.ndarray, found: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the sorted table, owners) of what stands in it."""
    if not len(table):
        return np.zeros(0, np.int64), owner[:0]
    at = np.minimum(np.searchsorted(table, found), len(table) - 1)
    kept = np.flatnonzero(table[at] == found)
    return at[kept], owner[kept]


def _feature_counts(texts: pa.Array, known: Known | None = None):
    """Per text (features, counts, which of them are words): hashes, or places in ``known``."""
    for _, _, data, bounds in chunks(texts, CHUNK):
        words = words_of(data, bounds, PLAIN)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(words.first))
        found, owner = [], []
        for size in PREFIXES:
            longer = np.flatnonzero(words.end - words.start > size)
            found.append(words.ranges.hash(words.start[longer], words.start[longer] + size, 31))
            owner.append(text[longer])
        found, owner = np.concatenate(found), np.concatenate(owner)
        whole = words.hash
        if known is not None:
            whole, text = _places(known.words, whole, text)
            found, owner = _places(known.beginnings, found, owner)
            found = found + len(known.words)
        is_word = np.repeat([True, False], [len(whole), len(found)])
        found, owner = np.concatenate([whole, found]), np.concatenate([text, owner])
        order = np.lexsort((found, owner))
        found, owner, is_word = found[order], owner[order], is_word[order]
        new = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])]) if len(found) else np.zeros(0, np.int64)
        count = np.diff(np.r_[new, len(found)])
        found, is_word, edges = found[new], is_word[new], np.searchsorted(owner[new], np.arange(len(bounds)))
        for low, high in zip(edges[:-1], edges[1:]):
            yield found[low:high], count[low:high], is_word[low:high]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, feature, whether it is a word) for each feature of each text."""
    for batch in batches:
        labels = batch.column(0).to_pylist()
        for label, (found, _, is_word) in zip(labels, _feature_counts(batch.column(1))):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), label, np.int32)), pa.array(signed(found)), pa.array(is_word)], ["label", "feature", "word"])


def _known_counts(known: Known):
    """(feature, texts that hold it) of a task's texts; -1 counts the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(len(known), np.int64), 0
        for batch in batches:
            for found, _, _ in _feature_counts(batch.column(0), known):
                total[found] += 1
            texts += batch.num_rows
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, held]), pa.array(np.r_[texts, total[held]])], ["feature", "texts"])
        tidy_memory()
    return run


@dataclass
class BlockMaxIndex:
    """Labelled examples by feature.

    Cell ``c`` is a feature in a block of examples: its postings are ``post[c]:post[c + 1]``, its largest weight is
    ``bound[c]``; the cells of feature ``f`` are ``cut[f]:cut[f + 1]``. Lists of a ``LONG``-th of the examples and more are
    rows of the matrix ``long`` instead (``row`` is theirs, or -1); for them a block's bound is the largest of its products.
    """

    known: Known
    scale: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    cut: np.ndarray
    block: np.ndarray
    bound: np.ndarray
    post: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    row: np.ndarray
    long: np.ndarray

    @classmethod
    def of(cls, known: Known, scale: np.ndarray, ids: np.ndarray, labels: np.ndarray, first: np.ndarray,
           feature: np.ndarray, weight: np.ndarray) -> BlockMaxIndex:
        """Example ``i`` has the features and weights ``first[i]:first[i + 1]``."""
        size = np.diff(first)
        example = np.repeat(np.arange(len(ids)), size)
        heavy = np.lexsort((weight, example))
        lead = np.full(len(ids), -1, np.int64)
        lead[size > 0] = feature[heavy[first[1:][size > 0] - 1]]
        order = np.lexsort((ids, lead, labels))  # alike examples share blocks, which makes bounds tight
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        example = rank[example]
        holders = np.bincount(feature, minlength=len(known))
        is_long = (holders > 1) & (holders * LONG >= len(ids))
        row = np.where(is_long, np.cumsum(is_long) - 1, -1)
        blocks = -(-len(ids) // BLOCK)
        long = np.zeros((int(is_long.sum()), blocks * BLOCK))
        dense = row[feature] >= 0
        long[row[feature[dense]], example[dense]] = weight[dense]
        feature, weight, example = feature[~dense], weight[~dense], example[~dense]
        by = np.lexsort((example, feature))
        feature, weight, example = feature[by], weight[by], example[by]
        cell = feature * (blocks + 1) + example // BLOCK
        post = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
        bound = np.maximum.reduceat(weight, post) if len(post) else np.zeros(0)
        return cls(known, scale, ids[order], labels[order], np.searchsorted(feature[post], np.arange(len(known) + 1)),
                   (example[post] // BLOCK).astype(np.int32), bound, np.r_[post, len(cell)], example.astype(np.int32), weight, row, long)

    def weights(self, found: np.ndarray, count: np.ndarray) -> np.ndarray:
        return _scaled(found, count, self.scale)

    def search(self, texts: Iterable[tuple], k: int, buts: Iterable[int | None] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(examples, cosines) of the ``k`` best of each text, ties by id; ``buts`` are ids to leave out."""
        buts, texts = iter(buts), iter(texts)
        while some := list(islice(texts, QUERIES)):
            weights = [self.weights(found, count) if len(found) else np.zeros(0) for found, count, _ in some]
            rows = np.zeros((len(some), len(self.long)))
            for i, ((found, _, _), weight) in enumerate(zip(some, weights)):
                at = self.row[found]
                rows[i, at[at >= 0]] = weight[at >= 0]
            for (found, _, _), weight, base in zip(some, weights, rows @ self.long):
                rest = self.row[found] < 0
                yield self._nearest(found[rest], weight[rest], base, k, next(buts, None))

    def _nearest(self, found: np.ndarray, weight: np.ndarray, base: np.ndarray, k: int, but: int | None) -> tuple[np.ndarray, np.ndarray]:
        cells, of = _ranges(self.cut[found], self.cut[found + 1])
        block, by_cell = self.block[cells], weight[of]
        blocks = len(base) // BLOCK
        bounds = np.bincount(block, by_cell * self.bound[cells], blocks) + base.reshape(blocks, BLOCK).max(1, initial=0)
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        best, cosine, at, step = np.zeros(0, np.int64), np.zeros(0), 0, max(4, blocks // 3)
        while at < len(order) and (len(best) < k or bounds[order[at]] >= cosine[-1] - 1e-9):
            visited = order[at : at + step]
            at, step = at + step, step * 2
            mine = np.zeros(blocks, bool)
            mine[visited] = True
            chosen = mine[block]
            place, which = _ranges(self.post[cells[chosen]], self.post[cells[chosen] + 1])
            part = np.bincount(self.example[place], by_cell[chosen][which] * self.weight[place], len(base)) + base
            inside = (visited[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            hit = inside[part[inside] > 0]
            if but is not None:
                hit = hit[self.ids[hit] != but]
            value = np.round(part[hit], 9)
            if len(value) > 4 * k:  # most are far from the best
                high = value >= np.partition(value, len(value) - k)[len(value) - k]
                hit, value = hit[high], value[high]
            best, cosine = np.concatenate([best, hit]), np.concatenate([cosine, value])
            top = np.lexsort((self.ids[best], -cosine))[:k]
            best, cosine = best[top], cosine[top]
        return best, cosine

    def vote(self, best: np.ndarray, cosine: np.ndarray) -> float:
        weight = 1 / (1 - np.minimum(cosine, 1) + SOFTEN)
        return float(weight @ self.labels[best] / weight.sum())


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of the ranges, which range each is of)."""
    size = high - low
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size), of


def _scaled(found: np.ndarray, count: np.ndarray, scale: np.ndarray) -> np.ndarray:
    raw = (1 + np.log(count)) * scale[found]
    return raw / max(np.sqrt(raw @ raw), 1e-12)


@dataclass
class Model:
    index: BlockMaxIndex
    slope: float
    shift: float
    prior: float

    def scores(self, texts: Iterable[tuple]) -> Iterator[tuple[float, np.ndarray]]:
        """(score, evidence) of each text."""
        for best, cosine in self.index.search(texts, NEIGHBOURS):
            if len(best):
                logit = self.slope * self.index.vote(best, cosine) + self.shift
                yield float(1 / (1 + np.exp(-logit))), self.index.ids[best[self.index.labels[best] == 1]]
            else:
                yield self.prior, np.zeros(0, np.int64)


def _votes(index: BlockMaxIndex):
    """Sample rows to (label, vote of the neighbours without the row itself)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = index.search(_feature_counts(batch.column(2), index.known), NEIGHBOURS, batch.column(0).to_pylist())
            votes = [index.vote(best, cosine) if len(best) else None for best, cosine in found]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(votes, pa.float64())], ["label", "vote"])
        tidy_memory()
    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, lightly regularised."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-a @ w))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(2), a.T @ (p - y) + 0.1 * w)
        w -= step
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled rows; frequencies are those of all documents."""
    rows = labelled_sample(docs, labels, label, sample, id_col, text_col)
    counts = rows.groupBy("label").count().collect()
    ones = sum(r["count"] for r in counts if r["label"] == 1)
    total = sum(r["count"] for r in counts)
    a, n = F.col("a"), F.col("n")
    expected = n * ones / max(total, 1)
    chi = (a - expected) ** 2 * total / (expected * (total - n) * (1 - ones / max(total, 1)) + 1e-9)
    features = rows.repartition(SPREAD).select("label", "text").mapInArrow(_features, "label int, feature long, word boolean")
    features = features.groupBy("feature", "word").agg(F.sum("label").alias("a"), F.count("*").alias("n")).withColumn("chi", chi)
    features = features.filter(F.col("word") | (F.col("chi") >= CHI_SQUARED)).select("feature", "word", "chi").toArrow()
    hashes, is_word = np.asarray(features["feature"]).view(np.uint64), np.asarray(features["word"])
    order = np.lexsort((hashes, ~is_word))  # words of the sample's texts and some beginnings: the model's size
    known = Known(hashes[order][is_word[order]], hashes[order][~is_word[order]])
    chi = np.asarray(features["chi"])[order]
    seen = docs.select(F.col(text_col).cast("string")).mapInArrow(_known_counts(known), "feature long, texts long")
    seen = seen.groupBy("feature").agg(F.sum("texts").alias("texts")).toArrow()
    feature, texts = np.asarray(seen["feature"]), np.asarray(seen["texts"])
    df = np.zeros(len(known))
    df[feature[feature >= 0]] = texts[feature >= 0]
    idf = np.log((1 + texts[feature < 0].sum()) / (1 + df)) + 1
    scale = idf * np.where(chi >= CHI_SQUARED, np.sqrt(chi), 1)
    examples = rows.repartition(SPREAD).select("doc", "label", "text").mapInArrow(_vectors(known, scale), "doc long, label int, features array<long>, weights array<double>")
    examples = examples.toArrow().combine_chunks()  # at most ``sample`` rows
    lists = examples["features"].combine_chunks() if len(examples) else pa.array([], pa.list_(pa.int64()))
    values = examples["weights"].combine_chunks() if len(examples) else pa.array([], pa.list_(pa.float64()))
    index = BlockMaxIndex.of(
        known, scale, np.asarray(examples["doc"]), np.asarray(examples["label"]).astype(float),
        np.r_[0, np.cumsum(np.asarray(pa.compute.list_value_length(lists)))].astype(np.int64), np.asarray(lists.flatten()), np.asarray(values.flatten()))
    votes = rows.repartition(SPREAD).select("doc", "label", "text").mapInArrow(_votes(index), "label int, vote double").collect()
    none = [r["label"] for r in votes if r["vote"] is None]
    known_votes = [r for r in votes if r["vote"] is not None]
    slope, shift = _logistic(np.array([r["vote"] for r in known_votes]), np.array([r["label"] for r in known_votes], float))
    return Model(index, slope, shift, (sum(none) + ones / max(total, 1)) / (len(none) + 1))


def _vectors(known: Known, scale: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, weights = [], []
            for f, c, _ in _feature_counts(batch.column(2), known):
                found.append(f)
                weights.append(_scaled(f, c, scale))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64())),
                                              pa.array(weights, pa.list_(pa.float64()))], ["doc", "label", "features", "weights"])
        tidy_memory()
    return run


def _scores(model: Model):
    kinds = [pa.field("score", pa.float64()), pa.field("evidence", pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = list(model.scores(_feature_counts(texts, model.index.known)))
            columns = [pa.array([s for s, _ in found], pa.float64()), pa.array([e for _, e in found], pa.list_(pa.int64()))]
            yield pa.StructArray.from_arrays(columns, fields=kinds)
        tidy_memory()
    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "toxicity") -> DataFrame:
    """All rows and columns of ``docs`` plus a struct (score, evidence) under ``name``.

    Only the texts go to Python.
    """
    udf = F.arrow_udf(_scores(model), "score double, evidence array<long>")
    return docs.withColumn(name, udf(F.col(text_col).cast("string")))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for every row."""
    model = fit(docs, labels, "toxic", id_col, text_col, sample)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return score(slim, model, name="found").select(
        "doc_id", held_out("doc_id").alias("held_out"), "found.score",
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"), "found.evidence")


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``."""
    name = free_name(docs, "toxicity")
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return score(docs, model, text_col, name).filter(F.col(f"{name}.score") < threshold).drop(name)
