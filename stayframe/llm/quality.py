"""Quality classifier: logistic regression on hashed word n-grams, learned by FTRL.

Words are lower-cased in A-Z and separated by white space. A text's features are its
words, pairs of words, runs of one to three word *shapes* (letters, digits and the rest each as one
sign, without repeats of a sign, so that ``of%%%`` is a letter sign and a percent sign), and
whether a word repeats the one before. Each is hashed to one of ``2**BITS`` places; a
text's values are the square roots of the counts, scaled to length 1, plus a constant.

The weights are learned by follow the regularised leader (proximal, per coordinate) in one
task from at most ``SAMPLE`` labelled rows, ``EPOCHS`` passes in the order of the hashes of
their ids. Weights that stay at 0 take no room, so the model is at most
``2**BITS`` numbers. Scores are sparse dot products, made where the documents lie.

NULL and texts without words have the constant alone. NULL labels are not learned from; a document with several
labels has the largest. Rows that repeat an id are scored each. Texts are read whole, in chunks. Columns of the user's rows come back as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .toxicity import held_out, labelled_sample
from .words import SPACED, chunks, mix, random_values, tidy_memory, words_of

BITS, SAMPLE, EPOCHS = 20, 12_000, 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.3, 1.0

_SALTS = random_values(8, 41)
_ALL = np.arange(256)
_LETTER = ((_ALL >= 97) & (_ALL <= 122)) | ((_ALL >= 65) & (_ALL <= 90)) | (_ALL >= 128)
_SIGNS = np.where(_LETTER, 97, np.where((_ALL >= 48) & (_ALL <= 57), 48, _ALL))
_SIGN_VALUES = random_values(256, 42)


def _shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word's signs, without repeats, in order."""
    sign = _SIGNS[data]
    first = np.r_[True, sign[1:] != sign[:-1]]
    first[start] = True
    rank = np.cumsum(first)  # place of each byte's sign in the chunk
    turn = rank - np.repeat(rank[start], np.diff(np.r_[start, len(data)])) if len(start) and start[0] == 0 else None
    if turn is None:
        base = np.zeros(len(data), np.int64)
        if len(start):
            base[start[0]:] = np.repeat(rank[start], np.diff(np.r_[start, len(data)]))
        turn = rank - base
    value = np.where(first, mix(_SIGN_VALUES[sign] + turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), np.uint64(0))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    return mix(total[end] - total[start])


def features(texts: pa.Array, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, values) of each text; the constant is place 0."""
    mask, one = np.uint64((1 << bits) - 1), np.uint64(1)
    for _, _, data, bounds in chunks(texts):
        words = words_of(data, bounds, SPACED)
        h, n = words.hash, len(words.hash)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(words.first))
        shape = _shapes(data, words.start, words.end)
        found, owner = [h ^ _SALTS[0], shape ^ _SALTS[1]], [text, text]
        for k, source, salt in ((1, h, 2), (1, shape, 3), (2, shape, 4)):
            if n > k:
                near = np.flatnonzero(text[k:] == text[:-k])
                joined = source[near]
                for step in range(1, k + 1):
                    joined = mix(joined + _SALTS[5]) + source[near + step]
                found.append(joined ^ _SALTS[salt])
                owner.append(text[near])
                if salt == 2:
                    same = near[h[near] == h[near + 1]]
                    found.append(np.full(len(same), _SALTS[6]))
                    owner.append(text[same])
        place = (mix(np.concatenate(found)) & mask) | one  # odd places: 0 is the constant's
        owner = np.concatenate(owner)
        key = np.sort((owner.astype(np.uint64) << np.uint64(bits)) | place)
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        value = np.sqrt(np.diff(np.r_[new, len(key)]))
        key = key[new]
        edges = np.searchsorted(key, np.arange(len(bounds), dtype=np.uint64) << np.uint64(bits))
        for low, high in zip(edges[:-1], edges[1:]):
            x = value[low:high]
            yield (np.r_[0, (key[low:high] & mask).astype(np.int64)],
                   np.r_[1.0, x / max(np.sqrt(x @ x), 1e-12)])


class FTRL:
    """Weights of a logistic regression, one coordinate-wise step for each example."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(self, place: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[place], self.n[place]
        return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, place: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(place)
        slope = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        n = self.n[place]
        self.z[place] += slope - (np.sqrt(n + slope * slope) - np.sqrt(n)) / ALPHA * w
        self.n[place] = n + slope * slope


def _train(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (place.astype(np.int32), value.astype(np.float32), label)
            for batch in batches for label, (place, value) in zip(batch.column(0).to_pylist(), features(batch.column(1), bits))]
        model = FTRL(bits)
        for _ in range(EPOCHS):
            for place, value, label in rows:
                model.learn(place, value.astype(np.float64), float(label))
        weights = model.weights(slice(None))
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weights[at])], ["place", "weight"])
    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE, bits: int = BITS) -> np.ndarray:
    """Weights learned from at most ``sample`` labelled rows that are not held out."""
    rows = labelled_sample(docs, labels, label, sample, id_col, text_col)
    order = [F.xxhash64("doc"), F.col("doc")]
    learned = rows.repartition(1).sortWithinPartitions(*order).select("label", "text").mapInArrow(_train(bits), "place long, weight double")
    weights = np.zeros(1 << bits)
    for row in learned.collect():  # the model: 2**bits numbers at most
        weights[row["place"]] = row["weight"]
    return weights


def _scores(place: np.ndarray, weight: np.ndarray, bits: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = np.zeros(1 << bits)
        weights[place] = weight
        for texts in batches:
            logits = np.array([weights[p] @ x for p, x in features(texts, bits)], float)
            yield pa.array(1 / (1 + np.exp(-np.clip(logits, -35, 35))), pa.float64())
        tidy_memory()
    return run


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", name: str = "quality") -> DataFrame:
    """All rows and columns of ``docs`` plus the score under ``name``. Only the texts go to Python."""
    bits, place = int(len(weights)).bit_length() - 1, np.flatnonzero(weights)
    udf = F.arrow_udf(_scores(place.astype(np.int32), weights[place], bits), "double")
    return docs.withColumn(name, udf(F.col(text_col).cast("string")))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
            sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    weights = fit(docs, labels, "quality", id_col, text_col, sample)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return score(slim, weights, name="score").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
