"""Benchmark decontamination with one FM-index per training shard.

Benchmark texts are cut into phrases: every window of ``window`` consecutive
words, or the whole item when it has fewer. A *shard* is the texts of one Arrow
chunk. Its index is over words, not characters:

* Words that occur in no phrase become breaks, as do the ends of texts; stretches
  between breaks that are shorter than the shortest phrase are left out, since no phrase fits. Every break sorts
  by its place, so suffixes are told apart by the next break at the latest.
* The suffix array is sorted by prefix doubling, three words at a time at first.
* The Burrows-Wheeler transform is held in a wavelet matrix: one bit per word and
  level, with running counts, so a rank is one lookup per level.
* All phrases are searched backwards at once, one word a step, two ranks each.
* Suffix positions are kept at the start of each stretch and at every ``SAMPLE``-th
  word; the others are found by stepping back to the nearest kept one.

Occurrences become word spans; a text's spans are merged. The phrases are a written table in blocks of
about ``BLOCK_PHRASES``; the driver and a task hold one block at a time, however large the benchmark
is. With more than one block each is searched in a pass of its own and the spans are united.

Words are compared by 64-bit hashes, and texts by SHA-256 where passes are united. NULL texts and items have no words.
Items without words have no phrases. Rows with one id are separate texts. Texts are read whole, in chunks. Results do not
depend on how texts fall into shards. All columns of the user's rows come back as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from .repeats import kept_bytes
from .tables import free_name, tidy_memory, written
from .words import CHUNK_BYTES, PLAIN, chunks, signed, words_of

WINDOW, SAMPLE = 10, 8
#: phrases the driver and a task hold at a time (about 100 bytes each)
BLOCK_PHRASES = 500_000
SHARD_BYTES = CHUNK_BYTES


def _phrases(window: int):
    """Benchmark rows to one row per phrase: (item, words as hashes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, phrases = [], []
            for at, _, data, bounds in chunks(batch.column(1)):
                words = words_of(data, bounds, PLAIN)
                for i, (first, last) in enumerate(zip(words.first[:-1], words.first[1:])):
                    size = min(window, last - first)
                    for k in range(first, last - size + 1 if size else first):
                        items.append(at + i)
                        phrases.append(signed(words.hash[k : k + size]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(items, pa.int64())), pa.array(phrases, pa.list_(pa.int64()))], ["item", "phrase"])
    return run


class FMIndex:
    """Counts and places of word sequences in one array of symbols; 0 is a break."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        n = len(symbols)
        breaks = np.flatnonzero(symbols == 0)
        order = self._sorted(symbols, breaks, alphabet)
        last = np.where(order > 0, symbols[order - 1], 0)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))])
        start = np.zeros(n, bool)
        start[breaks[breaks + 1 < n] + 1] = True
        start[::SAMPLE] = True
        kept = start[order]
        self.kept = np.concatenate([[0], np.cumsum(kept)])
        self.is_kept, self.places = kept, order[kept]
        self.levels, self.zeros = [], []
        for bit in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            ones = (last >> bit) & 1
            self.levels.append((bit, np.concatenate([[0], np.cumsum(ones, dtype=np.int32)]).astype(np.int32)))
            self.zeros.append(n - int(ones.sum()))
            last = np.concatenate([last[ones == 0], last[ones == 1]])
        self.size = n

    @staticmethod
    def _sorted(symbols: np.ndarray, breaks: np.ndarray, alphabet: int) -> np.ndarray:
        """Suffix array: by the words up to the next break, then by its place."""
        n, values = len(symbols), symbols.astype(np.int64) + len(breaks)
        values[breaks] = np.arange(len(breaks))
        width = max(1, int(alphabet + len(breaks)).bit_length())
        depth = max(1, 62 // width)
        padded = np.concatenate([values, np.zeros(depth, np.int64)])
        key = np.zeros(n, np.int64)
        for k in range(depth):
            key = (key << width) | padded[k : k + n]
        order = np.argsort(key)
        new = np.r_[True, key[order][1:] != key[order][:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        while not new.all():
            tied = np.flatnonzero(~new | ~np.r_[new[1:], True])  # places in order whose rank is shared
            at = order[tied]
            second = np.where(at + depth < n, rank[np.minimum(at + depth, n - 1)], -1)
            by = np.lexsort((second, rank[at]))
            order[tied] = at[by]
            first, second = rank[at][by], second[by]
            apart = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
            new[tied] = apart
            rank[order[tied]] = np.maximum.accumulate(np.where(apart, tied, 0))
            depth *= 2
        return order

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the symbol stands among the first ``at`` of the transform."""
        low = np.zeros_like(at)
        for (bit, ones), zeros in zip(self.levels, self.zeros):
            one = ((symbol >> bit) & 1).astype(bool)
            low = np.where(one, zeros + ones[low], low - ones[low])
            at = np.where(one, zeros + ones[at], at - ones[at])
        return at - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        found = np.zeros_like(at)
        for (bit, ones), zeros in zip(self.levels, self.zeros):
            one = ones[at + 1] - ones[at]
            found |= one.astype(found.dtype) << bit
            at = np.where(one == 1, zeros + ones[at], at - ones[at])
        return found

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the suffix order that start with each phrase (right-aligned, padded with 0)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for step in range(1, phrases.shape[1] + 1):
            live = live[(sizes[live] >= step) & (low[live] < high[live])]
            word = phrases[live, -step]
            low[live] = self.before[word] + self.rank(word, low[live])
            high[live] = self.before[word] + self.rank(word, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where in the text the suffixes at these rows of the order start."""
        place, steps, rows, live = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), rows.copy(), np.arange(len(rows))
        while len(live):
            done = self.is_kept[rows[live]]
            found = live[done]
            place[found] = self.places[self.kept[rows[found]]] + steps[found]
            live = live[~done]
            word = self.symbol(rows[live])
            rows[live] = self.before[word] + self.rank(word, rows[live])
            steps[live] += 1
        return place


@dataclass
class Block:
    """Phrases of a block as symbols: 1 and up for the words, 0 is the break."""

    words: np.ndarray
    phrases: np.ndarray
    sizes: np.ndarray
    items: list[list[int]]

    @classmethod
    def of(cls, rows: list[tuple[list[int], list[int]]]) -> Block:
        sizes = np.array([len(p) for p, _ in rows], np.int64)
        words = np.unique(np.concatenate([np.array(p, np.int64).view(np.uint64) for p, _ in rows])) if rows else np.zeros(0, np.uint64)
        table = np.zeros((len(rows), int(sizes.max(initial=0))), np.int64)
        for i, (p, _) in enumerate(rows):
            table[i, table.shape[1] - len(p):] = np.searchsorted(words, np.array(p, np.int64).view(np.uint64)) + 1
        return cls(words, table, sizes, [sorted(items, key=str) for _, items in rows])


def occurrences(hashes: np.ndarray, first: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(start word, phrase) of every occurrence in the texts of a shard, by its FM-index."""
    none = np.zeros(0, np.int64)
    if not len(block.phrases) or not len(hashes):
        return none, none
    at = np.minimum(np.searchsorted(block.words, hashes), len(block.words) - 1)
    symbols = np.where(block.words[at] == hashes, at + 1, 0)
    ends = first[1:-1]
    text = np.insert(symbols, ends, 0)  # a break between texts
    origin = np.insert(np.arange(len(hashes)), ends, -1)
    known = text > 0
    begin = np.flatnonzero(known & ~np.r_[False, known[:-1]])
    end = np.flatnonzero(known & ~np.r_[known[1:], False]) + 1
    long = end - begin >= block.sizes.min()
    begin, end = begin[long], end[long]
    if not len(begin):
        return none, none
    keep = np.zeros(len(text) + 1, np.int8)
    keep[begin], keep[end] = 1, 2  # each stretch with the break behind it
    inside = np.zeros(len(text) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, end, -1)
    chosen = np.flatnonzero((np.cumsum(inside)[: len(text)] > 0) | (keep[: len(text)] == 2))
    index = FMIndex(np.r_[0, text[chosen], 0], len(block.words) + 1)
    origin = np.r_[-1, origin[chosen], -1]
    low, high = index.search(block.phrases, block.sizes)
    count = np.maximum(high - low, 0)
    phrase = np.repeat(np.arange(len(count)), count)
    rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return origin[index.locate(rows)], phrase


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
_KINDS = [pa.field("n_words", pa.int64()), pa.field("n_hit", pa.int64()), pa.field("spans", pa.list_(_SPAN)), pa.field("items", pa.list_(pa.string()))]
_SPANS = "array<struct<start: long, end: long, first: long, last: long>>"
_FOUND = f"n_words long, n_hit long, spans {_SPANS}, items array<string>"


def _found(texts: pa.Array, block: Block) -> pa.StructArray:
    """Per text: words, words that are hit, spans of them in bytes and words, items."""
    out: list[tuple] = []
    for _, _, data, bounds in chunks(texts, SHARD_BYTES):
        words = words_of(data, bounds, PLAIN)
        start, phrase = occurrences(words.hash, words.first, block)
        hit = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(hit, start, 1)
        np.add.at(hit, start + block.sizes[phrase], -1)
        text = np.searchsorted(words.first, start, "right") - 1
        items: dict[int, set] = {}
        for t, p in set(zip(text.tolist(), phrase.tolist())):
            items.setdefault(t, set()).update(block.items[p])
        covered = np.cumsum(hit)[:-1] > 0
        for t, (first, last) in enumerate(zip(words.first[:-1], words.first[1:])):
            edge = np.diff(np.r_[0, covered[first:last].astype(np.int8), 0])
            low, high = np.flatnonzero(edge == 1) + first, np.flatnonzero(edge == -1) + first
            spans = [{"start": int(words.start[a] - bounds[t]), "end": int(words.end[b - 1] - bounds[t]),
                      "first": int(a - first), "last": int(b - first)} for a, b in zip(low, high)]
            out.append((int(last - first), int((high - low).sum()), spans, sorted(map(str, items.get(t, ())))))
    columns = list(zip(*out)) or [(), (), (), ()]
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _KINDS)], fields=_KINDS)


def _hits(rows: list[tuple]):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = Block.of(rows)
        for texts in batches:
            yield _found(texts, block)
        tidy_memory()
    return run


def _united(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Spans of several blocks as one set of runs of words."""
    for lists in batches:
        out = []
        for spans in lists.to_pylist():
            runs: list[dict] = []
            for x in sorted(spans or (), key=lambda x: x["first"]):
                if runs and x["first"] <= runs[-1]["last"]:
                    if x["last"] > runs[-1]["last"]:
                        runs[-1] |= {"last": x["last"], "end": x["end"]}
                else:
                    runs.append(dict(x))
            out.append(runs)
        yield pa.array(out, pa.list_(_SPAN))


def phrase_table(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
                 limit: int = BLOCK_PHRASES) -> tuple[DataFrame, int]:
    """(written table (phrase, items, block), number of blocks of about ``limit`` phrases).

    The benchmark is the stated query set; its words are hashed, its texts are not sent.
    """
    found = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    found = found.mapInArrow(_phrases(window), "item string, phrase array<long>").filter("size(phrase) > 0")
    rows = written(found.groupBy("phrase").agg(F.collect_set("item").alias("items")), "phrases")
    blocks = max(1, -(-rows.count() // limit))
    return rows.withColumn("block", F.pmod(F.xxhash64("phrase"), F.lit(blocks))), blocks


def _block(phrases: DataFrame, number: int) -> list[tuple]:
    """Phrases and items of one block: all that the driver and a task hold at a time."""
    return [(r["phrase"], r["items"]) for r in phrases.filter(F.col("block") == number).orderBy("phrase").toLocalIterator()]


def _united_hits(docs: DataFrame, phrases: DataFrame, blocks: int, text_col: str) -> DataFrame:
    """(key, n_hit, spans, items) of the texts with hits, by their hashes: one pass for each block, the hits written and united."""
    texts = docs.select(F.sha2(F.col(text_col).cast("string"), 256).alias("key"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    hits = None
    for b in range(blocks):
        found = texts.select("key", F.arrow_udf(_hits(_block(phrases, b)), _FOUND)("text").alias("found"))
        part = written(found.filter("size(found.items) > 0 OR found.n_hit > 0").select("key", "found.spans", "found.items").dropDuplicates(["key"]), "hits")
        hits = part if hits is None else hits.unionByName(part)
    hits = hits.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = written(hits.withColumn("spans", F.arrow_udf(_united, _SPANS)("spans")), "hits")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"])
    return hits.select("key", n_hit.alias("n_hit"), "spans", "items")


def _with_hits(docs: DataFrame, hits: DataFrame, text_col: str, name: str) -> DataFrame:
    """All rows and columns of ``docs`` plus the hits of their texts as a struct, NULL without any."""
    key = free_name(docs, "key")
    packed = hits.select(F.col("key").alias(key), F.struct("n_hit", "spans", "items").alias(name))
    return docs.withColumn(key, F.sha2(F.col(text_col).cast("string"), 256)).join(packed, key, "left").select(*docs.columns, name)


def mark(docs: DataFrame, phrases: DataFrame, blocks: int = 1, text_col: str = "text", name: str = "found") -> DataFrame:
    """All rows and columns of ``docs`` plus, under ``name``, what of the phrases their texts hold. Only the texts go to Python."""
    search = F.arrow_udf(_hits(_block(phrases, 0) if blocks == 1 else []), _FOUND)
    counted = docs.withColumn(name, search(F.col(text_col).cast("string")))
    if blocks == 1:
        return counted
    other = free_name(counted, "hits")
    joined = _with_hits(counted, _united_hits(docs, phrases, blocks, text_col), text_col, other)
    parts = [F.when(F.col(other).isNull(), F.col(f"{name}.{c}")).otherwise(F.col(f"{other}.{c}")).alias(c) for c in ("n_hit", "spans", "items")]
    return joined.withColumn(name, F.struct(F.col(f"{name}.n_words").alias("n_words"), *parts)).drop(other)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, limit: int = BLOCK_PHRASES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return mark(slim, *phrase_table(benchmark, window=window, limit=limit)).select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), (F.col("found.n_hit") > 0).alias("contaminated"))


def _cut(text: str | None, spans: list[dict] | None) -> str | None:
    return kept_bytes(text.encode(), [(x["start"], x["end"]) for x in spans]).decode() if text is not None and spans else text


def _without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, spans in batches:
        yield pa.array(list(map(_cut, texts.to_pylist(), spans.to_pylist())), pa.string())
    tidy_memory()


def _cleaned(rows: list[tuple]):
    """Texts without the words that the phrases hit: found and cut in one worker."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = Block.of(rows)
        for texts in batches:
            spans = _found(texts, block).field("spans")
            hit = pa.compute.greater(pa.compute.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
            if hit.any():
                at = np.flatnonzero(hit)
                cut = [_cut(texts[i].as_py(), spans[i].as_py()) for i in at.tolist()]
                texts = pa.compute.replace_with_mask(texts, pa.array(hit), pa.array(cut, texts.type))
            yield texts
        tidy_memory()
    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, limit: int = BLOCK_PHRASES) -> DataFrame:
    """The same rows and columns with the hit words, and what stands between them, cut out of the texts."""
    phrases, blocks = phrase_table(benchmark, window=window, limit=limit)
    if blocks == 1:
        return docs.withColumn(text_col, F.arrow_udf(_cleaned(_block(phrases, 0)), "string")(F.col(text_col).cast("string")))
    name = free_name(docs, "hits")
    found = _with_hits(docs, _united_hits(docs, phrases, blocks, text_col), text_col, name)
    cut = F.arrow_udf(_without, "string")(F.col(text_col).cast("string"), F.col(f"{name}.spans"))
    return found.withColumn(text_col, F.when(F.col(name).isNotNull(), cut).otherwise(F.col(text_col))).drop(name)
