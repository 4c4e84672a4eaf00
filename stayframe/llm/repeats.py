"""Repeated byte strings of a corpus by prefix-free parsing.

A byte is a repeat when a string of ``length`` bytes that covers it also starts
anywhere else in the corpus, in the same text or in another one.

1. *Parse.* A rolling hash over ``GRAM`` bytes triggers at its smallest value in
   every ``SPAN`` consecutive positions. A trigger depends on nothing but the
   bytes around it, so equal strings are parsed alike, and every string of
   ``length`` bytes has a first trigger no more than ``SPAN - 1`` bytes from its
   start. The strings with one first trigger make a *phrase*: up to ``SPAN - 1``
   bytes before the trigger and the continuation behind it.
2. *Dictionary.* Phrases are grouped by the ``length - SPAN + 1`` bytes that all
   their strings share behind the trigger, then by their whole bytes. Only groups
   with two places or more go on. Places with equal whole phrases are repeats
   with no look at their bytes; hot passages are counted before the shuffle.
3. *Suffix order.* One copy of each different phrase of a group is fetched. The
   dictionary is sorted by the bytes before the trigger, read backwards, the parse
   by the bytes behind it; both with the longest common prefix of neighbours. Two
   strings that start ``t`` bytes before their triggers are equal when they are in
   one run of the dictionary order at depth ``t`` and in one run of the parse order
   at depth ``length - t``. Both comparisons are on bytes, not on hashes.
4. A group with more than ``GROUP_PHRASES`` different phrases is cut into bands of string starts, each grouped anew by
   the longer strings that all of a band share, until it is small enough for the same orders; see ``_hot_spans``.

Phrases and groups are told apart by two 64-bit hashes together. NULL and texts shorter than ``length`` have no repeats.
Rows that repeat an id are separate texts, so equal rows are repeats of each other. Columns besides the id and
the text are not read; those of ``without_repeats`` come back as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import forget, free_name, keyed, small, tidy_memory, written
from .words import CHUNK_BYTES, Ranges, chunks, mix, signed

LENGTH, GRAM, SPAN = 400, 16, 256
GROUP_PHRASES = 4_000
#: starts in a band of a group that is cut, from the first cut to the last
WIDTHS = (32, 4, 1)
BLOCK = 4_000

_MASK = np.uint64((1 << 24) - 1)


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` consecutive values."""
    n = len(values)
    blocks = -(-n // span)
    padded = np.full(blocks * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = values
    padded = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - span + 1], ahead[span - 1 : n])


def _phrases(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int):
    """Phrases of the strings that start in ``[begins, ends)``: first and last start, trigger, Ranges."""
    ranges, n = Ranges(data), len(data)
    gram = mix((ranges.sums[GRAM:] - ranges.sums[:-GRAM]) * ranges.inverse[: n - GRAM + 1])
    place = np.arange(len(gram), dtype=np.uint64)
    least = _smallest((gram & ~_MASK) | (_MASK - place), SPAN)
    trigger = (_MASK - (least & _MASK)).astype(np.int64)
    step = np.zeros(len(trigger) + 2, np.int32)
    np.add.at(step, begins, 1)
    np.add.at(step, ends, -1)
    inside = np.cumsum(step)[: len(trigger)] > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (trigger[1:] != trigger[:-1])
    new[begins] = inside[begins]
    first = np.flatnonzero(new)
    stop = inside & ~np.append(inside[1:] & ~new[1:], False)
    return first, np.flatnonzero(stop), trigger[first], ranges


def _parse(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = batch.column(0), np.asarray(batch.column(1))
            for at, to, data, bounds in chunks(batch.column(2)):
                for skip, part, begins, ends in _parts(data, bounds, length):
                    first, last, trigger, ranges = _phrases(part, begins, ends, length)
                    text = at + np.searchsorted(bounds, first + skip, "right") - 1
                    origin = bounds[text - at] - skip
                    yield pa.RecordBatch.from_arrays([
                        docs.take(pa.array(text)), pa.array(keys[text]),
                        pa.array(trigger - origin), pa.array((trigger - first).astype(np.int32)),
                        pa.array((trigger - last).astype(np.int32)),
                        pa.array(signed(ranges.hash(trigger, trigger + (length - SPAN + 1), 11))),
                        pa.array(signed(mix(ranges.hash(first, last + length, 12) + mix((trigger - first).astype(np.uint64))))),
                    ], ["doc", "key", "pos", "far", "near", "group", "phrase"])
        tidy_memory()
    return run


def _parts(data: np.ndarray, bounds: np.ndarray, length: int):
    """(bytes left out, bytes, begins, ends): the chunk, or a long text in overlapping parts."""
    if len(data) <= 2 * CHUNK_BYTES:
        begins, ends = bounds[:-1], bounds[1:] - length + 1
        some = begins < ends
        if some.any():
            yield 0, data, begins[some], ends[some]
        return
    for text in range(len(bounds) - 1):
        low, high = int(bounds[text]), int(bounds[text + 1]) - length + 1
        for begin in range(low, high, CHUNK_BYTES):
            end = min(begin + CHUNK_BYTES, high)
            yield begin, data[begin : end + length], np.array([0]), np.array([end - begin])


def _extract(length: int):
    """Rows (doc, key, text, wanted) to one row per wanted phrase with its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, key, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                for w in wanted:
                    pos, end = w["pos"], w["pos"] - w["near"] + length
                    out.append((doc, key, pos, w["near"], w["places"], w["group"], data[pos - w["far"] : pos][::-1], data[pos:end]))
                if len(out) >= BLOCK:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)
        tidy_memory()
    return run


_SPANS = "doc long, key long, start long, end long"
_COLUMNS = ["doc", "key", "pos", "near", "places", "group", "left", "right"]
_EXTRACTED = "doc long, key long, pos long, near int, places long, group long, left binary, right binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    names = ["doc", "key", "pos", "near", "places", "group", "left", "right"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _order(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte strings, and the longest common prefix of each with the one before."""
    order = np.array(sorted(range(len(strings)), key=strings.__getitem__), np.int64)
    lengths = np.array([len(strings[i]) for i in order], np.int64)
    grid = np.frombuffer(b"".join(strings[i].ljust(width, b"\0") for i in order), np.uint8).reshape(len(order), width)
    differ = np.ones((len(order), width + 1), bool)
    differ[1:, :width] = grid[1:] != grid[:-1]
    common = np.argmax(differ, axis=1)
    common[1:] = np.minimum(common[1:], np.minimum(lengths[1:], lengths[:-1]))
    return order, common


def repeated_starts(left: list[bytes], right: list[bytes], near: np.ndarray, length: int) -> np.ndarray:
    """Whether the string that starts ``t`` bytes before the trigger of phrase ``i`` is in another phrase: ``[i, t]``."""
    n, far = len(left), np.array([len(x) for x in left], np.int64)
    by_left, common_left = _order(left, SPAN)
    by_right, common_right = _order(right, length)
    found = np.zeros((n, SPAN + 1), bool)
    run_left, run_right = np.empty(n, np.int64), np.empty(n, np.int64)
    for t in range(int(near.min()), int(far.max()) + 1):
        run_left[by_left] = np.cumsum(common_left < t)
        run_right[by_right] = np.cumsum(common_right < length - t)
        rows = np.flatnonzero((near <= t) & (t <= far))
        if len(rows) > 1:
            place = run_left[rows] * (n + 1) + run_right[rows]
            _, which, count = np.unique(place, return_inverse=True, return_counts=True)
            found[rows, t] = count[which] > 1
    return found


def _resolve(length: int):
    """Rows of ``_extract`` with the rows of a group together, to spans."""
    def spans(table: pa.Table) -> pa.RecordBatch:
        near, pos = np.asarray(table["near"]).astype(np.int64), np.asarray(table["pos"])
        found = repeated_starts(table["left"].to_pylist(), table["right"].to_pylist(), near, length)
        found[np.asarray(table["places"]) > 1] = False  # these are repeats anyway
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, low = np.nonzero(edge == 1)
        _, high = np.nonzero(edge == -1)
        picked = pa.array(row)
        return pa.RecordBatch.from_arrays([
            table["doc"].combine_chunks().take(picked), table["key"].combine_chunks().take(picked),
            pa.array(pos[row] - (high - 1)), pa.array(pos[row] - low + length),
        ], ["doc", "key", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < BLOCK:
                continue
            table = pa.Table.from_batches(held)
            groups = np.asarray(table["group"])
            cut = int(np.searchsorted(groups, groups[-1]))
            if cut:
                yield spans(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows = table.num_rows - cut
        if rows:
            yield spans(pa.Table.from_batches(held))
        tidy_memory()
    return run


def _bands(rows: DataFrame, width: int, length: int) -> DataFrame:
    """Rows (place, doc, key, pos, near, far, places, group, left, right) cut into bands of string starts.

    A band holds the strings that start ``t0`` to ``t0 + width - 1`` bytes before the trigger. Equal ones of a
    band share ``t0`` bytes before the trigger and what the longest start leaves behind it: their new group.
    """
    band = F.explode(F.sequence(F.floor(F.col("near") / width).cast("int"), F.floor(F.col("far") / width).cast("int")))
    cut = rows.withColumn("_band", band).withColumn("_low", F.col("_band") * width)
    high = F.col("_low") + width - 1
    shared = [F.substring("left", F.lit(1), F.col("_low")), F.substring("right", F.lit(1), F.lit(length) - high)]
    cut = cut.withColumns({"_group": F.xxhash64("group", "_band", *shared), "near": F.greatest("near", "_low"), "far": F.least("far", high)})
    cut = cut.withColumns({"group": F.col("_group"), "left": F.substring("left", F.lit(1), F.col("far")),
                           "right": F.substring("right", F.lit(1), F.lit(length) - F.col("near"))})
    return cut.drop("_band", "_low", "_group").withColumn("phrase", F.xxhash64("near", "far", "left", "right"))


def _hot_spans(rows: DataFrame, length: int, group_phrases: int) -> DataFrame:
    """Spans of groups with too many phrases for one task, by cutting them into narrower and narrower bands.

    Places that are equal in a whole band are counted, hot ones before the shuffle, as phrases are. Groups that
    are small enough then are resolved as all others; the rest is cut further. A band of one start has one string.
    """
    rows = rows.withColumns({"far": F.length("left"), "place": F.xxhash64("doc", "key", "pos", "near")})
    found = []
    for width in WIDTHS:
        banded = _bands(rows, width, length)
        bare = written(banded.drop("left", "right"), "bands")
        counts = written(bare.groupBy("group", "phrase").agg(F.sum("places").alias("n"), F.min("place").alias("first")), "dictionary")
        sizes = counts.groupBy("group").agg(F.count("*").alias("phrases"))
        equal = bare.join(counts.filter("n > 1").select("group", "phrase"), ["group", "phrase"], "left_semi").filter("places = 1")
        found.append(equal.select("doc", "key", (F.col("pos") - F.col("far")).alias("start"), (F.col("pos") - F.col("near") + length).alias("end")))
        if width == 1:
            break
        mixed = written(sizes.filter("phrases > 1").select("group", (F.col("phrases") > group_phrases).alias("hot")), "groups")
        wanted = counts.join(mixed, "group").select("group", "phrase", F.col("first").alias("place"), F.col("n").alias("_n"), "hot")
        some = written(banded.join(wanted, ["group", "phrase", "place"]).drop("places").withColumnRenamed("_n", "places"), "phrases")
        laid = some.filter("not hot").select(*_COLUMNS).repartition("group").sortWithinPartitions("group")
        found.append(laid.mapInArrow(_resolve(length), _SPANS))
        rows = some.filter("hot").drop("hot", "phrase")
        if rows.isEmpty():
            break
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return spans


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   group_phrases: int = GROUP_PHRASES) -> DataFrame:
    """(doc, key, spans): per text with repeats, array of struct(start, end) in bytes, unmerged; a written table.

    ``length`` may not be below ``SPAN + GRAM``.
    """
    if length < SPAN + GRAM:
        raise ValueError(f"length must be {SPAN + GRAM} or more")
    texts = keyed(docs, id_col, text_col)
    places = written(texts.mapInArrow(
        _parse(length), "doc long, key long, pos long, far int, near int, group long, phrase long"), "parse")
    groups = places.groupBy("group").agg(
        F.count("*").alias("n"), F.min("phrase").alias("low"), F.max("phrase").alias("high"))
    groups = written(groups.filter("n > 1").select("group", (F.col("low") != F.col("high")).alias("mixed")), "groups")
    # few groups are broadcast and no place moves; else a group with very many places can be split in the join
    hits = written(places.join(F.broadcast(groups) if small(groups) else groups, "group"), "repeats")
    forget(places)
    one_place = F.xxhash64("doc", "key", "pos")
    phrases = written(hits.filter("mixed").groupBy("group", "phrase").agg(
        F.count("*").alias("places"), *(F.min_by(c, one_place).alias(c) for c in ("doc", "key", "pos")),
        F.min("far").alias("far"), F.min("near").alias("near")), "dictionary")
    equal = written(phrases.filter("places > 1").select("group", "phrase"), "equal")
    whole = hits.filter("not mixed").unionByName(
        hits.filter("mixed").join(F.broadcast(equal) if small(equal) else equal, ["group", "phrase"], "left_semi"))
    spans = whole.select("doc", "key", (F.col("pos") - F.col("far")).alias("start"),
                         (F.col("pos") - F.col("near") + length).alias("end"))

    wanted = phrases.groupBy("doc", "key").agg(
        F.collect_list(F.struct("pos", "far", "near", "places", "group")).alias("wanted"))
    ids = written(phrases.select("doc", "key").distinct(), "ids")
    on = F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("key") == F.col("__key"))
    wanted_ids = ids.select(F.col("doc").alias("__doc"), F.col("key").alias("__key"))
    wanted = wanted.select(F.col("doc").alias("__doc"), F.col("key").alias("__key"), "wanted")
    some = texts.join(F.broadcast(wanted_ids), on, "left_semi") if small(ids) else texts
    cut = some.dropDuplicates(["doc", "key"]).join(wanted, on).select("doc", "key", "text", "wanted")
    cut = cut.mapInArrow(_extract(length), _EXTRACTED)
    hot = written(phrases.groupBy("group").count().filter(F.col("count") > group_phrases).select("group"), "hot")
    if hot.isEmpty():
        laid = cut
    else:
        cut = written(cut, "phrases")
        laid = cut.join(hot, "group", "left_anti")
        spans = spans.unionByName(_hot_spans(cut.join(hot, "group", "left_semi"), length, group_phrases))
    laid = laid.select(*_COLUMNS).repartition("group").sortWithinPartitions("group")
    spans = spans.unionByName(laid.mapInArrow(_resolve(length), _SPANS))
    found = written(spans.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    forget(groups, hits, phrases, equal, ids, hot)
    return found


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the spans."""
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for start, end in spans:
        out.append(data[at:start])
        at = end
    return b"".join([*out, data[at:]])


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str, name: str = "spans") -> DataFrame:
    """All rows and columns of ``docs`` plus the spans under ``name`` (NULL where there are none).

    Only texts with repeats are shuffled, as long as their ids may be broadcast.
    """
    doc, key = free_name(docs, "doc"), free_name(docs, "key")
    of, text = f"{doc}_of", f"{key}_of"
    spans = spans.select(F.col("doc").alias(doc), F.col("key").alias(key), F.col("spans").alias(name))
    here = docs.withColumns({of: F.col(id_col).cast("long"), text: F.xxhash64(F.col(text_col))})
    on = F.col(of).eqNullSafe(F.col(doc)) & (F.col(text) == F.col(key))
    ids = spans.select(doc, key)
    if not small(ids):
        return here.join(spans, on, "left").select(*docs.columns, name)
    repeating = here.join(F.broadcast(ids), on, "left_semi").join(spans, on).select(*docs.columns, name)
    others = here.join(F.broadcast(ids), on, "left_anti").select(*docs.columns)
    return repeating.unionByName(others.withColumn(name, F.lit(None).cast(spans.schema[name].dataType)))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data, runs = (text or "").encode(), merged(spans)
            rest = kept_bytes(data, runs)
            out.append((len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
        columns = list(zip(*out)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()]))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row."""
    found = repeated_spans(docs, id_col, text_col, length)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_spans(slim, found, "doc_id", "text").mapInArrow(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, spans in batches:
        yield pa.array([
            t if s is None else kept_bytes(t.encode(), merged(s)).decode("utf-8", "ignore")
            for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())
    tidy_memory()


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The same rows and columns, with the repeated bytes cut out of the texts.

    A character cut through goes as a whole. NULL texts stay NULL.
    """
    name = free_name(docs, "spans")
    found = with_spans(docs, repeated_spans(docs, id_col, text_col, length), id_col, text_col, name)
    cut = F.arrow_udf(_without, "string")(F.col(text_col), F.col(name))
    return found.withColumn(text_col, F.when(F.col(name).isNull(), F.col(text_col)).otherwise(cut)).drop(name)
