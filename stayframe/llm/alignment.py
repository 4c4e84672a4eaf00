"""Tokens of two vocabularies laid over each other.

Both encoders run over the same bytes, a space and the text. A token of one side
covers a token start of the other when it is the last one that starts there or before:
``pandas.merge_asof``, keyed by document, finds it for the token starts of either
side. The two directions together are all pairs of tokens whose byte ranges overlap. Offsets where
tokens of both sides end cut the tokens into groups.

How often two ids are linked is counted over the corpus:

1. Documents are encoded and aligned once, in *blocks* of about ``BLOCK_BYTES`` of
   text. A block is written with a dictionary of its different id pairs; its documents
   hold dictionary codes and how often each occurs.
2. The dictionaries are summed up by id pair. A pair stands once in a block,
   however frequent it is, so no key is hot.
3. Each block gets the counts of its own pairs back, and sums them up by document.

Only the highest count of each right-hand id is broadcast: one row for each entry
of the vocabulary at most.

NULL and empty texts have no tokens, nor have texts whose tokens do not give the bytes of the text
back (such as those with U+2581, which stands for a space). Rows that repeat an id are aligned and
counted each. A text is never cut: one longer than a block is a block of its own.
Columns besides the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .packing import ByteBPE
from .tables import written
from .words import chunks

CHUNK_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
#: ids of one vocabulary are below this
IDS = 1 << 24

_COMMA, _BAR, _SEMICOLON = b",|;"


class ByteLevel:
    """Byte-level BPE over a space and the text; texts of special tokens are ordinary."""

    def __init__(self, path: str):
        encoder = ByteBPE(path)
        self.encode, self.pieces = encoder.encoder.encode_ordinary, _table(encoder.ranks)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.encode(f" {text}") for text in texts]


class Pieces:
    """A ``sentencepiece`` model, which puts the space before the text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(self.model.get_piece_size())
        self.pieces = [self._bytes(i) for i in every]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _table(vocabulary: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        pieces[i] = piece
    return pieces


@cache
def _sides(left: str, right: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(left), Pieces(right)


@cache
def _lengths(side) -> np.ndarray:
    return np.array([len(piece) for piece in side.pieces], np.int64)


@dataclass
class Tokens:
    """Tokens of consecutive texts, with byte positions counted on from text to text."""

    id: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray


@dataclass
class Alignment:
    """Links and groups of the tokens of consecutive texts.

    ``one[i]`` and ``two[i]`` are the places of the i-th linked tokens; ``cuts`` are the
    positions where tokens of both sides end.
    """

    a: Tokens
    b: Tokens
    one: np.ndarray
    two: np.ndarray
    cuts: np.ndarray

    @cached_property
    def cut_text(self) -> np.ndarray:
        """Text of each group."""
        return self.a.text[np.searchsorted(self.a.end, self.cuts)]

    def group_strings(self, texts: int) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for each text: ids of its groups in order; empty without tokens."""
        a, b = self.a, self.b
        key = np.concatenate([2 * np.searchsorted(self.cuts, a.end), 2 * np.searchsorted(self.cuts, b.end) + 1])
        order = np.argsort(key, kind="stable")
        key, ids, text = key[order], np.concatenate([a.id, b.id])[order], np.concatenate([a.text, b.text])[order]
        bytes_per_text = np.zeros(texts + 1, np.int64)
        if not len(key):
            return [b""] * texts
        follows = np.diff(key, append=-1)
        sign = np.where(follows == 0, _COMMA, np.where(key % 2 == 0, _BAR, _SEMICOLON)).astype(np.uint8)
        last = np.diff(text, append=-1) != 0
        digits, width = _decimals()
        grid = np.zeros((len(ids), digits.shape[1] + 1), np.uint8)
        grid[:, :-1] = digits[ids]
        size = width[ids]
        grid[np.arange(len(ids)), size] = sign
        size = size + ~last
        flat = grid[np.arange(grid.shape[1]) < size[:, None]].tobytes()
        bytes_per_text[1:] = np.bincount(text, size, texts).astype(np.int64)
        at = np.cumsum(bytes_per_text)
        return [flat[low:high] for low, high in zip(at[:-1], at[1:])]


@cache
def _decimals(ids: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """ASCII digits of the numbers below ``ids``, from the left, and how many there are."""
    texts = np.arange(ids).astype("S8")
    return texts.view(np.uint8).reshape(ids, 8), np.char.str_len(texts).astype(np.int64)


def _tokens(side, ids: list[list[int]]) -> Tokens:
    count = np.array([len(x) for x in ids], np.int64)
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(count.sum()))
    end = np.cumsum(_lengths(side)[flat])
    return Tokens(flat, np.repeat(np.arange(len(ids)), count), end - _lengths(side)[flat], end)


def _faithful(side, ids: list[list[int]], wanted: list[bytes]) -> list[bool]:
    """Whether the tokens of each text give its bytes."""
    piece = side.pieces.__getitem__
    return [b"".join(map(piece, x)) == data for x, data in zip(ids, wanted)]


def _covering(tokens: Tokens, others: Tokens) -> np.ndarray:
    """Place of the token in ``others`` that covers the start of each of ``tokens``."""
    left = pd.DataFrame({"start": tokens.start, "text": tokens.text})
    right = pd.DataFrame({"start": others.start, "text": others.text, "place": np.arange(len(others.id))})
    return pd.merge_asof(left, right, on="start", by="text")["place"].to_numpy()


def align(texts: list[str | None], left: ByteLevel, right: Pieces) -> Alignment:
    """Tokens, links and groups of each text."""
    plain = [text or "" for text in texts]
    one, two = left.ids(plain), right.ids(plain)
    wanted = [f" {text}".encode() for text in plain]
    for i, good in enumerate(map(all, zip(plain, _faithful(left, one, wanted), _faithful(right, two, wanted)))):
        if not good:
            one[i], two[i] = [], []
    a, b = _tokens(left, one), _tokens(right, two)
    if not len(a.id):
        none = np.zeros(0, np.int64)
        return Alignment(a, b, none, none, none)
    covers_a, covers_b = _covering(a, b), _covering(b, a)
    more = a.start[covers_b] != b.start  # else the other direction has the pair already
    first, second = np.arange(len(a.id)), np.arange(len(b.id))
    return Alignment(a, b, np.concatenate([first, covers_b[more]]), np.concatenate([covers_a, second[more]]),
                     np.intersect1d(a.end, b.end, assume_unique=True))


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str | None]]]:
    texts = batch.column(1)
    for at, to, _, _ in chunks(texts, CHUNK_BYTES):
        yield at, to, texts.slice(at, to - at).to_pylist()


def _lists(values: np.ndarray, text: np.ndarray, texts: int) -> pa.Array:
    """One list for each text, of values in the order of their texts."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(texts + 1)), pa.int32()), pa.array(values))


def _whole(left: str, right: str):
    names = ["doc_id", "a_ids", "a_ends", "b_ids", "b_ends", "link_a", "link_b", "group_ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(left, right)
        for batch in batches:
            for at, to, texts in _parts(batch):
                found, n = align(texts, *sides), to - at
                a, b = found.a, found.b
                base = np.zeros(n, np.int64)
                first = [np.searchsorted(x.text, np.arange(n)) for x in (a, b)]
                has = np.bincount(a.text, minlength=n) > 0
                base[has] = a.start[first[0][has]]
                order = np.lexsort((found.two, found.one))
                one, two = found.one[order], found.two[order]
                text = a.text[one]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, n), _lists(a.id, a.text, n), _lists(a.end - base[a.text], a.text, n),
                    _lists(b.id, b.text, n), _lists(b.end - base[b.text], b.text, n),
                    _lists(one - first[0][text], text, n), _lists(two - first[1][text], text, n),
                    _lists(found.cuts - base[found.cut_text], found.cut_text, n)], names)
    return run


def _paths(left: str | None, right: str | None) -> tuple[str, str]:
    return (str(left or public_tokenizers.path("byte_bpe_50k.json")),
            str(right or public_tokenizers.path("piece_bpe_32k.model")))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", left: str | None = None, right: str | None = None) -> DataFrame:
    """Tokens and links of every document.

    (doc_id, a_ids, a_ends, b_ids, b_ends, link_a, link_b, group_ends): ids and byte ends of
    both sides' tokens, the places of linked tokens, counted from 0 in the document, and the ends of groups.
    ``left`` and ``right``: paths of a byte-level BPE file and of a ``sentencepiece`` model on every executor.
    """
    columns = ", ".join(f"{n} array<long>" for n in ("a_ids", "a_ends", "b_ids", "b_ends", "link_a", "link_b", "group_ends"))
    return _texts(docs, id_col, text_col).mapInArrow(_whole(*_paths(left, right)), f"doc_id long, {columns}")


_BLOCKS = pa.schema([
    ("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("codes", pa.list_(pa.int32())),
    ("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("links", pa.list_(pa.int64()))])
_BLOCKS_SHAPE = ("block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                 "codes array<int>, times array<int>, pairs array<long>, links array<long>")


class _Block:
    """Documents of one block and the id pairs linked in each, with how often."""

    def __init__(self):
        self.size, self.parts, self.pairs, self.times, self.count = 0, [], [], [], []

    def add(self, ids: pa.Array, texts: list[str | None], found: Alignment) -> None:
        a, b, n = found.a, found.b, len(texts)
        pair = a.id[found.one] * IDS + b.id[found.two]
        different, code = np.unique(pair, return_inverse=True)
        keys, times = np.unique(a.text[found.one] * max(len(different), 1) + code, return_counts=True)
        text, code = np.divmod(keys, max(len(different), 1))
        self.pairs.append(different[code])
        self.times.append(times)
        self.count.append(np.bincount(text, minlength=n))
        digests = [hashlib.sha256(s).hexdigest() if s else "" for s in found.group_strings(n)]
        counts = [np.bincount(x, minlength=n) for x in (a.text, b.text, found.cut_text, a.text[found.one])]
        self.parts.append(pa.RecordBatch.from_arrays([ids, *map(pa.array, counts), pa.array(digests, pa.string())], _BLOCKS.names[2:8]))
        self.size += sum(map(len, filter(None, texts)))

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """The documents, then the dictionary as a row with place -1."""
        pairs, times = np.concatenate(self.pairs), np.concatenate(self.times)
        different, code = np.unique(pairs, return_inverse=True)
        first = np.concatenate([[0], np.cumsum(np.concatenate(self.count))])
        docs = pa.Table.from_batches(self.parts).combine_chunks()
        n = len(docs)
        empty = pa.array([[]] * n, pa.list_(pa.int64()))
        lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int32())) for x in (code, times)]
        columns = [pa.array(np.full(n, block)), pa.array(np.arange(n), pa.int32())]
        columns += [docs.column(k).combine_chunks() for k in docs.column_names]
        yield pa.RecordBatch.from_arrays([*columns, *lists, empty, empty], schema=_BLOCKS)
        links = np.bincount(code, times, len(different)).astype(np.int64)
        yield pa.RecordBatch.from_pylist([{"block": block, "place": -1, "pairs": different, "links": links}], _BLOCKS)


def _blocks(left: str, right: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, block, number = _sides(left, right), _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, to, texts in _parts(batch):
                block.add(batch.column(0).slice(at, to - at), texts, align(texts, *sides))
                if block.size >= block_bytes:
                    yield from block.rows(number)
                    block, number = _Block(), number + 1
        if block.parts:
            yield from block.rows(number)
    return run


_DIGESTS = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])


def _summed(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one block with the counts of their links summed up."""
    code = np.asarray(counts["code"])
    total, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    total[code], best[code] = np.asarray(counts["total"]), np.asarray(counts["best"])
    codes, times = docs["codes"].combine_chunks(), np.asarray(docs["times"].combine_chunks().flatten())
    text, code = np.asarray(codes.value_parent_indices()), np.asarray(codes.flatten())
    sums = []
    for value in (best, total):
        upto = np.concatenate([[0], np.cumsum(value[code] * times)])
        ends = np.searchsorted(text, np.arange(len(docs) + 1))
        sums.append(pa.array(upto[ends[1:]] - upto[ends[:-1]]))
    found = {"n_best": sums[0], "count_sum": sums[1]}
    return pa.Table.from_arrays([found[n] if n in found else docs[n] for n in _DIGESTS.names], schema=_DIGESTS)


def alignment_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", left: str | None = None,
                      right: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every document.

    ``count_sum`` sums, over the links, how many links of the corpus hold the same id pair;
    ``n_best`` counts links whose pair is the most frequent one of its right-hand id, ties included.
    """
    texts = _texts(docs, id_col, text_col)
    blocks = written(texts.mapInArrow(_blocks(*_paths(left, right), block_bytes), _BLOCKS_SHAPE), "blocks")
    entries = blocks.filter("place < 0").select("block", F.posexplode(F.arrays_zip("pairs", "links")).alias("code", "_entry"))
    entries = entries.select("block", "code", F.col("_entry.pairs").alias("pair"), F.col("_entry.links").alias("links"))
    counts = written(entries.groupBy("pair").agg(F.sum("links").alias("total")), "pairs")
    counts = counts.withColumn("b", F.col("pair") % IDS)
    highest = counts.groupBy("b").agg(F.max("total").alias("highest"))  # a row for each right-hand id
    marked = counts.join(F.broadcast(highest), "b").select(
        "pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best"))
    back = entries.select("block", "code", "pair").join(marked, "pair").select(F.col("block").alias("of"), "code", "total", "best")
    shape = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    kept = blocks.filter("place >= 0").select("block", *_BLOCKS.names[2:10])
    return kept.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_summed, shape)
