"""Token alignment against all overlaps found one by one, odd rows, block layout."""

import collections
import hashlib

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stayframe.llm import alignment
from stayframe.llm.packing import _byte_of

ODD = [
    (1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "<s> hi </s> <|endoftext|> <0x41> <unk>"), (6, "日本語 🤖 \x00x"),
    (7, "\ttab\n\r\n  two  "), (None, "the the the"), (7, "the the the"), (8, "á ﬁ Ａ"), (9, "the of " * 3000), (9, "x" * 5000)]


def sides():
    table = _byte_of()
    left = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))

    def of_left(text):
        return [(i, bytes(table[c] for c in left.id_to_token(i))) for i in left.encode(" " + text, add_special_tokens=False).ids]

    def of_right(text):
        ids = right.encode(text)
        return [(i, bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode()) for i in ids]

    return of_left, of_right


def spans(tokens):
    out, at = [], 0
    for i, piece in tokens:
        out.append((i, at, at + len(piece)))
        at += len(piece)
    return out


def plain(rows):
    """Per row: tokens of both sides, linked places, ends of groups."""
    of_left, of_right = sides()
    found = []
    for i, text in rows:
        a, b = (of_left(text), of_right(text)) if text else ([], [])
        wanted = b" " + (text or "").encode()
        if any(b"".join(p for _, p in x) != wanted for x in (a, b)):
            a, b = [], []
        a, b = spans(a), spans(b)
        links, low = [], 0
        for x, (_, start, end) in enumerate(a):
            while low < len(b) and b[low][2] <= start:
                low += 1
            k = low
            while k < len(b) and b[k][1] < end:
                links.append((x, k))
                k += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        found.append((i, a, b, links, cuts))
    return found


def digests(rows):
    found = plain(rows)
    count = collections.Counter((a[x][0], b[y][0]) for _, a, b, links, _ in found for x, y in links)
    highest = collections.defaultdict(int)
    for (_, y), n in count.items():
        highest[y] = max(highest[y], n)
    out = []
    for i, a, b, links, cuts in found:
        groups = [("", "")] * 0
        for low, high in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(t) for t, _, end in side if low < end <= high) for side in (a, b)))
        ids = [(a[x][0], b[y][0]) for x, y in links]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((i, len(a), len(b), len(cuts), len(links), sum(count[p] == highest[p[1]] for p in ids), sum(count[p] for p in ids), digest))
    return out


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def short(rows):
    """The brute force goes through all groups of a text again and again; some 40 texts are enough."""
    return [r for r in rows if len(r[1]) < 3000][:40]


@pytest.mark.parametrize("block_bytes", [1, alignment.BLOCK_BYTES])
def test_digests_equal_brute_force(spark, rows, block_bytes):
    some = short(rows[0]) + [r for r in ODD if len(r[1] or "") < 1000]
    df = spark.createDataFrame([(*r, "x") for r in some], "doc_id long, text string, block string").repartition(3)
    found = alignment.alignment_digests(df, block_bytes=block_bytes)
    assert found.columns == NAMES
    assert sorted(map(tuple, found.collect()), key=str) == sorted(digests(some), key=str)


def test_tokens_and_links(spark, rows):
    some = short(rows[0]) + ODD
    df = spark.createDataFrame(some, "doc_id long, text string").coalesce(1)
    found = alignment.aligned(df).collect()
    for row, (i, a, b, links, cuts) in zip(found, plain(some), strict=True):
        assert row["doc_id"] == i and row["group_ends"] == cuts
        assert (row["a_ids"], row["a_ends"]) == ([t for t, *_ in a], [e for *_, e in a])
        assert (row["b_ids"], row["b_ends"]) == ([t for t, *_ in b], [e for *_, e in b])
        assert sorted(zip(row["link_a"], row["link_b"])) == links


def test_odd_tables(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    found = {(r["doc_id"], r["n_a"] > 0) for r in alignment.alignment_digests(df).collect()}
    assert {(1, False), (2, False), (4, False), (3, True), (9, True), (None, True)} <= found
    assert alignment.alignment_digests(df.limit(0)).count() == 0 and alignment.aligned(df.limit(0)).count() == 0
    none = alignment.alignment_digests(df.filter("doc_id in (1, 2, 4)")).collect()
    assert sorted(tuple(r)[1:] for r in none) == [(0, 0, 0, 0, 0, 0, "")] * 3
