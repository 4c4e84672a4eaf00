"""Decontamination, license scan and packing against plain versions."""

import random
import re
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayframe.llm import decontaminate, licenses, packing


def test_contamination_of_the_table(spark, rows, tiny):
    texts, df = rows
    items = spark.read.parquet(f"{tiny}/benchmark.parquet")
    wanted = brute.contamination(texts, [(r["item_id"], r["text"]) for r in items.collect()])
    assert sorted(tuple(r) for r in decontaminate.contamination(df, items).collect()) == sorted(wanted)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(1)
    words = ["a", "b", "cé", "d1", "e"]
    items = [(1, "a b"), (2, "A-b"), (3, None), (4, ""), (5, " ".join(rng.choice(words) for _ in range(14))),
             (None, "e e e"), (6, "d1"), (6, "cé cé cé a")]
    docs = [(k, " ".join(rng.choice([*words, "zz", "Q"]) for _ in range(rng.choice([0, 1, 3, 50, 400])))) for k in range(40)]
    docs += [(1, None), (1, "a b"), (None, "x a B y"), (7, items[4][1] * 3)]
    make = spark.createDataFrame
    return docs, items, make([(i, t, 1) for i, t in docs], "doc_id long, text string, _spans int"), make(items, "item_id long, text string")


def test_contamination_of_odd_texts(odd):
    docs, items, df, benchmark = odd
    got = sorted((tuple(r) for r in decontaminate.contamination(df, benchmark).collect()), key=str)
    assert got == sorted(brute.contamination(docs, items), key=str)
    phrases, blocks = decontaminate.phrase_table(benchmark, limit=3)
    assert blocks > 2 and phrases.groupBy("block").count().count() > 1
    assert sorted((tuple(r) for r in decontaminate.contamination(df, benchmark, limit=3).collect()), key=str) == got
    whole, parts = (decontaminate.decontaminated(df, benchmark, limit=n) for n in (500_000, 3))
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_cutting_and_empty_tables(odd):
    _, _, df, benchmark = odd
    cut = decontaminate.decontaminated(df, benchmark)
    assert cut.columns == df.columns and cut.count() == df.count()
    assert [r["text"] for r in cut.filter("doc_id is null").collect()] == ["x  y"]
    assert decontaminate.contamination(df.limit(0), benchmark).count() == 0
    assert decontaminate.contamination(df, benchmark.limit(0)).filter("contaminated").count() == 0


def test_fm_index_counts_and_places():
    rng = np.random.default_rng(4)
    symbols = rng.integers(0, 4, 500)
    index = decontaminate.FMIndex(np.r_[0, symbols, 0], 4)
    for size in (1, 2, 3, 5):
        for phrase in rng.integers(1, 4, (20, size)):
            low, high = index.search(phrase[None, :], np.array([size]))
            places = sorted(index.locate(np.arange(low[0], max(low[0], high[0]))) - 1)
            assert places == [k for k in range(500 - size + 1) if (symbols[k : k + size] == phrase).all()]


def test_base_phrases_and_labels(rows):
    texts, df = rows
    found = {r["doc_id"]: r for r in licenses.license_scan(df).collect()}
    for i, text in texts:
        words = brute.PLAIN.findall(brute.low(text))
        places = [(k, label) for phrase, label in licenses.BASE.items() for n in [len(phrase.split())]
                  for k in range(len(words)) if words[k : k + n] == phrase.split()]
        at, labels, r = [k for k, _ in places], {x for _, x in places}, found[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (
            len(words), len(at), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted(labels)) and labels <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1


def test_license_rules(spark):
    assert len(licenses.rules()) >= 300
    rows = [
        (1, None), (2, ""), (None, "the MIT\nLicense and Apache-License é"),
        (3, "Licensed under the GNU Lesser General Public License, version 2.1."), (4, "SPDX-License-Identifier: BSD-3-Clause"),
        (5, "no word on it; mit freundlichen Grüßen, a general public licensed thing")]
    df = spark.createDataFrame([(i, t, "l") for i, t in rows], "doc_id long, text string, labels string")
    got = {r["doc_id"]: (r["base_labels"], r["labels"], r["score"]) for r in licenses.license_scan(df).collect()}
    assert got == {1: ("", "", 0.0), 2: ("", "", 0.0), None: ("apache,mit", "apache,mit", 0.85),
                   3: ("gpl", "gpl,lgpl 2.1", 0.95), 4: ("", "bsd 3-clause", 1.0), 5: ("", "", 0.0)}
    assert licenses.license_scan(df.limit(0)).count() == 0


def plain_detections(text):
    """Every rule over the whole text, and containment by comparing each detection with all kept ones."""
    joined, table = " ".join(brute.PLAIN.findall(brute.low(text))), licenses.rules()
    found = [(m.start(), m.end(), i) for i, r in enumerate(table)
             for m in re.finditer(rf"(?<![^ ])(?:{r.pattern})(?![^ ])", joined) if m.end() > m.start()]
    kept = []
    for start, end, i in sorted(found, key=lambda d: (-table[d[2]].priority, d[0] - d[1], d[0])):
        if not any(a <= start and end <= b for a, b, _ in kept):
            kept.append((start, end, i))
    return sorted((joined[:a].count(" "), joined[:b].count(" ") + 1, table[i].label) for a, b, i in kept)


LICENSED = [
    ("BSD Zero Clause License", "0bsd"), ("Free Public License 1.0.0", "0bsd"), ("you can buy me a beer in return; if we meet some day, and "
     "you think this stuff is worth it, you can buy me a beer in return", "beerware"),
    ("GNU Library General Public License version 2", "lgpl 2.0"), ("under the terms of the GNU General Public License version 2 as published by the "
     "Free Software Foundation", "gpl 2.0 only"), ("with the Classpath exception", "gpl with classpath exception"),
    ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc by-nc-sa"), ("https://creativecommons.org/licenses/by/4.0/", "cc by"),
    ("the Software shall be used for Good, not Evil.", "jsonlicense"), ("This software is governed by the CeCILL-B license under French law", "cecill"),
    ("All advertising materials mentioning features or use of this software must display the following acknowledgement", "bsd 4-clause"),
    ("Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.", "apache 2.0"),
    ("same terms as Perl itself", "artistic"), ("This Font Software is licensed under the SIL Open Font License", "ofl"),
    ("Elastic License 2.0", "elastic"), ("for academic use only", "research only"), ("Datenlizenz Deutschland Namensnennung", "dl-de"),
    ("Mozilla Public License, v. 2.0", "mpl"), ("subject to the terms of the Mozilla Public License, v. 2.0", "mpl 2.0"),
    ("copyright restrictions: no known copyright restrictions", "public domain")]


def test_priority_and_containment(spark, rows):
    texts = [t for _, t in rows[0]] + [t for t, _ in LICENSED]
    texts += [" filler ".join(t for t, _ in LICENSED[k : k + 4]) for k in range(0, len(LICENSED), 2)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.license_scan(df).collect()}
    for i, text in enumerate(texts):
        assert sorted((d["start"], d["end"], d["label"]) for d in found[i]["detections"]) == plain_detections(text)
    for i, (text, label) in enumerate(LICENSED, len(rows[0])):
        assert label in found[i]["labels"].split(","), (text, found[i]["labels"])


def test_signatures_are_many_and_whole():
    written = {r.pattern for r in licenses.rules()}
    names = [p for _, name, short, _ in licenses.LICENSES for p in (name, short)]
    assert len(licenses.NOTICES) >= 130 and len(licenses.NOTICES) + len(set(names)) >= 250 and len(written) >= 430
    for label, _, _, pattern, keywords in licenses.NOTICES:
        words = {max(k.split(), key=len) for k in keywords}
        assert any(re.search(w, pattern.replace("[cs]", "s").replace("[sz]", "s")) for w in words), (label, pattern)


def sequences(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return by


@pytest.mark.parametrize("numbered_rows", [packing.NUMBERED_ROWS, 7])
def test_packing_of_the_table(rows, numbered_rows):
    texts, df = rows
    found = packing.pack(df, numbered_rows=numbered_rows).collect()
    tokens = sum(r["length"] for r in found)
    assert len(sequences(found, 2048)) <= tokens / 2048 * 1.01 + 1
    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reader.encode_special_tokens = True
    pieces = {}
    for r in found:
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, text in texts:
        ids, at = [*reader.encode(text, add_special_tokens=False).ids, 0], 0
        for r in sorted(pieces[i], key=lambda r: r["piece"]):
            assert r["start"] == at and zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
            assert r["length"] == 2048 or r["piece"] == 0
            at += r["length"]
        assert at == len(ids)


def test_packing_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "", 6), (None, "x y z", 7), (1, "", 6)], "doc_id long, text string, length int")
    found = packing.pack(df, with_ids=True).collect()
    assert [r["length"] for r in found].count(1) == 3 and len(sequences(found, 2048)) == 1
    assert packing.pack(df.limit(0)).count() == 0


def test_plan_is_best_fit_decreasing():
    import bisect

    rng = random.Random(2)
    for _ in range(100):
        capacity = rng.choice([5, 16, 100, 2048])
        counts = {rng.randint(1, capacity): rng.choice([1, 2, 7, 300]) for _ in range(rng.choice([1, 10, 60]))}
        bins = []
        for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
            at = bisect.bisect_left(bins, length)
            bisect.insort(bins, (bins.pop(at) if at < len(bins) else capacity) - length)
        rows = sorted(packing.plan(counts, capacity))
        used = set()
        for k, (length, low, each, first, _) in enumerate(rows):
            high = rows[k + 1][1] if k + 1 < len(rows) and rows[k + 1][0] == length else counts[length]
            used |= {first + (n - low) // each for n in range(low, high)}
        assert len(used) == len(bins)


def test_ids_equal_those_of_tokenizers():
    path = public_tokenizers.path("byte_bpe_50k.json")
    reader = Tokenizer.from_file(path)
    reader.encode_special_tokens = True
    rng, signs = random.Random(2), list(" \n\tab'sé1. 　\x1c!日<|,")
    texts = ["", "  ", " a", "a ", "a  b", " \n b", "<|endoftext|> a", "a" * 3000, "don't, I'll. '  s", "\x85 b", "thing, thing. x1."]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    ours = packing.ByteBPE(path)
    assert [np.frombuffer(ours.ids(t), "<u4").tolist() for t in texts] == [
        e.ids for e in reader.encode_batch(texts, add_special_tokens=False)]
