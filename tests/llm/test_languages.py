"""Language filters: plain sets beside them, held-out accuracy, odd rows."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stayframe.llm import languages
from stayframe.llm.words import chunks


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def plain_grams(text):
    words = re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().lower())
    line = b"".join(b" " + w for w in words) + b" "
    return [line[k : k + n] for n in languages.SIZES for k in range(len(line) - n + 1)] if words else []


def plain(rows):
    """[(id, language, share)] by whole sets of n-grams instead of filters; a sample of all texts."""
    learned = [(lang, text) for i, text, lang in rows if not held_out(i) and text is not None and lang is not None]
    texts = {lang: {t for of, t in learned if of == lang} for lang, _ in learned}
    order = sorted(texts, key=lambda of: (-sum(x == of for x, _ in learned), of))
    share = {of: collections.Counter(g for t in texts[of] for g in set(plain_grams(t))) for of in order}
    kept = {of: set() for of in order}
    for gram in set().union(*share.values()):
        rate = {of: share[of][gram] / len(texts[of]) for of in order}
        for of in order:
            if share[of][gram] >= min(languages.LEAST, len(texts[of])) and rate[of] >= languages.SHARE * max(rate.values()):
                kept[of].add(gram)
    out = []
    for i, text, _ in rows:
        found = plain_grams(text)
        hits = [sum(g in kept[of] for g in found) / max(len(found), 1) for of in order]
        best = int(np.argmax(hits))
        if text is None or not any(c.isalpha() for c in text):
            out.append((i, "und", 1.0))
        else:
            out.append((i, order[best], hits[best] / (sum(hits) or 1)))
    return out


def test_grams_of_texts():
    texts = ["Ab c", None, "", "12 x!", "é", "a" * 9, "  ,"]
    for _, _, data, bounds in chunks(pa.array(texts)):
        found, text = languages.grams(data, bounds)
        wanted = [plain_grams(t) for t in texts]
        assert np.bincount(text, minlength=len(texts)).tolist() == list(map(len, wanted))
        assert len(set(found.tolist())) == len({g for w in wanted for g in w})


def test_as_whole_sets_would_decide(spark, tiny):
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows += [(None, "the of and", "en"), (10_001, None, "en"), (10_002, "", None), (10_003, "12 34 ,.", "en"), (10_004, "zzzz", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in languages.languages(df).collect()}
    for i, lang, share in plain(rows):
        row = found[i]
        assert row["lang_pred"] == lang and row["held_out"] == held_out(i)
        if i != 10_004:  # no known n-gram: the share of the most frequent language
            assert abs(row["score"] - share) < 0.01


def test_filters_hold_what_they_learned(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang")
    filters = languages.learn(docs, rows=1 << 15)  # crowded: many false positives, none missing
    assert 0.05 < filters.wrong.max() < 1
    hits = 0
    for lang in filters.names:
        texts = [r["text"] for r in docs.filter(f"lang = '{lang}'").collect()]
        for at, to, data, bounds in chunks(pa.array(texts)):
            _, shares = filters.shares(*languages.grams(data, bounds), to - at)
            best, _ = filters.decide(shares)
            hits += (best == filters.names.index(lang)).sum()
    assert hits >= 0.95 * docs.count()


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = languages.languages(docs.withColumn("held_out", languages.F.lit(1)))
    rows = found.join(docs, "doc_id").filter("held_out").select("lang", "lang_pred").collect()
    assert len(rows) > 300 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.99


def test_many_languages_and_none(spark):
    rows = [(k, f"{chr(97 + k % 26)}{chr(97 + k // 26)}xq words {k % 70}", f"l{k % 70:02d}") for k in range(700)]
    df = spark.createDataFrame([(k, " ".join([text] * 3).replace("words", text.split()[0] * 2), lang) for k, text, lang in rows],
                               "doc_id long, text string, lang string")
    filters = languages.learn(df)
    assert len(filters.names) == 70 and filters.table.shape[1] == 2
    none = languages.languages(df.withColumn("lang", languages.F.lit(None).cast("string"))).collect()
    assert len(none) == 700 and {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    assert languages.languages(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        languages.learn(spark.range(5000).selectExpr("cast(id as string) text", "cast(id as string) lang"))
