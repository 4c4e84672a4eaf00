"""Toxicity and quality: held-out accuracy, exact search, odd rows."""

import numpy as np
import pyarrow as pa
import pytest

from stayframe.llm import quality, toxicity


@pytest.fixture(scope="module")
def tables(spark, folder):
    return tuple(spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))


@pytest.fixture(scope="module")
def many(spark):
    """Tables with 97 held-out toxic rows; the smaller ones have ten, too few to measure on."""
    return tuple(spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))


def held_out_area(found, labels, label):
    """Area under the curve and accuracy on rows that were not learned from."""
    rows = found.join(labels, "doc_id").filter("held_out").select("score", "predicted", label).collect()
    ones = [r["score"] for r in rows if r[label] == 1]
    zeros = [r["score"] for r in rows if r[label] == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
    return wins / (len(ones) * len(zeros)), np.mean([r["predicted"] == r[label] for r in rows])


def test_toxicity_on_held_out_rows(many):
    area, accuracy = held_out_area(toxicity.toxicity(*many), many[1], "toxic")
    assert area > 0.93 and accuracy > 0.95


def test_quality_on_held_out_rows(many):
    area, accuracy = held_out_area(quality.quality(*many), many[1], "quality")
    assert area > 0.98 and accuracy > 0.95


def test_search_equals_all_cosines(tables):
    docs, labels = tables
    index = toxicity.fit(docs, labels).index
    rows = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    # all cosines of all features of the sample's texts, without the index
    vectors = list(toxicity._feature_counts(pa.array([rows[i] for i in index.ids]), index.known))
    dense = np.zeros((len(index.ids), len(index.known)))
    for i, (found, count, _) in enumerate(vectors):
        dense[i, found] = index.weights(found, count)
    texts = pa.array([*list(rows.values())[:200], None, "", "qqqq zzzz"])
    features = list(toxicity._feature_counts(texts, index.known))
    searched = list(index.search(features, 25))
    assert len(searched) == len(texts) and not any(len(best) for best, _ in searched[-3:])
    for (found, count, _), (best, cosine) in zip(features, searched):
        if len(found):
            every = np.round(dense[:, found] @ index.weights(found, count), 9)
            wanted = [i for i in np.lexsort((index.ids, -every))[:25] if every[i] > 0]
            assert list(best) == wanted and np.allclose(cosine, every[best])


def test_every_shared_word_finds_neighbours(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    index = model.index
    words = toxicity._feature_counts(pa.array([r["text"] for r in docs.select("text").collect()]))
    assert np.isin(np.unique(np.concatenate([f[w] for f, _, w in words])), index.known.words).mean() > 0.4
    ids = [int(i) for i in index.ids[index.labels == 1][:20]]
    copies = docs.filter(docs.doc_id.isin(ids)).select((docs.doc_id + 1_000_000).alias("doc_id"), "text")
    for row in toxicity.score(copies, model).select("doc_id", "toxicity.*").collect():
        assert row["doc_id"] - 1_000_000 in row["evidence"]  # whatever its words, the example itself is near
    rare = toxicity.score(spark.createDataFrame([("the",), (None,), ("zzzzqq",)], "text string"), model).collect()
    assert [r["toxicity"]["score"] == model.prior for r in rare] == [False, True, True]


@pytest.mark.parametrize("score", [toxicity.toxicity, quality.quality])
def test_odd_rows(spark, tables, score):
    df = spark.createDataFrame([(1, None, 0.1), (1, "", 0.2), (None, "some words\nhere", 0.3)], "doc_id long, text string, toxicity double")
    found = score(df, tables[1]).collect()
    assert len(found) == 3 and all(0 <= r["score"] <= 1 for r in found)
    assert score(df.limit(0), tables[1]).count() == 0
    assert score(df, tables[1].limit(0)).count() == 3
    odd = spark.createDataFrame([(1, None, None), (1, 1, 1), (None, 0, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    assert score(df, odd).count() == 3


def test_rejecting_keeps_the_columns(tables):
    kept = toxicity.without_toxic(*tables)
    assert kept.columns == tables[0].columns
    assert 0 < tables[0].count() - kept.count() < 0.2 * tables[0].count()
