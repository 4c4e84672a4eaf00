"""The pipeline against its plain stages."""

import brute

import __spark_entry__
import corpus_pipeline
from stayframe.llm import toxicity
from stayframe.llm.tables import written


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and [f"op{n}_" for n in range(1, 14)] == sorted(
        (x[: x.index("_") + 1] for x in names if x.startswith("op") and x[2].isdigit()), key=lambda x: int(x[2:-1]))


def test_stages_against_plain_versions(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    labels, items = (spark.read.parquet(f"{tiny}/{n}.parquet") for n in ("labels", "benchmark"))
    columns = docs.columns
    texts = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    (_, toxic), (_, near), (_, cut), (_, clean), (_, pack) = corpus_pipeline.STAGES

    kept = written(toxic(spark, docs, tiny), "kept")
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    assert texts(kept) == [(i, t) for i, t in texts(docs) if scores[i] < 0.5]

    single = written(near(spark, kept, tiny), "single")
    groups = brute.near_copies(texts(kept), 5)
    assert texts(single) == [(i, t) for (i, t), (_, _, c) in zip(texts(kept), groups) if i == c]

    shorter = written(cut(spark, single, tiny), "shorter")
    assert texts(shorter) == [(i, rest.decode("utf-8", "ignore")) for i, _, _, _, rest in brute.without_repeats(texts(single))]

    cleaned = written(clean(spark, shorter, tiny), "cleaned")
    found = brute.contamination(texts(shorter), [(r["item_id"], r["text"]) for r in items.collect()])
    assert [i for (i, a), (_, b) in zip(texts(shorter), texts(cleaned)) if a != b] == [x[0] for x in found if x[5]]
    assert all(df.columns == columns for df in (kept, single, shorter, cleaned))

    packed = pack(spark, cleaned, tiny)
    assert {r["doc_id"] for r in packed.collect()} == {i for i, _ in texts(cleaned)}
    whole = corpus_pipeline.run(spark, tiny)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole.collect()) == sorted(
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed.collect())
