"""Users' columns come back as they are, whatever their names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stayframe.llm import decontaminate, nearcopies, quality, repeats, rules, toxicity

CLASHING = [
    "_score", "_spans", "__doc", "__key", "_items", "_n_hit", "__dropped", "__text", "_measures", "_row", "_text", "toxicity", "found",
    "spans", "doc", "key", "dropped", "hits", "row", "n_shingles", "node", "component", "quality", "evidence", "held_out", "label"]


@pytest.fixture(scope="module")
def clashing(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").limit(60)
    return docs.withColumns({name: F.concat(F.lit(f"{name} of "), F.col("doc_id")) for name in CLASHING})


def stages(spark, tiny):
    labels, items = (spark.read.parquet(f"{tiny}/{n}.parquet") for n in ("labels", "benchmark"))
    found = {name: lambda df, stage=stage: stage(spark, df, tiny) for name, stage in corpus_pipeline.STAGES[:-1]}
    return found | {
        "without_toxic": lambda df: toxicity.without_toxic(df, labels), "without_near_copies": nearcopies.without_near_copies,
        "without_repeats": repeats.without_repeats, "decontaminated": lambda df: decontaminate.decontaminated(df, items),
        "in blocks": lambda df: decontaminate.decontaminated(df, items, limit=200), "passing": rules.passing,
        "quality": lambda df: quality.score(df, quality.fit(df, labels, id_col="doc_id"), name="mine").drop("mine")}


@pytest.mark.parametrize("name", [*[n for n, _ in corpus_pipeline.STAGES[:-1]], "without_toxic", "without_near_copies",
                                  "without_repeats", "decontaminated", "in blocks", "passing", "quality"])
def test_columns_come_back(spark, tiny, clashing, name):
    out = stages(spark, tiny)[name](clashing)
    assert out.columns == clashing.columns and out.schema.simpleString() == clashing.schema.simpleString()
    rows = out.drop("text").collect()
    assert rows and all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in CLASHING)
