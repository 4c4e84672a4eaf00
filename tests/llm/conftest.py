import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from stayframe.llm.tables import ship_code

    ship_code(spark)


@pytest.fixture(scope="session")
def rows(spark, tiny):
    """(id, text) of the smallest documents table, and the frame."""
    df = spark.read.parquet(f"{tiny}/documents.parquet")
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], df
