"""Sharding, chat formatting and quality rules: SQL on another engine, odd rows, plans."""

import collections

import duckdb
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from stayframe.llm import catalog, quotes, rules, sharding


def same_as_sql(df, con, sql):
    found = con.sql(sql)
    assert sorted(found.columns) == sorted(df.columns)
    wanted = sorted(found.fetchall(), key=str)
    assert sorted((tuple(r[c] for c in found.columns) for r in df.collect()), key=str) == wanted


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_same_rows_as_sql(spark, tiny, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tiny}/{table}.parquet'")
    same_as_sql(catalog.QUERIES[name](spark, tiny), con, catalog.ORACLES[name])


@pytest.mark.parametrize("name", ["op1_maglev_sharding", "op3_chat_quote_linking", "op9_quality_rules"])
def test_no_python_in_native_plans(spark, tiny, name):
    plan = catalog.QUERIES[name](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "ArrowEval", "MapIn"))


def test_quoted_messages(spark):
    rows = [
        (1, 0, "user", "Hello there\nsecond line\n\nNew  para"), (1, 1, "assistant", "> hello THERE\n> second line\nyes"),
        (1, 2, "user", ">> hello there\n>> second line\n> yes\nthanks"), (1, 3, "assistant", "> second line\nmore"),
        (1, 4, None, "> new para\n> > nested\n\n> unknown"), (1, 5, "user", "ok"), (1, 6, "user", "> thanks\nlast"),
        (2, 0, "user", "> hello there\nx"), (2, 1, "user", None), (2, 2, "user", ""), (3, 0, "u", "a"),
        (3, 1, "u", "> a\na"), (3, 2, "u", "> a\nb"), (None, 1, "u", "> a")]
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("conversations", frame)
    df = spark.createDataFrame([(*r, "p") for r in rows], "conv_id long, turn long, role string, text string, parent string")
    found = quotes.linked(df)
    same_as_sql(found, con, quotes.ORACLE)
    parents = {(r["conv_id"], r["turn"]): (r["parent_turn"], r["depth"]) for r in found.collect()}
    assert parents[1, 6] == (2, 3) and parents[2, 0] == (None, 0) and parents[3, 2] == (1, 2)
    assert [r["turn"] for r in found.filter("conv_id = 1").collect()] == [0, 1, 2, 3, 4, 6, 5]
    assert quotes.linked(df.limit(0)).count() == 0


def quoting(spark, folder):
    """Replies that quote earlier turns at one to three levels; one conversation has a third of the rows."""
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", F.substring("text", 1, 120).alias("text"))
    hot = F.col("conv_id") % 3 == 0
    rows = rows.select(F.when(hot, 0).otherwise(F.col("conv_id")).alias("conv_id"),
                       F.when(hot, F.col("conv_id") * 100 + F.col("turn")).otherwise(F.col("turn")).alias("turn"), "role", "text")
    order = Window.partitionBy("conv_id").orderBy("turn")

    def quoted(back, marks):
        lines = F.transform(F.split(F.lag("text", back).over(order), "\n"), lambda line: F.concat(F.lit(marks), line))
        return F.array_join(lines, "\n")

    kind = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4))
    parts = [F.when(kind >= 1, quoted(1, "> ")), F.when(kind >= 2, quoted(2, ">> ")), F.when(kind == 3, quoted(3, "> > > ")), F.col("text")]
    return rows.select("conv_id", "turn", "role", F.concat_ws("\n", *parts).alias("text"))


def test_quotes_of_real_conversations(spark, folder):
    df = quoting(spark, folder)
    frame = df.toPandas()
    con = duckdb.connect()
    con.register("conversations", frame)
    found = quotes.linked(df)
    same_as_sql(found, con, quotes.ORACLE)
    linked = found.filter("parent_turn IS NOT NULL").count()
    assert frame["conv_id"].value_counts().iloc[0] > len(frame) / 4 and linked > len(frame) / 2
    assert found.filter("n_quoted_lines > 0").count() >= linked


def test_rules_on_odd_texts(spark):
    long = "the of and to " * 400
    rows = [(1, None), (2, ""), (3, "a b c a b c"), (4, "a a a a"), (None, "x y z w"), (5, " \n\n a\n a\n b\n"), (6, long)]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_words int")
    same_as_sql(rules.quality_rules(df), con, rules.ORACLE)
    assert rules.passing(df).columns == df.columns and rules.passing(df).count() == 0
    assert rules.quality_rules(df.limit(0)).count() == 0
    plan = rules.quality_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_table_is_filled_by_turns():
    shards = [f"s{i}" for i in range(10)]
    table = sharding.lookup_table(shards)
    count = collections.Counter(table)
    assert len(table) == 1009 and set(count) == set(range(10)) and max(count.values()) - min(count.values()) <= 1
    fewer = sharding.lookup_table(shards[:-1], len(table))
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.25 * len(table)
    weighted = collections.Counter(sharding.lookup_table(["a", "b"], 101, [3, 1]))
    assert 70 <= weighted[0] <= 80
    with pytest.raises(ValueError):
        sharding.lookup_table([])


def test_placing_odd_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (None, None, "y"), (1, "a", "x")], "doc_id long, text string, shard string")
    placed = sharding.place(df, "doc_id", ["a", "b", "c"]).collect()
    assert len(placed) == 3 and len({r["shard"] for r in placed if r["doc_id"] == 1}) == 1
    assert sharding.place(df.limit(0), "doc_id").count() == 0
    sharding.write_shards(df, "doc_id", str(tmp_path / "out"), ["a", "b", "c"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
