"""Quality rules: a table of thresholds compiled into Spark columns.

Everything is one projection of built-in functions; no user function, shuffle or
sort of rows. A text is cut once into words and lines; measures are columns over these, and a rule is
a measure with a lower and an upper threshold, either of them open.

Repeated three-word windows are found from the sorted hashes of a text's
windows; only texts that have repeats sort them again with their positions. The
work for a text is n log n in its words, however repetitive it is.

NULL texts have no words and fail by length. Ratios of empty texts are 0. Rows that repeat an id are judged each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: fixed values: frequent words of English, French, German and Spanish
STOP_WORDS = (
    "the of and to a in is that it for as was with on be by an at are this from or "
    "le la les de des et un une du en que est pour dans qui par pas au "
    "der die das und zu den mit von für auf im ein eine ist nicht des "
    "el los las y que del se por con para una es no su"
).split()


@dataclass(frozen=True)
class Rule:
    """The text fails when ``measure`` is below ``low`` or above ``high``."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("too short", "n_words", low=50),
    Rule("repeated windows", "repeat_ratio", high=0.5),
    Rule("mean word length", "mean_word_chars", low=2, high=15),
    Rule("symbols per word", "symbol_ratio", high=0.1),
    Rule("repeated lines", "dup_line_ratio", high=0.5),
    Rule("stop words", "n_stop_words", low=2),
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _window(words: Column, i: Column) -> Column:
    return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))


def _covered(places: Column) -> Column:
    """Words in the three-word windows at the places, each word once."""
    steps = F.transform(F.sequence(F.lit(0), F.size(places) - 2), lambda k: F.least(F.lit(3), F.get(places, k + 1) - F.get(places, k)))
    return F.when(F.size(places) < 2, 3 * F.size(places)).otherwise(F.aggregate(steps, F.lit(3), lambda a, b: a + b))


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that the text has twice or more."""
    at = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.sort_array(F.transform(at, lambda i: _window(words, i)))
    any_twice = _let(hashes, lambda h: F.exists(at, lambda k: F.coalesce(F.get(h, k) == F.get(h, k + 1), F.lit(False))))
    placed = F.sort_array(F.transform(at, lambda i: F.struct(_window(words, i).alias("h"), i.alias("i"))))
    twice = _let(placed, lambda p: F.filter(
        F.transform(at, lambda k: F.when(
            (F.get(p, k)["h"] == F.get(p, k - 1)["h"]) | (F.get(p, k)["h"] == F.get(p, k + 1)["h"]), F.get(p, k)["i"])),
        lambda x: x.isNotNull()))
    covered = _let(F.sort_array(twice), _covered)
    return F.when(F.size(words) < 4, 0).when(any_twice, covered).otherwise(0)


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus one struct column ``_measures``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    has_word = lambda line: F.length(F.translate(line, " \t\n\x0b\x0c\r", "")) > 0
    lines = F.filter(F.split(text, "\n"), has_word)
    docs = docs.withColumns({"__text": text, "__words": words, "__lines": lines})
    bare = lambda column, signs: F.length(column) - F.length(F.translate(column, signs, ""))
    words, lines = F.col("__words"), F.col("__lines")
    stop = F.array(*map(F.lit, STOP_WORDS))
    docs = docs.withColumn("__counts", F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate("__text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        bare(F.col("__text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        _repeat_words(words).cast("long").alias("n_repeat_words"),
        F.size(F.array_intersect(F.transform(words, F.lower), stop)).cast("long").alias("n_stop_words")))
    c = F.col("__counts")
    ratio = lambda a, b: F.when(c[b] == 0, 0.0).otherwise(c[a] / c[b])
    docs = docs.withColumn("_measures", F.struct(
        "__counts.*", ratio("word_chars", "n_words").alias("mean_word_chars"), ratio("n_symbols", "n_words").alias("symbol_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"), ratio("n_repeat_words", "n_words").alias("repeat_ratio")))
    return docs.drop("__text", "__words", "__lines", "__counts")


def failed(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a measured row fails, as one column."""
    found = []
    for rule in rules:
        value, fails = F.col("_measures")[rule.measure], F.lit(False)
        if rule.low is not None:
            fails = fails | (value < rule.low)
        if rule.high is not None:
            fails = fails | (value > rule.high)
        found.append(F.when(fails, F.lit(rule.name)))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def passing(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that fail no rule, with all their columns as they are, whatever their names."""
    packed = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return measured(packed).filter(F.size(failed(rules)) == 0).select("row.*")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts, base_failed, kept, failed_rules) for every row."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    m = F.col("_measures")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words"]
    base = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return measured(slim).withColumn("_failed", failed()).select(
        "doc_id", *(m[c].alias(c) for c in counts), base.alias("base_failed"),
        (~base & (F.size("_failed") == 0)).alias("kept"), F.array_join("_failed", ",").alias("failed_rules"))


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
ORACLE = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM cut)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) AS r(k) GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, len(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    (len(body) - len(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(list_intersect(list_transform(words, lambda x: lower(x)), [{_STOPS}]))::BIGINT AS n_stop_words
  FROM cut LEFT JOIN repeated USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, array_to_string(list_filter([
    CASE WHEN n_words < 50 THEN 'too short' END,
    CASE WHEN n_words > 0 AND n_repeat_words / n_words > 0.5 THEN 'repeated windows' END,
    CASE WHEN n_words = 0 OR word_chars / n_words < 2 OR word_chars / n_words > 15 THEN 'mean word length' END,
    CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbols per word' END,
    CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'repeated lines' END,
    CASE WHEN n_stop_words < 2 THEN 'stop words' END], lambda x: x IS NOT NULL), ',') AS failed_rules
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, base_failed,
  NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
"""
