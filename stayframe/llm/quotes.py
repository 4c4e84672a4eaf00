"""Chat formatting by quotation linking.

Messages quote others with leading ``>`` signs, one for each level. A *passage* is a
run of consecutive lines of one level without blank lines. Passages are
normalised (lower case, white space as one space) and hashed; so are the single lines of
passages of several lines, so that part of a paragraph can be quoted.

A quoted passage is joined, within its conversation, to the latest earlier
message that has it as its own text. Both sides are sorted together and no pairs
are formed; a passage or conversation that holds a large share of all rows is laid
out in chunks (``operators.ordered``). A message's parent is what its shallowest linked quotes
name, the latest of these. Parents make *threads*, found by pointer jumping: the
number of rounds is the logarithm of the depth. A conversation in reply order is its threads
by their first turn, each by turn, so every reply follows what it quotes.

Built-in functions only. NULL texts have no lines. Messages with a NULL conversation or
turn are not linked. Rows with equal conversation and turn are one place of the
thread, and each is returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.asof import asof_join
from .tables import written

MARKS = r"^[ \t]*((?:>[ \t]?)+)"
SPACE = r"[\x09-\x0D\x20]+"
MAX_ROUNDS = 40


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _lines(text: Column) -> Column:
    """(level, raw, body) of every line."""
    def line(raw: Column) -> Column:
        marks = F.regexp_extract(raw, MARKS, 1)
        rest = F.when(marks == "", raw).otherwise(F.regexp_replace(raw, MARKS, ""))
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), raw.alias("raw"),
            F.trim(F.regexp_replace(F.lower(rest), SPACE, " ")).alias("body"))
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line)


def _passages(lines: Column) -> Column:
    """(level, hash) of every passage, and of every line of a passage of several lines."""
    def joins(i: Column, j: Column) -> Column:
        a, b = F.get(lines, i), F.get(lines, j)
        return F.coalesce((a["body"] != "") & (b["body"] != "") & (a["level"] == b["level"]), F.lit(False))

    at = F.sequence(F.lit(0), F.size(lines) - 1)
    full = F.filter(at, lambda i: F.get(lines, i)["body"] != "")
    starts = F.filter(full, lambda i: ~joins(i, i - 1))
    ends = F.filter(full, lambda i: ~joins(i, i + 1))
    key = lambda level, body: F.struct(level.alias("level"), F.md5(body.cast("binary")).alias("hash"))
    whole = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda r: key(
        F.get(lines, r["a"])["level"],
        F.array_join(F.transform(F.slice(lines, r["a"] + 1, r["b"] - r["a"] + 1), lambda x: x["body"]), " ")))
    single = F.transform(F.filter(full, lambda i: joins(i, i - 1) | joins(i, i + 1)), lambda i: key(
        F.get(lines, i)["level"], F.get(lines, i)["body"]))
    return F.concat(whole, single)


def _quotes() -> Column:
    """Whether any line of ``text`` starts with quotation marks."""
    return F.coalesce(F.col("text").rlike("(?:^|\n)[ \t]*>"), F.lit(False))


def parsed(messages: DataFrame) -> DataFrame:
    """All rows and columns plus ``_own`` (``text`` without quotes) and ``_quoted`` (quoted lines).

    A text without quotation marks is its own text as it stands.
    """
    lines = _lines(F.col("text"))
    quoted = F.size(F.filter(lines, lambda x: x["level"] > 0)).cast("long")
    own = F.array_join(F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["raw"]), "\n")
    return messages.withColumns({
        "_own": F.when(_quotes(), own).otherwise(F.col("text")), "_quoted": F.when(_quotes(), quoted).otherwise(F.lit(0).cast("long"))})


def parents(messages: DataFrame) -> DataFrame:
    """(conv, turn, parent) of the messages with a linked quote.

    Only conversations in which anything is quoted are cut into passages.
    """
    known = messages.select("conv", "turn", "text").filter("conv is not null and turn is not null")
    quoting = known.filter(_quotes()).select("conv").distinct()
    lines = known.join(quoting, "conv", "left_semi").select("conv", "turn", _lines(F.col("text")).alias("_lines"))
    passages = lines.select("conv", "turn", F.explode(_passages(F.col("_lines"))).alias("p")).select("conv", "turn", "p.*")
    passages = written(passages, "passages")
    quotes = passages.filter("level > 0").distinct()
    asked = quotes.select("conv", "hash").distinct()
    originals = passages.filter("level = 0").join(asked, ["conv", "hash"], "left_semi").select(
        "conv", "hash", F.col("turn").alias("at"), F.lit(0).alias("tie")).distinct()
    found = asof_join(quotes, originals, ["conv", "hash"], "turn", "at", [], "tie", strict=True)
    found = found.filter("at is not null").groupBy("conv", "turn").agg(F.min(F.struct("level", -F.col("at"))).alias("best"))
    return found.select("conv", "turn", (-F.col("best")["col2"]).alias("parent"))


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, parent, root, depth) by pointer jumping over ``parents`` rows."""
    state = written(links.select("conv", "turn", "parent", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "threads")
    for _ in range(MAX_ROUNDS):
        up = state.select(F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), F.col("root").alias("_root"), F.col("depth").alias("_depth"))
        joined = state.join(up, (F.col("conv") == F.col("_conv")) & (F.col("root") == F.col("_turn")), "left")
        if joined.filter("_root is not null").isEmpty():
            return state
        state = written(joined.select(
            "conv", "turn", "parent", F.coalesce("_root", "root").alias("root"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")), "threads")
    raise RuntimeError("threads: a chain of replies is too deep")


def linked(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message, in reply order: its thread, depth, parent, quotes, own text and chat form."""
    rows = messages.select(F.col(conversation).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
                           F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    placed = threads(parents(rows)).withColumnsRenamed({"conv": "_conv", "turn": "_turn"})
    out = parsed(rows).drop("text").join(placed, (F.col("conv") == F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left")
    chat = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("_own", F.lit("")))
    return out.select(
        F.col("conv").alias("conv_id"), "turn", "role", F.coalesce("root", "turn").alias("thread_turn"), F.col("parent").alias("parent_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), F.col("_quoted").alias("n_quoted_lines"),
        F.col("_own").alias("own_text"), chat.alias("chat")).orderBy("conv_id", "thread_turn", "turn")


_LEVEL = r"len(regexp_replace(regexp_extract(raw, '^[ \t]*((?:>[ \t]?)+)', 1), '[^>]', '', 'g'))"
ORACLE = rf"""
WITH RECURSIVE lines AS (
  SELECT conv_id, turn, i, raw, {_LEVEL}::BIGINT AS level,
    trim(regexp_replace(lower(regexp_replace(raw, '^[ \t]*((?:>[ \t]?)+)', '')), '[\x09-\x0D\x20]+', ' ', 'g')) AS body
  FROM (SELECT conv_id, turn, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM conversations)),
full_lines AS (SELECT *, i - row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY i) AS run FROM lines WHERE body <> ''),
passages AS (
  SELECT conv_id, turn, level, string_agg(body, ' ' ORDER BY i) AS body FROM full_lines GROUP BY conv_id, turn, level, run
  UNION SELECT conv_id, turn, level, body FROM full_lines),
found AS (
  SELECT q.conv_id, q.turn, q.level, max(o.turn) AS place
  FROM passages q JOIN passages o ON o.conv_id = q.conv_id AND o.body = q.body AND o.level = 0 AND o.turn < q.turn
  WHERE q.level > 0 GROUP BY q.conv_id, q.turn, q.level),
links AS (SELECT conv_id, turn, arg_min(place, level) AS parent FROM found GROUP BY conv_id, turn),
climb AS (
  SELECT conv_id, turn, parent, parent AS root, 1 AS depth FROM links
  UNION ALL
  SELECT c.conv_id, c.turn, c.parent, l.parent, c.depth + 1 FROM climb c JOIN links l ON l.conv_id = c.conv_id AND l.turn = c.root),
placed AS (SELECT conv_id, turn, any_value(parent) AS parent, arg_max(root, depth) AS root, max(depth) AS depth FROM climb GROUP BY conv_id, turn),
texts AS (
  SELECT conv_id, turn, role, text,
    len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '^[ \t]*>')))::BIGINT AS n_quoted_lines,
    CASE WHEN text IS NOT NULL THEN array_to_string(
      list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)) END AS own_text
  FROM conversations)
SELECT t.conv_id, t.turn, role, coalesce(root, t.turn) AS thread_turn, parent AS parent_turn, coalesce(depth, 0)::BIGINT AS depth,
  n_quoted_lines, own_text, '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(own_text, '') AS chat
FROM texts t LEFT JOIN placed p ON p.conv_id = t.conv_id AND p.turn = t.turn
"""
