"""Prefix trie of conversations: a z-fast trie built in batches, as DataFrame joins.

A *prefix* of a conversation is known by a 128-bit hash of its turns (role and text), made of
running sums, so that a conversation of any length is hashed in pieces. Equality of prefixes rests on these hashes.

*Trie.* Only compacted nodes are kept: prefixes where a conversation ends or two part. A node's edge
covers the depths from its parent's, left out, to its own. Its *handle* is its prefix at the
two-fattest of these depths: the one that the highest power of two divides.

*Batches.* Different conversations come in batches, each twice the one before. For each:

1. *Locate.* Fat binary search: look up the conversation's own prefix at the two-fattest depth of the open interval
   among the handles; go on below the node that is found, or above that depth. After
   a logarithmic number of rounds, each a join on (conversation, depth) and one on handles, what is left is the
   exit node: the edge on which the conversation leaves the trie, or where it ends. The
   last common depth on that edge comes from comparing prefixes with the edge's.
2. *Insert.* The exit depths split their edges, all of one edge at once. The prefixes below the exits are new; those of them
   where conversations of the batch end or part become nodes. A node's parent is the node
   before it on the same edge or conversation.

*Sums.* Members, leaves and lengths of subtrees are summed up by pointer doubling: after ``k`` rounds
a node has the sums of what is less than ``2**k`` nodes below, and knows its ancestor ``2**k`` above. No subtree or path
is gathered. *Expand.* Each edge gives one row for each of its depths, long edges in pieces.

A conversation with a third of all turns is numbered, hashed and searched in chunks (``operators.ordered``); the member
ids of a node with a third of all conversations are joined in pieces in many tasks, and one task
runs only the digest over them, in order.

NULL roles and texts are empty. Rows without a conversation id are left out. Turns are ordered by turn,
NULL first, then by content; equal rows are equal turns, each counted. No conversations give no
nodes, not even the root. Columns besides the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordered import Running, arrange, done, numbered, running
from ..operators.scale import MEASURE
from .tables import written

BATCHES = 2
#: how conversations and edges of many rows are laid out
LAYOUT = MEASURE
#: depths of an edge that one row expands to
EDGE = 10_000
#: ids joined in one piece
PIECE = 1_000
EMPTY = hashlib.sha256().hexdigest()
PARTS = ("s0", "s1", "s2", "s3")


def _root() -> Column:
    return F.lit(hashlib.md5(b"root").digest())


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv, pos, hash, points): place of each turn from 1 on, hash of role and text, code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    found = conversations.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.md5(F.concat(F.md5(role), F.md5(text))).alias("hash"), F.length(text).cast("long").alias("points"))
    ordered = numbered(found.filter("conv IS NOT NULL"), ["conv"], ["turn", "hash"], "pos", LAYOUT)
    return ordered.select("conv", F.col("pos").cast("int").alias("pos"), "hash", "points")


def shared_heads(found: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their hundred does: (convs(conv, n), paths(conv, depth, hash, points)).

    Conversation c gets the first h turns of conversation c - c % group, then its own after its first h; h = crc32(c) % most.
    """
    found = written(found, "turns")
    convs = found.groupBy("conv").agg(F.max("pos").alias("n"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    convs = convs.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    firsts = convs.filter("conv = base").select("base", F.col("n").alias("of"))
    convs = convs.join(firsts, "base", "left").withColumn("lent", F.least("h", F.coalesce("of", F.lit(0)))).drop("of")
    convs = written(convs.withColumn("all", F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "convs")
    heads = found.filter((F.col("pos") < most) & (F.col("conv") % group == 0)).withColumnRenamed("conv", "base")
    lent = convs.select("conv", "base", "h").join(heads, "base").filter("pos <= h").select("conv", F.col("pos").alias("depth"), "hash", "points")
    own = found.join(convs.select("conv", "h", "lent"), "conv").filter("pos > h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("lent")).alias("depth"), "hash", "points")
    return convs.select("conv", F.col("all").alias("n")), lent.unionByName(own)


def prefixes(paths: DataFrame) -> DataFrame:
    """(conv, depth, h, up, upto, points): hash of each prefix and of the one before it, code points so far."""
    mixed = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("hash")))
    parts = {p: F.conv(F.substring(mixed, 8 * i + 1, 8), 16, 10).cast("long") for i, p in enumerate(PARTS)}
    laid = arrange(paths.withColumns(parts).drop("hash"), ["conv"], ["depth"], LAYOUT)
    sums = [Running(f"_{c}", "sum", F.col(c)) for c in (*PARTS, "points")]
    laid = done(running(laid, ["conv"], ["depth"], sums))

    def key(own: bool) -> Column:
        return F.unhex(F.md5(F.concat_ws(",", *[F.col(f"_{p}") if own else F.col(f"_{p}") - F.col(p) for p in PARTS])))

    before = F.when(F.col("depth") == 1, _root()).otherwise(key(False))
    return laid.select("conv", "depth", key(True).alias("h"), before.alias("up"), F.col("_points").alias("upto"), "points")


def fattest(low: Column, high: Column) -> Column:
    """The number above ``low``, up to ``high``, that the highest power of two divides."""
    x = low.bitwiseXOR(high)
    for shift in (1, 2, 4, 8, 16):
        x = x.bitwiseOR(F.shiftright(x, shift))
    return high.bitwiseAND(F.bitwise_not(F.shiftright(x, 1)))


def _at(table: DataFrame, prefix: DataFrame, conv: str, depth: str, **names: str) -> DataFrame:
    """Columns of the prefix of conversation ``conv`` at ``depth``, renamed; only where there is one."""
    wanted = prefix.select(F.col("conv").alias("_conv"), F.col("depth").alias("_depth"), *[F.col(c).alias(n) for n, c in names.items()])
    return table.join(wanted, (F.col(conv) == F.col("_conv")) & (F.col(depth) == F.col("_depth"))).drop("_conv", "_depth")


def _doors(nodes: DataFrame, prefix: DataFrame) -> DataFrame:
    """Nodes by the hash of their handle (``fat``) and of the first prefix on their edge."""
    first = F.col("up_depth") + 1
    both = F.array(F.struct(F.lit(True).alias("fat"), fattest(F.col("up_depth"), F.col("depth")).alias("door")),
                   F.struct(F.lit(False).alias("fat"), first.alias("door")))
    return written(_at(nodes.select("*", F.inline(both)), prefix, "s", "door", key="h").drop("door"), "doors")


def _locate(batch: DataFrame, prefix: DataFrame, doors: DataFrame) -> DataFrame:
    """(s, n, low, node...): the deepest node that the conversation passes, and the edge it then enters, if any."""
    edge = ["x", "x_depth", "x_up", "x_up_depth", "x_s"]
    named = [F.col("h").alias("x"), F.col("depth").alias("x_depth"), F.col("up").alias("x_up"), F.col("up_depth").alias("x_up_depth"), F.col("s").alias("x_s")]
    fat, first = (doors.filter(which).select("key", *named) for which in ("fat", "NOT fat"))
    state = batch.select("s", "n", F.lit(0).alias("low"), F.col("n").alias("high"))
    settled, open_ = [], state.filter("low < high")
    settled.append(state.filter("low >= high").select("s", "n", "low"))
    out = None
    while not open_.isEmpty():
        probe = open_.withColumn("f", fattest(F.col("low"), F.col("high")))
        seen = _at(probe, prefix, "s", "f", key="h").join(fat, "key", "left").drop("key")
        ends = prefix.select(F.col("conv").alias("_conv"), F.col("depth").alias("_depth"), F.col("h").alias("_h"))
        seen = seen.join(ends, (F.col("s") == F.col("_conv")) & (F.col("x_depth") == F.col("_depth")), "left")
        whole = F.coalesce(F.col("_h") == F.col("x"), F.lit(False))
        step = seen.select(
            "s", "n", F.when(whole, F.col("x_depth")).otherwise(F.col("low")).alias("low"),
            F.when(F.col("x").isNull(), F.col("f") - 1).otherwise(F.col("high")).alias("high"),
            *[F.when(~whole, F.col(c)).alias(c) for c in edge])
        step = written(step, "search")
        exits = step.filter("x IS NOT NULL").select("s", "n", F.col("x_up_depth").alias("low"), *edge)
        out = exits if out is None else out.unionByName(exits)
        settled.append(step.filter("x IS NULL AND low >= high").select("s", "n", "low"))
        open_ = step.filter("x IS NULL AND low < high").select("s", "n", "low", "high")
    at = settled[0]
    for more in settled[1:]:
        at = at.unionByName(more)
    ended = at.filter("low = n")
    below = _at(at.filter("low < n").withColumn("_next", F.col("low") + 1), prefix, "s", "_next", key="h").drop("_next")
    below = below.join(first, "key", "left").drop("key")
    rows = below.unionByName(ended, allowMissingColumns=True)
    return written(rows if out is None else rows.unionByName(out), "exits")


def _common(exits: DataFrame, own: DataFrame, prefix: DataFrame) -> DataFrame:
    """The exits with the last depth and prefix that conversation and edge have in common."""
    on_edge = exits.filter("x IS NOT NULL").select("s", "n", "low", "x_s", "x_depth")
    rows = own.select(F.col("conv").alias("s"), F.col("depth").alias("d"), "h").join(on_edge, "s")
    rows = rows.filter("d > low AND d <= x_depth").select("s", "x_s", "d", "h")
    theirs = prefix.select(F.col("conv").alias("x_s"), F.col("depth").alias("d"), "h")
    last = rows.join(theirs, ["x_s", "d", "h"]).groupBy("s").agg(F.max(F.struct("d", "h")).alias("_last"))
    stay = F.struct(F.col("low").alias("d"), F.lit(None).cast("binary").alias("h"))
    found = exits.join(last, "s", "left").withColumn("_last", F.coalesce("_last", stay))
    found = found.select(*exits.columns, F.col("_last.d").alias("m"), F.col("_last.h").alias("m_h"))
    unnamed = found.filter("m_h IS NULL AND m > 0").drop("m_h")
    named = _at(unnamed, own, "s", "m", m_h="h").unionByName(found.filter("m_h IS NOT NULL"))
    return written(named.unionByName(found.filter("m_h IS NULL AND m = 0").withColumn("m_h", _root())), "common")


def _along(rows: DataFrame, by: str, up: str, up_depth: str) -> DataFrame:
    """The rows with the node before each of its group in depth, or the given one, as parent."""
    laid = arrange(rows, [by], ["depth"], LAYOUT)
    laid = done(running(laid, [by], ["depth"], [Running("_before", "last", F.struct("h", "depth"), inclusive=False)]))
    return laid.withColumns({"up": F.coalesce(F.col("_before.h"), F.col(up)),
                             "up_depth": F.coalesce(F.col("_before.depth"), F.col(up_depth))}).drop("_before")


NODE = ["h", "depth", "up", "up_depth", "s"]


def _insert(nodes: DataFrame | None, batch: DataFrame, prefix: DataFrame) -> DataFrame:
    """The nodes after one more batch of conversations."""
    own = written(prefix.join(batch.select(F.col("s").alias("conv")), "conv", "left_semi"), "batch")
    if nodes is None:
        exits = batch.select("s", "n", F.lit(0).alias("m"), _root().alias("m_h"))
        split = None
    else:
        found = _common(_locate(batch, own, _doors(nodes, prefix)), own, prefix)
        exits = found.select("s", "n", "m", "m_h")
        cut = found.filter("x IS NOT NULL AND m < x_depth")
        splits = cut.select("x", F.col("m_h").alias("h"), F.col("m").alias("depth"), "x_up", "x_up_depth", F.col("x_s").alias("s")).distinct()
        edges = cut.select("x", F.col("x").alias("h"), F.col("x_depth").alias("depth"), "x_up", "x_up_depth", F.col("x_s").alias("s")).distinct()
        split = written(_along(splits.unionByName(edges), "x", "x_up", "x_up_depth").select("x", *NODE), "splits")
    new = own.withColumnRenamed("conv", "s").join(exits, "s").filter("depth > m")
    new = written(new.select("s", "depth", "h", F.col("up").alias("before"), "n", "m", "m_h"), "new")
    parting = new.filter("depth > m + 1").select("before", "h", "depth").distinct()
    parting = parting.groupBy(F.col("before").alias("h")).count().filter("count > 1").select("h")
    explicit = parting.unionByName(new.filter("depth = n").select("h")).distinct()
    rows = _along(new.join(explicit, "h"), "s", "m_h", "m")
    made = rows.groupBy("h").agg(F.min(F.struct("s", "depth", "up", "up_depth")).alias("_node"))
    made = made.select("h", *[F.col(f"_node.{c}").alias(c) for c in ("depth", "up", "up_depth", "s")])
    if nodes is None:
        return written(made, "nodes")
    moved = split.filter("h = x").select("h", F.col("up").alias("_up"), F.col("up_depth").alias("_up_depth"))
    kept = nodes.join(moved, "h", "left").select(
        "h", "depth", F.coalesce("_up", "up").alias("up"), F.coalesce("_up_depth", "up_depth").alias("up_depth"), "s")
    return written(kept.unionByName(made).unionByName(split.filter("h <> x").select(*NODE)), "nodes")


def build(classes: DataFrame, prefix: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Compacted nodes (h, depth, up, up_depth, s) of different conversations (s, n); ``s`` passes the node. No root."""
    weight = (1 << batches) - 1
    place = F.pmod(F.xxhash64("s"), F.lit(weight))
    number = F.floor(F.log2(place + 1)).cast("int")
    numbered_classes = written(classes.filter("n > 0").select("s", "n", number.alias("batch")), "classes")
    nodes = None
    for i in range(batches):
        batch = numbered_classes.filter(F.col("batch") == i).select("s", "n")
        if not batch.isEmpty() or (nodes is None and i == batches - 1):
            nodes = _insert(nodes, batch, prefix)
    return nodes


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node as comma-joined texts."""
    for batch in batches:
        node, conv = batch.column(0), np.asarray(batch.column(1))
        if not len(conv):
            continue
        keys = node.to_pylist()
        change = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        cuts = [(i, min(i + PIECE, high)) for low, high in zip(change[:-1], change[1:]) for i in range(low, high, PIECE)]
        yield pa.RecordBatch.from_arrays([
            pa.array([keys[low] for low, _ in cuts], pa.binary()), pa.array([int(conv[low]) for low, _ in cuts], pa.int64()),
            pa.array([",".join(map(str, conv[low:high])) for low, high in cuts], pa.string())], ["h", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, which come in order; a node may go on in the next batch."""
    current, state = None, None
    for batch in batches:
        out = []
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if key != current:
                if state is not None:
                    out.append((current, state.hexdigest()))
                current, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _named(out)
    if state is not None:
        yield _named([(current, state.hexdigest())])


def _named(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    keys, texts = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.string())], ["h", "sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(h, sha256) over the sorted ids of the conversations that end at each node."""
    pieces = ends.select("h", "conv").repartitionByRange("h", "conv").sortWithinPartitions("h", "conv")
    pieces = written(pieces.mapInArrow(_joined_ids, "h binary, first long, ids string"), "pieces")
    laid = pieces.repartition("h").sortWithinPartitions("h", "first")
    return laid.mapInArrow(_digests, "h binary, sha256 string")


SUMS = ("n_convs", "n_leaves", "said", "edges")


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """(h, conv_id, n_convs, n_leaves, said, edges) of whole subtrees, from those of each node and its parent ``up``."""
    state = written(nodes.select("h", F.col("up").alias("anc"), "conv_id", *SUMS), "sums")
    while not (reach := state.filter("anc IS NOT NULL")).isEmpty():
        below = reach.groupBy(F.col("anc").alias("h")).agg(
            F.min("conv_id").alias("_conv_id"), *[F.sum(c).alias(f"_{c}") for c in SUMS])
        further = state.filter("anc IS NOT NULL").select(F.col("h").alias("anc"), F.col("anc").alias("_anc"))
        # the ancestor of the root's children is the root, above which there is nothing: no join for them
        up = reach.filter(F.col("anc") != _root()).select("h", "anc").join(further, "anc").select("h", "_anc")
        state = written(state.join(below, "h", "left").join(up, "h", "left").select(
            "h", F.col("_anc").alias("anc"), F.least("conv_id", "_conv_id").alias("conv_id"),
            *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in SUMS]), "sums")
    return state.drop("anc")


def trie(convs: DataFrame, paths: DataFrame, batches: int = BATCHES) -> DataFrame:
    """All prefixes of the conversations ``convs(conv, n)`` with turns ``paths(conv, depth, hash, points)``.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    smallest member, members, next turns, childless prefixes below, code points that are stored once instead of
    for each member, summed over the subtree, and a digest of the members that end here.
    """
    prefix = written(prefixes(paths), "prefixes")
    ends = _at(convs.filter("n > 0"), prefix, "conv", "n", h="h", upto="upto")
    ends = ends.unionByName(convs.filter("n = 0").select("*", _root().alias("h"), F.lit(0).cast("long").alias("upto")))
    ends = written(ends, "ends")
    classes = ends.groupBy("h").agg(F.min("conv").alias("s"), F.first("n").alias("n"), F.count("*").alias("members"), F.first("upto").alias("upto"))
    classes = written(classes, "ends")
    nodes = build(classes, prefix, batches)

    lengths = F.array(F.struct(F.lit(True).alias("own"), F.col("depth").alias("d")), F.struct(F.lit(False).alias("own"), F.col("up_depth").alias("d")))
    lengths = _at(nodes.select("h", "s", F.inline(lengths)), prefix, "s", "d", upto="upto")
    lengths = lengths.groupBy("h").agg(F.sum(F.when(F.col("own"), F.col("upto"))).alias("upto"), F.sum(F.when(~F.col("own"), F.col("upto"))).alias("up_to"))
    zero = F.lit(0).cast("long")
    nodes = nodes.join(lengths.select("h", "upto", F.coalesce("up_to", zero).alias("up_to")), "h")
    root = classes.limit(1).select(_root().alias("h"), F.lit(0).alias("depth"), F.lit(None).cast("binary").alias("up"), F.lit(-1).alias("up_depth"),
                                   F.lit(None).cast("long").alias("s"), zero.alias("upto"), zero.alias("up_to"))
    children = nodes.groupBy(F.col("up").alias("h")).agg(F.count("*").alias("n_children"))
    ended = classes.select("h", F.col("s").alias("conv_id"), F.col("members").alias("ended"), (F.col("members") * F.col("upto")).alias("said"))
    nodes = nodes.unionByName(root).join(children, "h", "left").join(ended, "h", "left")
    nodes = written(nodes.withColumns({"n_children": F.coalesce("n_children", zero), "ended": F.coalesce("ended", zero)}), "tree")
    sums = subtree_sums(nodes.select(
        "h", "up", "conv_id", F.col("ended").alias("n_convs"), (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        F.coalesce("said", zero).alias("said"), (F.col("upto") - F.col("up_to")).alias("edges")))
    nodes = written(nodes.drop("conv_id", "said").join(sums, "h"), "tree")

    top = nodes.filter("depth = 0").select("conv_id").first()
    above = nodes.filter("depth > 0 AND n_children > 0").select(F.col("h").alias("up"), F.col("conv_id").alias("up_conv"))
    low = nodes.filter(F.col("up") == _root()).withColumn("up_conv", F.lit(top["conv_id"] if top else None).cast("long"))
    nodes = nodes.filter(F.col("up") != _root()).join(above, "up").unionByName(low.select("up", *[c for c in low.columns if c != "up"])).unionByName(
        nodes.filter("depth = 0").withColumn("up_conv", F.lit(None).cast("long")))
    nodes = nodes.join(end_digests(ends), "h", "left")
    return _expanded(nodes, prefix)


def _expanded(nodes: DataFrame, prefix: DataFrame) -> DataFrame:
    """One row for each depth of each edge."""
    pieces = nodes.filter("depth > 0").withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("depth") - F.col("up_depth") - 1) / EDGE).cast("int"))))
    low = F.col("up_depth") + 1 + F.col("_piece") * EDGE
    rows = pieces.withColumn("d", F.explode(F.sequence(low, F.least(low + EDGE - 1, F.col("depth")))))
    rows = _at(rows, prefix, "s", "d", _upto="upto", _points="points").withColumn("_before", F.col("_upto") - F.col("_points"))
    root = nodes.filter("depth = 0").withColumns({"d": F.lit(0), "_before": F.lit(0).cast("long")})
    rows = rows.drop("_piece", "_upto", "_points").unionByName(root)
    last, first = F.col("d") == F.col("depth"), F.col("d") == F.col("up_depth") + 1
    saved = F.col("said") - F.col("n_convs") * F.col("_before") - F.col("edges") + F.col("_before") - F.col("up_to")
    return rows.select(
        "conv_id", F.col("d").cast("long").alias("depth"), F.when(first, F.col("up_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"), "n_leaves",
        saved.alias("saved_tokens"), F.when(last, F.coalesce("sha256", F.lit(EMPTY))).otherwise(F.lit(EMPTY)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """``trie`` of the conversations as they are."""
    found = written(turns(conversations, **columns), "turns")
    convs = found.groupBy("conv").agg(F.max("pos").alias("n"))
    return trie(written(convs, "convs"), found.withColumnRenamed("pos", "depth"))


def shared_trie(conversations: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``trie`` of the conversations with shared heads."""
    return trie(*shared_heads(turns(conversations)), batches)


#: CRC-32 of the decimal id, bit by bit: each byte, then eight steps
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
    flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: list_concat([ascii(ch)::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END))"""

ORACLE = f"""
WITH original AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(coalesce(role, '')) || md5(coalesce(text, '')))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM original)),
both_parts AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.role, o.text FROM convs c JOIN original o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.role, o.text FROM convs c JOIN original o ON o.conv_id = c.conv_id AND o.pos > c.h),
rebuilt AS (
  SELECT conv_id, length(text) AS points, md5(role) || md5(text) AS mark, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth
  FROM both_parts),
paths AS (
  SELECT conv_id, depth, points, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ended AS (SELECT conv_id, max(path) AS path FROM paths GROUP BY conv_id),
ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest FROM ended GROUP BY path),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(points) AS points FROM paths GROUP BY path, depth),
parents AS (SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(p.n_children, 0) AS n_children FROM nodes n LEFT JOIN parents p USING (path)),
above AS (SELECT left(path, 64 * i) AS path, n_children, (n_convs - 1) * points AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS i FROM counted)),
sums AS (SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved FROM above GROUP BY path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens,
  coalesce(e.digest, sha256('')) AS ends_sha256
FROM counted n JOIN sums s USING (path) LEFT JOIN ends e USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 64 * (n.depth - 1))
"""
