"""Near copies by an LSH forest over MinHash signatures.

1. Every text becomes its set of distinct word shingles (words lower-cased in
   A-Z, separated by white space). Texts with equal sets are one *class*, held by
   its smallest id, so groups of exact copies cost one row from here on.
2. A class has ``TREES`` signatures of ``DEPTH`` MinHash values. Each tree is the
   classes in the order of its signatures: one range-partitioned sort by (tree,
   signature, id). The id makes rows unique, so no prefix is too hot to split.
3. Neighbours in a tree with a longest common prefix of ``LEAST`` values or more
   are candidates. The depth adapts to the region: each class is first tried
   against one *hub* (the smallest id among those with the same prefix, as deep as
   it takes to have ``REGION`` rows or fewer); links found make components. In the second
   pass only neighbours in different components are tried, at the shallowest
   depth at which a class has ``REGION`` neighbours of other components or fewer.
   So a large group of near copies costs one row for each, not one for each pair.
   A region of ``WIDE`` rows or fewer is never cut between tasks. The rows of larger ones meet by what is rare in
   them instead (see ``_rare_buckets``): rows that share no more than a common prefix, a boilerplate, never meet. In a bucket of
   a rare hash the rows outside its largest component are dealt out in blocks, each against all blocks of the bucket.
4. Neighbours of the second pass are compared by sketches, the ``SKETCH`` smallest shingle hashes, before
   any row is made for them. Sets of that size or less are compared whole, by the exact test. Where such a pair
   would be a link even if one equal pair of 32-bit hashes were chance, one link
   from a row to each other component of its region is enough. For larger sets a pair is left out when the
   sample's similarity is ``DEVIATIONS`` standard deviations too low (a true pair with probability 3e-6).
   All pairs that remain are confirmed on the full shingle sets.

A pair of similarity 0.8 misses one tree's ``LEAST`` = 4 values with probability
0.59, and all 24 trees with 3e-6. The second pass is repeated on crowded regions while they still merge;
those that stay crowded are then matched in full, so no candidate is capped. A region that was not crowded is settled by one pass.

NULL and texts without words have the empty set and are linked with nothing. Rows
with one id are one node, whatever their texts: the links of all of them are its links. A NULL id is never linked and
its component is NULL. Sets are equal when their sizes and two 64-bit sums of hashes are; shingles are compared by
64-bit hashes. Texts are read whole, in chunks. Columns besides the id and the text are not read, and those of
``without_near_copies`` come back as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .tables import forget, free_name, keyed, partitions, small, tidy_memory, written
from .words import SPACED, chunks, mix, random_values, runs, signed, words_of

TREES, DEPTH, LEAST = 24, 8, 4
REGION = 64
SORTED_ROWS, SKETCHED_ROWS, WIDE = 200_000, 50_000, 2_048
UNCROWDED = 1 << 40
SKETCH, DEVIATIONS = 192, 4.5
_PAD = np.uint32(0xFFFFFFFF)

_MULTIPLIERS = (random_values(TREES * DEPTH, 21) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADDENDS = (random_values(TREES * DEPTH, 22) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct hashes of its shingles of ``n`` words."""
    for _, _, data, bounds in chunks(texts):
        words = words_of(data, bounds, SPACED)
        hashes, whole = runs(words.hash, words.first, n)
        for first, last in zip(words.first[:-1], words.first[1:]):
            if last - first >= n:
                yield np.unique(hashes[first:last][whole[first:last]])
            elif last > first:
                short, _ = runs(words.hash[first:last], np.array([0, last - first]), int(last - first), 7)
                yield short[:1]
            else:
                yield hashes[:0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a set, big-endian so that bytes sort like numbers."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_MULTIPLIERS), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 1024):
        part = low[at : at + 1024]
        np.minimum(least, (part[None, :] * _MULTIPLIERS[:, None] + _ADDENDS[:, None]).min(axis=1), out=least)
    return least.astype(">u4")


def sketch(shingles: np.ndarray) -> np.ndarray:
    """1 if the whole set fits (else 0), and its smallest 32-bit hashes, sorted and padded.

    A set with two shingles of one 32-bit hash counts as too large, so whole sketches never show too few equal shingles.
    """
    low = np.unique(np.minimum(shingles.astype(np.uint32), _PAD - np.uint32(1)))
    out = np.full(SKETCH + 1, _PAD)
    out[0] = len(low) == len(shingles) <= SKETCH
    out[1 : 1 + min(len(low), SKETCH)] = low[:SKETCH]
    return out


def alike(sketches: np.ndarray, row: int, others: np.ndarray, similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Which of the others may be links of the row; which of these are links by their whole sets, one chance hit or not."""
    mine, grid = sketches[row, 1:], sketches[others, 1:]
    whole = (sketches[row, 0] & sketches[others, 0]).astype(bool)
    last = _PAD - np.uint32(1)
    reach = np.minimum(np.where(sketches[others, 0], last, np.minimum(grid[:, -1], last)), last if sketches[row, 0] else mine[-1])
    seen = grid <= reach[:, None]
    both = (seen & (mine[np.minimum(np.searchsorted(mine, grid), SKETCH - 1)] == grid)).sum(axis=1)
    either = np.searchsorted(mine, reach, "right") + seen.sum(axis=1) - both
    part, of = similar
    spread = DEVIATIONS * np.sqrt(part * (of - part) * np.maximum(either, 1))
    kept = np.where(whole, of * both >= part * either, of * (both + 1) >= part * either - spread)
    return kept, whole & (of * (both - 1) >= part * (either + 1))


_SIGNED = "doc long, key long, n_shingles long, one long, two long, signature binary, sketch binary"


def _sign(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, one, two, signatures, sketches = [], [], [], [], []
            for shingles in shingle_sets(batch.column(2), n):
                size.append(len(shingles))
                one.append(int(mix(shingles + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
                two.append(int(mix(shingles ^ np.uint64(0x5555555555555555)).sum(dtype=np.uint64).view(np.int64)))
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
                sketches.append(sketch(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(one, pa.int64()),
                pa.array(two, pa.int64()), pa.array(signatures, pa.binary()), pa.array(sketches, pa.binary())],
                ["doc", "key", "n_shingles", "one", "two", "signature", "sketch"])
        tidy_memory()
    return run


def _prefixes(trees: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """Longest common prefix of each row with the one before; -1 in another tree."""
    differ = np.ones((len(grid), DEPTH + 1), bool)
    differ[1:, :DEPTH] = grid[1:] != grid[:-1]
    common = np.argmax(differ, axis=1)
    common[0] = -1
    common[1:][trees[1:] != trees[:-1]] = -1
    return common


def hubs(docs: np.ndarray, common: np.ndarray, region: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hub) of the rows that have neighbours: one pair for a row at most."""
    n = len(docs)
    hub, open_rows = np.full(n, -1, np.int64), np.ones(n, bool)
    for depth in range(LEAST, DEPTH + 1):
        run = np.cumsum(common < depth) - 1
        size = np.bincount(run)
        least = np.minimum.reduceat(docs, np.flatnonzero(np.r_[True, run[1:] != run[:-1]]))
        fits = open_rows & ((size[run] <= region) | (depth == DEPTH))
        hub[fits] = least[run[fits]]
        hub[fits & (size[run] == 1)] = docs[fits & (size[run] == 1)]
        if depth > LEAST:  # alone at this depth: the hub of the wider region serves
            alone = fits & (size[run] == 1)
            hub[alone] = wider[alone]
        wider = least[run]
        open_rows &= ~fits
    rows = np.flatnonzero(hub != docs)
    return rows, hub[rows]


def likely(groups: np.ndarray, sketches: np.ndarray, row: int, others: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """The others to be confirmed as links of the row: one for a group with sure links, else all that may be links."""
    linked, found = np.zeros(0, groups.dtype), [others[:0]]
    for at in range(0, len(others), 4096):
        part = others[at : at + 4096]
        kept, sure = alike(sketches, row, part, similar)
        names, first = np.unique(groups[part[sure]], return_index=True)
        new = ~np.isin(names, linked)
        linked = np.r_[linked, names[new]]
        found += [part[kept & ~np.isin(groups[part], linked)], part[sure][first[new]]]
    return np.concatenate(found)


def strangers(groups: np.ndarray, common: np.ndarray, sketches: np.ndarray, region: int,
              similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Pairs of rows with a common prefix and different groups, as (row, other row); a row of each region that was crowded.

    Only pairs with sketches ``similar`` enough are returned: one for a row and a group with sure links, else all.

    A region with ``region`` rows or fewer outside its largest group is matched in full: those
    rows with all of the region. A larger one is crowded: it is cut at the next depth, and at full
    depth rows are matched with the next two of other groups.
    """
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    crowded: list[int] = []

    def keep(row: int, others: np.ndarray) -> None:
        picked = likely(groups, sketches, row, others, similar)
        pairs.append((np.full(len(picked), row), picked))

    def region_pairs(low: int, high: int, depth: int) -> None:
        if high - low < 2:
            return
        found, which, count = np.unique(groups[low:high], return_inverse=True, return_counts=True)
        if len(found) < 2:
            return
        outside = np.flatnonzero(which != np.argmax(count))
        if len(outside) <= region:
            for k in outside:
                other = np.flatnonzero((which != which[k]) & ((which == np.argmax(count)) | (np.arange(len(which)) > k)))
                keep(low + int(k), low + other)
            return
        if depth == LEAST:
            crowded.append(low)
        if depth < DEPTH:
            cuts = [low, *(low + 1 + np.flatnonzero(common[low + 1 : high] <= depth)), high]
            for a, b in zip(cuts[:-1], cuts[1:]):
                region_pairs(a, b, depth + 1)
        else:
            change = np.flatnonzero(which[1:] != which[:-1])
            for step in (1, 2):
                at = change[change + step < high - low]
                at = at[which[at] != which[at + step]]
                for k in at:
                    keep(low + int(k), np.array([low + int(k) + step]))

    edges = np.flatnonzero(np.r_[common < LEAST, True])
    mixed = np.minimum.reduceat(groups, edges[:-1]) != np.maximum.reduceat(groups, edges[:-1])
    for low, high in zip(edges[:-1][mixed], edges[1:][mixed]):
        region_pairs(int(low), int(high), LEAST)
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), crowded
    one, two = (np.concatenate(x) for x in zip(*pairs))
    return one, two, crowded


def _columns(batches: list[pa.RecordBatch], names: list[str]) -> dict[str, np.ndarray]:
    table = pa.Table.from_batches(batches)
    out = {n: np.asarray(table[n]) for n in names}
    if "sketch" in table.column_names:
        out["sketch"] = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint32).reshape(-1, SKETCH + 1)
    if "signature" in table.column_names:
        out["grid"] = np.frombuffer(b"".join(table["signature"].to_pylist()), ">u4").reshape(-1, DEPTH)
    return out


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pair[:, 0], pa.int64()), pa.array(pair[:, 1], pa.int64())], ["a", "b"])


def _first_pass(region: int):
    """A sorted range of the forest to (doc, hub, tree, signature): rows with neighbours, and those at its ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        c = _columns(held, ["tree", "doc"])
        common = _prefixes(c["tree"], c["grid"])
        near = (common >= LEAST) | np.r_[common[1:] >= LEAST, False]
        near[:1] = near[-1:] = True
        rows, hub = hubs(c["doc"], common, region)
        to = np.full(len(near), -1, np.int64)
        to[rows] = hub
        has = np.zeros(len(near), bool)
        has[rows] = True
        at = np.flatnonzero(near)
        yield pa.RecordBatch.from_arrays([
            pa.array(c["tree"][at].astype(np.int32)), pa.array([x.tobytes() for x in c["grid"][at]], pa.binary()), pa.array(c["doc"][at]),
            pa.array(to[at], mask=~has[at])], ["tree", "signature", "doc", "hub"])
    return run


_FOUND, _FOUND_NAMES = "a long, b long, tree int, _prefix binary", ["a", "b", "tree", "_prefix"]


def _second_pass(region: int, similar: tuple[int, int]):
    """Whole regions to candidate pairs of different groups, and to the (tree, _prefix) of those that were crowded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        c = _columns(held, ["tree", "doc", "group"])
        one, two, crowded = strangers(c["group"], _prefixes(c["tree"], c["grid"]), c["sketch"], region, similar)
        pairs, n = _pairs(c["doc"][one], c["doc"][two]), len(crowded)
        yield pa.RecordBatch.from_arrays(
            [*pairs.columns, pa.nulls(len(pairs), pa.int32()), pa.nulls(len(pairs), pa.binary())], _FOUND_NAMES)
        prefixes = [x.tobytes() for x in c["grid"][crowded, :LEAST]]
        yield pa.RecordBatch.from_arrays([
            pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(c["tree"][crowded].astype(np.int32)),
            pa.array(prefixes, pa.binary())], _FOUND_NAMES)
    return run


def _across(similar: tuple[int, int]):
    """Cells of wide regions, each a block of outside rows (side 0) and one of all rows (side 1), to candidate pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        c = _columns(held, ["cell", "side", "doc", "group", "top"])
        edges = np.flatnonzero(np.r_[True, c["cell"][1:] != c["cell"][:-1], True])
        for low, high in zip(edges[:-1], edges[1:]):
            middle = low + np.searchsorted(c["side"][low:high], 1)
            docs, groups = c["doc"][middle:high], c["group"][middle:high]
            one, two = [docs[:0]], [docs[:0]]
            for row in range(low, middle):
                other = np.flatnonzero((groups != c["group"][row]) & ((groups == c["top"][row]) | (docs > c["doc"][row])))
                picked = likely(c["group"], c["sketch"], row, middle + other, similar)
                one.append(np.full(len(picked), c["doc"][row]))
                two.append(c["doc"][picked])
            yield _pairs(np.concatenate(one), np.concatenate(two))
    return run


def needed(sizes: np.ndarray, whole: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """How many of its rarest hashes a sketch needs in an index so that ``alike`` ones share one.

    Two sketches with ``both`` hashes in common and fewer than ``both`` left out of each index share an indexed one. A pair of whole sets
    needs ``both`` of the share ``similar`` of the larger one; a pair with a full sketch the least that ``alike`` lets pass of ``SKETCH``.
    """
    part, of = similar
    least = (part * SKETCH - DEVIATIONS * np.sqrt(part * (of - part) * SKETCH)) / of - 1
    exact = np.where(whole, -(-part * sizes // of), SKETCH)
    both = np.maximum(np.minimum(exact, np.floor(least)), 1)
    # one more for a set that lost a hash to a chance hit; small sets with such a hit are not whole, and indexed in full
    return np.where(whole | (sizes >= SKETCH), np.minimum(sizes - both + 2, sizes), sizes).clip(0).astype(np.int64)


def _hashes(similar: tuple[int, int]):
    """(doc, group, sketch) to (doc, group, indexed, hash): each hash of each sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grid = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, SKETCH + 1)
            row, at = np.nonzero(grid[:, 1:] != _PAD)
            sizes = np.bincount(row, minlength=len(grid))
            indexed = needed(sizes, grid[:, 0].astype(bool), similar)
            picked = pa.array(row)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(picked), batch.column(1).take(picked), pa.array(indexed[row].astype(np.int32)),
                pa.array(grid[row, at + 1].astype(np.int64))], ["doc", "group", "indexed", "hash"])
        tidy_memory()
    return run


def _rare_buckets(rows: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """(tree, _prefix, doc, group): the rows (doc, group, sketch) by their rarest sketch hashes, as regions of a tree -1.

    A prefix filter: every row stands under so many of its rarest hashes that rows ``alike`` meet under one (``needed``). Rarity is
    counted over all the rows; hashes of one row are left out, as nothing meets there.
    """
    hashes = written(rows.mapInArrow(_hashes(similar), "doc long, group long, indexed int, hash long"), "hashes")
    common = hashes.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
    rare = hashes.join(written(common, "common"), "hash", "left").withColumn("n", F.coalesce("n", F.lit(1).cast("long")))
    each = rare.groupBy("doc", "group", "indexed").agg(F.array_sort(F.collect_list(F.struct("n", "hash"))).alias("hashes"))  # SKETCH at most
    chosen = each.select("doc", "group", F.inline(F.slice("hashes", F.lit(1), F.col("indexed")))).filter("n > 1")
    return chosen.select(F.lit(-1).alias("tree"), F.col("hash").cast("string").cast("binary").alias("_prefix"), "doc", "group")


def _wide_regions(rows: DataFrame) -> DataFrame:
    """(tree, _prefix, top, outside, blocks, outer): each region's largest group, the rows outside it, and the blocks of all and of those."""
    sizes = rows.groupBy("tree", "_prefix", "group").agg(F.count("*").alias("n"))
    tops = sizes.groupBy("tree", "_prefix").agg(F.max(F.struct("n", "group")).alias("_top"), F.sum("n").alias("rows"))
    blocks = lambda n: F.ceil(n / F.lit(WIDE)).cast("long")
    return tops.select("tree", "_prefix", F.col("_top.group").alias("top"), "rows", (F.col("rows") - F.col("_top.n")).alias("outside")).select(
        "tree", "_prefix", "top", "rows", "outside", blocks(F.col("rows")).alias("blocks"), blocks(F.col("outside")).alias("outer"))


def _wide_pairs(rows: DataFrame, sketches: DataFrame, regions: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Candidate pairs of wide regions or buckets: all rows outside the largest group with all rows of the region."""
    n = regions.agg(F.sum(F.col("rows") * F.col("outer") + F.col("outside") * F.col("blocks"))).first()[0] or 0
    rows = rows.join(F.broadcast(regions) if small(regions) else regions, ["tree", "_prefix"])
    rows = rows.join(sketches, F.col("doc") == F.col("_doc"))
    own = lambda count: F.pmod(F.xxhash64("doc"), F.col(count))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    columns = ["tree", "_prefix", "doc", "group", "top", "sketch"]
    outside = rows.filter(F.col("group") != F.col("top")).select(
        *columns, F.lit(0).alias("side"), own("outer").alias("_outer"), each("blocks").alias("_block"))
    every = rows.select(*columns, F.lit(1).alias("side"), each("outer").alias("_outer"), own("blocks").alias("_block"))
    cells = outside.unionByName(every).select(
        F.xxhash64("tree", "_prefix", "_outer", "_block").alias("cell"), "side", "doc", "group", "top", "sketch")
    dealt = cells.repartition(partitions(n, SKETCHED_ROWS), "cell").sortWithinPartitions("cell", "side")
    return dealt.mapInArrow(_across(similar), "a long, b long")


def _confirm(n: int, similar: tuple[int, int]):
    """Rows (a, b, text_a, text_b) to the pairs whose sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similar[1] * (both := len(np.intersect1d(x, y, assume_unique=True))) >= similar[0] * (len(x) + len(y) - both) and both > 0
                for x, y in zip(shingle_sets(batch.column(2), n), shingle_sets(batch.column(3), n))]
            picked = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(picked), batch.column(1).take(picked)], ["a", "b"])
    return run


def _links(texts: DataFrame, names: DataFrame, pairs: DataFrame, n: int, similar: tuple[int, int]) -> DataFrame:
    """The pairs of classes that are near copies by their full sets; ``names(node, doc, key)`` has a text of each class."""
    ids = written(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "ids")
    wanted = written(names.join(F.broadcast(ids) if small(ids) else ids, "node", "left_semi"), "wanted")
    some = texts.join(F.broadcast(wanted) if small(wanted) else wanted, ["doc", "key"]).select("node", "text")
    some = written(some.dropDuplicates(["node"]), "texts")
    one, two = some.toDF("a", "text_a"), some.toDF("b", "text_b")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    found = written(both.mapInArrow(_confirm(n, similar), "a long, b long"), "confirmed")
    forget(some, wanted, ids)
    return found


def _bucket_hubs(buckets: DataFrame, crowded: DataFrame) -> DataFrame:
    """(a, b): each row outside the largest group of crowded buckets with the hub that most of its buckets name, one pair for a row."""
    inside = buckets.join(crowded.select("tree", "_prefix", "top"), ["tree", "_prefix"])
    hub = inside.filter(F.col("group") == F.col("top")).groupBy("tree", "_prefix").agg(F.min("doc").alias("hub"))
    votes = inside.filter(F.col("group") != F.col("top")).join(hub, ["tree", "_prefix"]).groupBy("doc", "hub").count()
    best = votes.groupBy("doc").agg(F.max_by("hub", F.col("count") * 4_000_000_000 - F.pmod(F.xxhash64("hub"), F.lit(4_000_000_000))).alias("hub"))
    return best.select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b"))


def _named_classes(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes (n_shingles, one, two, class, node) and rows (doc, n_shingles, node) of ``sets``.

    ``class`` is the smallest id of a class. ``node`` is its name: that id, or a hash where another class has
    the same smallest id, which takes rows with one id and other texts.
    """
    same = ["n_shingles", "one", "two"]
    kinds = sets.filter("n_shingles > 0 and doc is not null").groupBy(*same).agg(F.min("doc").alias("class"))
    kinds = written(kinds, "kinds")
    first = kinds.groupBy("class").agg(F.min("one").alias("_one"))
    node = F.when(F.col("one") == F.col("_one"), F.col("class")).otherwise(F.xxhash64("class", *same))
    classes = written(kinds.join(first, "class").select(*same, "class", node.alias("node")), "classes")
    return classes, written(sets.select("doc", *same).join(classes, same, "left").select("doc", "n_shingles", "node"), "rows")


def _holders(sets: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, doc, key, row) with one row of ``sets`` for each class, and (doc, signature, sketch) of these, ``doc`` being the node.

    Rows are picked by narrow columns. The wide ones are read where they lie as long as the rows that hold no class may be broadcast.
    """
    same = ["n_shingles", "one", "two"]
    narrow = sets.filter("n_shingles > 0 and doc is not null").select("row", "doc", "key", *same)
    names = narrow.join(classes, same).filter("doc = class").groupBy("node").agg(
        F.min("row").alias("row"), F.min_by("doc", "row").alias("doc"), F.min_by("key", "row").alias("key"))
    names = written(names.select("node", "doc", "key", "row"), "names")
    spare = written(narrow.select("row").join(names, "row", "left_anti"), "spare")
    other = written(names.filter("node <> doc").select("row", "node"), "other")
    own = sets.filter("n_shingles > 0 and doc is not null").select("row", "doc", "signature", "sketch")
    own = own.join(F.broadcast(spare) if small(spare) else spare, "row", "left_anti")
    own = own.join(F.broadcast(other) if small(other) else other, "row", "left")
    return names, own.select(F.coalesce("node", "doc").alias("doc"), "signature", "sketch")


def _links_of_ids(rows: DataFrame) -> DataFrame:
    """Links between the classes of rows with one id."""
    several = rows.filter("doc is not null and node is not null").groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    several = written(several.filter("a <> b").select("doc", "a"), "several")
    if several.isEmpty():
        return several.select("a", F.col("a").alias("b"))
    return written(rows.join(several, "doc").filter("node <> a").select("a", F.col("node").alias("b")).distinct(), "same_ids")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                similar: tuple[int, int] = (80, 100), region: int = REGION) -> DataFrame:
    """(doc, n_shingles, component) for every row of ``docs``.

    Two texts are linked when ``similar[1] * |intersection| >= similar[0] * |union|``.
    """
    texts = keyed(docs, id_col, text_col)
    sets = texts.mapInArrow(_sign(shingle_words), _SIGNED).withColumn("row", F.monotonically_increasing_id())
    sets = written(sets, "signatures")
    classes, of_rows = _named_classes(sets)
    names, holders = _holders(sets, classes)
    same_ids = _links_of_ids(of_rows)
    width = 4 * DEPTH
    rows = holders.select("doc", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.select("tree", F.substring("signature", F.col("tree") * width + 1, F.lit(width)).alias("signature"), "doc")
    order = ["tree", "signature", "doc"]
    n = partitions(classes.count() * TREES, SORTED_ROWS)
    forest = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    named = written(forest.mapInArrow(_first_pass(region), "tree int, signature binary, doc long, hub long"), "forest")

    # one hub for each class: the one that most trees name
    votes = named.filter("hub is not null").groupBy("doc", "hub").count()
    best = votes.groupBy("doc").agg(F.max_by("hub", F.col("count") * 4_000_000_000 - F.pmod(F.xxhash64("hub"), F.lit(4_000_000_000))).alias("hub"))
    hubs_of = written(best.select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b")).distinct(), "candidates")
    first = _links(texts, names, hubs_of, shingle_words, similar).unionByName(same_ids)
    groups = written(components(first), "groups")

    sketches = holders.select(F.col("doc").alias("_doc"), "sketch")
    links, tried, crowd, near = first, hubs_of, region, named.drop("hub")
    while True:
        # regions that are one component already have no pairs left
        labelled = near.join(groups, near["doc"] == groups["node"], "left").select(
            *order, F.substring("signature", 1, 4 * LEAST).alias("_prefix"), F.coalesce("component", "doc").alias("group"))
        regions = labelled.groupBy("tree", "_prefix").agg(
            F.min("group").alias("low"), F.max("group").alias("high"), (F.count("*") > WIDE).alias("wide"))
        regions = written(regions.filter("low <> high").select("tree", "_prefix", "wide"), "regions")
        open_rows = written(labelled.join(F.broadcast(regions) if small(regions) else regions, ["tree", "_prefix"]), "open")
        forget(regions, near)
        ids = written(open_rows.select(F.col("doc").alias("_doc")).distinct(), "ids")
        mine = sketches.join(F.broadcast(ids) if small(ids) else ids, "_doc", "left_semi")
        wide = not open_rows.filter("wide").isEmpty()
        inside, crowded = open_rows, False
        if wide:
            meeting = open_rows.filter("wide").select("doc", "group").distinct().join(mine, F.col("doc") == F.col("_doc"))
            buckets = written(_rare_buckets(meeting.select("doc", "group", "sketch"), similar), "buckets")
            sizes = written(_wide_regions(buckets).filter("outside > 0"), "wide")
            spread = sizes.filter(F.col("outside") <= crowd)
            crowded = not sizes.filter(F.col("outside") > crowd).isEmpty()
            inside = open_rows.filter("not wide")
        # what is left after the first round is crowded: more pairs to a row
        n = partitions(inside.count(), SKETCHED_ROWS if tried is hubs_of else min(SKETCHED_ROWS, 2 * WIDE))
        inside = inside.join(mine, F.col("doc") == F.col("_doc")).drop("_doc")
        # by hash: a sample for ranges would make the join a second time
        dealt = inside.repartition(n, "tree", "_prefix").select(*order, "group", "sketch").sortWithinPartitions(*order)
        again = written(dealt.mapInArrow(_second_pass(crowd, similar), _FOUND), "neighbours")
        pairs = again.filter("a is not null").select("a", "b")
        if wide:
            pairs = pairs.unionByName(_wide_pairs(buckets, mine, spread, similar))
            if crowded:
                pairs = pairs.unionByName(_bucket_hubs(buckets, sizes.filter(F.col("outside") > crowd)))
        pairs = pairs.distinct()
        pairs = written(pairs.join(tried, ["a", "b"], "left_anti"), "candidates")
        more = _links(texts, names, pairs, shingle_words, similar)
        tried = tried.unionByName(pairs)
        # a region that was not crowded has been matched in full: only the others can have more links
        left = again.filter("a is null").select("tree", "_prefix")
        if crowded:
            left = left.unionByName(open_rows.filter("wide").select("tree", "_prefix").distinct())
        left = written(left, "crowded")
        near = open_rows.join(F.broadcast(left) if small(left) else left, ["tree", "_prefix"], "left_semi").select(*order)
        crowded, confirmed = not left.isEmpty(), not more.isEmpty()
        if confirmed:
            links = links.unionByName(more)
            groups = written(components(links), "groups")
        if not crowded:
            break
        if not confirmed:
            if crowd == UNCROWDED:
                break
            crowd = UNCROWDED  # nothing left to merge: match what is crowded in full
    forget(sets, near, names, tried)
    least = classes.join(groups, "node").groupBy("component").agg(F.min("class").alias("least"))
    labels = classes.join(groups, "node", "left").join(least, "component", "left").select(
        "node", F.coalesce("least", "class").alias("least"))
    out = of_rows.join(labels, "node", "left")
    return out.select("doc", "n_shingles", F.when(F.col("doc").isNotNull(), F.coalesce("least", "doc")).alias("component"))


def near_copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; kept marks one id of each group."""
    found = near_copies(docs, id_col, text_col, shingle_words)
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        F.coalesce(F.col("doc") == F.col("component"), F.lit(True)).alias("kept"))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group; rows with a NULL id stay."""
    name = free_name(docs, "dropped")
    dropped = near_copy_groups(docs, id_col, text_col, shingle_words).filter("not kept").select(F.col("doc_id").alias(name))
    dropped = written(dropped.distinct(), "dropped")
    gone = F.broadcast(dropped) if small(dropped) else dropped
    return docs.join(gone, F.col(id_col).cast("long") == F.col(name), "left_anti")
