"""Repeated strings and near copies against brute force."""

import hashlib
import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from stayframe.llm import components, nearcopies, repeats, tables


def digests(found):
    return [(i, n, gone, spans, hashlib.sha256(rest).hexdigest()) for i, n, gone, spans, rest in found]


def test_repeats_of_the_table(rows):
    texts, df = rows
    got = [tuple(r) for r in repeats.repeat_digests(df).collect()]
    assert sorted(got) == sorted(digests(brute.without_repeats(texts)))


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcd ") for _ in range(3000))
    rows = [
        (1, None), (2, ""), (3, "x" * 1000), (4, "x" * 399), (5, base), (6, base), (None, base[100:900] + "é" * 500),
        (7, base[:200] + "zz" + base[202:]), (7, base[:1000]), (8, "ab" * 300), (9, base[:150] + "q" + base[151:700])]
    return rows, spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, spans string")


@pytest.mark.parametrize("group_phrases", [repeats.GROUP_PHRASES, 2])
def test_repeats_of_odd_texts(odd, group_phrases):
    rows, df = odd
    found = repeats.repeated_spans(df, group_phrases=group_phrases)
    got = repeats.with_spans(df.select("doc_id", "text"), found, "doc_id", "text").mapInArrow(
        repeats._digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(digests(brute.without_repeats(rows)), key=str)


@pytest.mark.parametrize("group_phrases", [3, 10])
def test_a_passage_in_many_contexts(spark, group_phrases):
    """Its first and last phrases make groups of as many phrases as there are texts; contexts agree for some bytes."""
    rng = random.Random(9)
    passage, ends = "".join(rng.choice("abcdefg ") for _ in range(900)), ["".join(rng.choice("xyz ") for _ in range(500)) for _ in range(5)]
    rows = []
    for i in range(60):
        before, after = rng.choice(ends), rng.choice(ends)
        own = "".join(rng.choice("0123456789") for _ in range(rng.choice([0, 3, 40, 300])))
        rows.append((i, before[: rng.randrange(500)] + own + before[-rng.randrange(1, 60):] + passage + after[: rng.randrange(60)] + own[::-1] + after))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.with_spans(df, repeats.repeated_spans(df, group_phrases=group_phrases), "doc_id", "text").mapInArrow(
        repeats._digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    assert sorted(tuple(r) for r in found.collect()) == sorted(digests(brute.without_repeats(rows)))


def test_cutting_keeps_rows_columns_and_nulls(odd):
    rows, df = odd
    cut = repeats.without_repeats(df)
    assert cut.columns == df.columns
    wanted = [(i, None if t is None else rest.decode("utf-8", "ignore"))
              for (i, t), (_, _, _, _, rest) in zip(rows, brute.without_repeats(rows))]
    assert sorted(((r["doc_id"], r["text"]) for r in cut.collect()), key=str) == sorted(wanted, key=str)
    assert repeats.repeat_digests(df.limit(0)).count() == 0


def test_long_texts_are_parsed_in_parts(monkeypatch):
    data = np.frombuffer(random.Random(1).randbytes(9000), np.uint8)
    whole = {(int(f), int(l)) for f, l in zip(*repeats._phrases(data, np.array([0]), np.array([8601]), 400)[:2])}
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 1000)
    starts = set()
    for skip, part, begins, ends in repeats._parts(data, np.array([0, 9000]), 400):
        first, last, _, _ = repeats._phrases(part, begins, ends, 400)
        starts |= {skip + p for f, l in zip(first, last) for p in range(f, l + 1)}
    assert starts == {p for f, l in whole for p in range(f, l + 1)} == set(range(8601))


def test_near_copies_of_the_table(rows):
    texts, df = rows
    got = [tuple(r) for r in nearcopies.near_copies(df, shingle_words=4).collect()]
    assert sorted(got) == sorted(brute.near_copies(texts, 4))


@pytest.mark.parametrize("region", [nearcopies.REGION, 4])
def test_a_crowd_of_edited_copies(spark, region):
    """Copies with few to many edits; the small region makes it crowded, and nothing may get lost."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(400)]

    def edited(n):
        text = list(base)
        for _ in range(n):
            text[rng.randrange(400)] = rng.choice(words)
        return " ".join(text)

    rows = [(i, edited(rng.choice([1, 3, 8, 14, 20]))) for i in range(200)] + [
        (500, None), (501, ""), (502, "a b"), (503, "A  b\n"), (504, "a b c d e"), (504, "a b c d e"), (None, "a b"), (506, "  ")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component string")
    got = [tuple(r) for r in nearcopies.near_copies(df, shingle_words=5, region=region).collect()]
    assert sorted(got, key=str) == sorted(brute.near_copies(rows, 5), key=str)


def test_a_pair_that_is_no_link_hides_none(monkeypatch):
    """A row, and two members of another group with 79 and 80 of 100 shingles in common: the link has to come out."""
    rng = np.random.default_rng(7)
    low = np.unique(rng.integers(0, 1 << 32, 400, dtype=np.uint64))[rng.permutation(350)]
    own, near, link = low[:90], np.r_[low[:79], low[100:110]], np.r_[low[:80], low[120:130]]
    grid = np.stack([nearcopies.sketch(x) for x in (own, near, link)])
    one, two, crowded = nearcopies.strangers(np.array([1, 2, 2]), np.array([-1, 8, 8]), grid, 64, (80, 100))
    assert (one.tolist().count(0) or two.tolist().count(0)) and {0, 2} in [{a, b} for a, b in zip(one.tolist(), two.tolist())]
    assert not crowded and not nearcopies.alike(grid, 0, np.array([1, 2]), (80, 100))[1].any()


@pytest.mark.parametrize("region", [nearcopies.REGION, 4])
def test_a_crowd_of_short_edited_copies(spark, region):
    """Texts of 60 to 150 words, compared by whole sketches; many pairs are just above or below the limit."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for k in range(6):
        base = [rng.choice(words) for _ in range(rng.randrange(60, 151))]
        for i in range(60):
            text = list(base)
            for _ in range(rng.choice([1, 2, 3, 4, 5])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((100 * k + i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in nearcopies.near_copies(df, shingle_words=4, region=region).collect()]
    assert sorted(got) == sorted(brute.near_copies(rows, 4))


@pytest.mark.parametrize("region, wide", [(nearcopies.REGION, 16), (1000, 16), (nearcopies.REGION, nearcopies.WIDE)])
def test_a_region_that_spans_tasks(spark, monkeypatch, region, wide):
    """Pairs of copies with one template and one 4-value prefix, in a single tree that is cut into many ranges."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    template = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(400):
        tail = [rng.choice(words) for _ in range(12)]
        texts += [" ".join(template + tail), " ".join(template + tail[:9] + [rng.choice(words) for _ in range(3)])]
    sets = nearcopies.shingle_sets(pa.array(texts), 4)
    prefix = [nearcopies.signature(x)[: nearcopies.LEAST].tobytes() for x in sets]
    rows = [(i, t) for i, t in enumerate(texts) if prefix[i] == max(prefix, key=prefix.count)]
    rng.shuffle(rows)
    wanted = brute.near_copies(rows, 4)
    assert len(rows) > 200 and len({c for _, _, c in wanted}) < len(rows) - 50
    monkeypatch.setattr(nearcopies, "TREES", 1)
    monkeypatch.setattr(nearcopies, "SKETCHED_ROWS", 20)
    monkeypatch.setattr(nearcopies, "WIDE", wide)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in nearcopies.near_copies(df, shingle_words=4, region=region).collect()]
    assert sorted(got) == sorted(wanted)


def test_unlike_rows_of_one_prefix_do_not_meet(spark):
    """20,000 rows that share a boilerplate and nothing else, and a few near copies among them: work in proportion to the rows."""
    rng = np.random.default_rng(6)
    boilerplate, sketches = rng.integers(0, 1 << 32, 60, dtype=np.uint64), []
    for i in range(20_000):
        own = rng.integers(0, 1 << 32, 120, dtype=np.uint64)
        if i % 1000 == 7:  # nearly the row before
            own = np.r_[last[:115], own[:5]]
        last = own
        sketches.append(nearcopies.sketch(np.r_[boilerplate, own]).tobytes())
    df = spark.createDataFrame([(i, i, bytearray(s)) for i, s in enumerate(sketches)], "doc long, group long, sketch binary")
    buckets = nearcopies.written(nearcopies._rare_buckets(df, (80, 100)), "buckets")
    assert buckets.count() < 20_000
    regions = nearcopies._wide_regions(buckets).filter("outside > 0")
    pairs = nearcopies._wide_pairs(buckets, df.select(df.doc.alias("_doc"), "sketch"), nearcopies.written(regions, "regions"), (80, 100))
    found = {(r["a"], r["b"]) for r in pairs.collect()}
    assert found == {(i - 1, i) for i in range(7, 20_000, 1000)}


def test_alike_sketches_share_an_indexed_hash():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n, edits = int(rng.choice([10, 60, 150, 192, 260, 800])), rng.random() * 0.3
        a = rng.integers(0, 1 << 32, n, dtype=np.uint64)
        b = np.where(rng.random(n) < edits, rng.integers(0, 1 << 32, n, dtype=np.uint64), a)
        grid = np.stack([nearcopies.sketch(a), nearcopies.sketch(b)])
        if nearcopies.alike(grid, 0, np.array([1]), (80, 100))[0][0]:
            sets = [row[1:][row[1:] != nearcopies._PAD] for row in grid]
            count = nearcopies.needed(np.array([len(s) for s in sets]), grid[:, 0].astype(bool), (80, 100))
            order = [sorted(s.tolist(), key=lambda h: h * 2654435761 % (1 << 32))[:k] for s, k in zip(sets, count)]
            assert set(order[0]) & set(order[1])


def test_rows_with_one_id_are_one_node(spark):
    """Ids with several texts hold groups together; each of their texts has its own near copies."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    base = [[rng.choice(words) for _ in range(200)] for _ in range(8)]

    def edited(k):
        text = list(base[k])
        text[rng.randrange(200)] = "edit"
        return " ".join(text)

    rows = [(1, edited(0)), (1, edited(1)), (5, edited(0)), (2, edited(1)), (9, edited(2)), (9, edited(3)), (9, edited(3)),
            (20, edited(3)), (21, edited(2)), (30, edited(4)), (30, None), (30, ""), (31, edited(4)), (40, edited(5)), (41, edited(6)),
            (None, edited(5)), (None, edited(6)), (50, edited(7)), (51, edited(7)), (51, edited(6))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in nearcopies.near_copies(df, shingle_words=5).collect()]
    assert sorted(got, key=str) == sorted(brute.near_copies(rows, 5), key=str)
    assert {c for i, _, c in got if i in (1, 2, 5)} == {1} and {c for i, n, c in got if i in (41, 50) and n} == {41}


@pytest.fixture
def counted(spark):
    """Only what the code itself counts as small is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plans(monkeypatch, module):
    """(name, plan, rows) of each table that the module writes."""
    seen, write = [], module.written

    def writes(df, name):
        plan, table = df._jdf.queryExecution().executedPlan().toString(), write(df, name)
        seen.append((name, plan, table.collect() if name in ("open", "names") else []))
        return table

    monkeypatch.setattr(module, "written", writes)
    return seen


def test_only_crowded_regions_are_matched_again(spark, monkeypatch):
    """A crowd of edited copies, and couples that are no links: the couples are settled by the first round."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(300)]
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(rng.choice([1, 3, 8, 12])):
            text[rng.randrange(300)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    for k in range(60):
        own = [rng.choice(words) for _ in range(200)]
        rows += [(1000 + 2 * k, " ".join(own)), (1001 + 2 * k, " ".join(own[:160] + [rng.choice(words) for _ in range(40)]))]
    seen = _plans(monkeypatch, nearcopies)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in nearcopies.near_copies(df, shingle_words=4, region=4).collect()]
    assert sorted(got) == sorted(brute.near_copies(rows, 4))
    first, *later = [{r["doc"] for r in found} for name, _, found in seen if name == "open"]
    assert later and max(first) >= 1000 and all(max(x, default=0) < 1000 for x in later)
    assert not any("rangepartitioning" in plan for name, plan, _ in seen if name == "neighbours")


@pytest.mark.parametrize("most", [tables.BROADCAST_KEYS, 0])
def test_signatures_stay_where_they_are(spark, counted, monkeypatch, most):
    """Equal rows, copies and ids with several texts: one row for a class, with no exchange of its signature before the forest."""
    text = [" ".join(f"w{i * k}" for i in range(60)) for k in (1, 7, 11)]
    rows = [(1, text[0]), (1, text[0]), (1, text[1]), (2, text[0]), (3, text[1]), (4, text[2]), (4, text[2]), (None, text[2]), (5, ""), (5, None)]
    monkeypatch.setattr(tables, "BROADCAST_KEYS", most)
    seen = _plans(monkeypatch, nearcopies)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in nearcopies.near_copies(df, shingle_words=4).collect()]
    assert sorted(got, key=str) == sorted(brute.near_copies(rows, 4), key=str)
    names = next(found for name, _, found in seen if name == "names")
    assert len(names) == len({r["node"] for r in names}) == len({r["row"] for r in names}) == 3
    forest = next(plan for name, plan, _ in seen if name == "forest")
    assert ("hashpartitioning" in forest) == (most == 0)


@pytest.mark.parametrize("most", [tables.BROADCAST_KEYS, 0])
def test_places_of_few_groups_do_not_move(odd, counted, monkeypatch, most):
    rows, df = odd
    monkeypatch.setattr(tables, "BROADCAST_KEYS", most)
    seen = _plans(monkeypatch, repeats)
    assert sorted(map(tuple, repeats.repeat_digests(df).collect()), key=str) == sorted(digests(brute.without_repeats(rows)), key=str)
    hits = next(plan for name, plan, _ in seen if name == "repeats")
    assert ("Exchange hashpartitioning" in hits) == (most == 0)


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(3, text, 1), (2, text, 2), (9, "other words", 3), (None, text, 4)], "doc_id long, text string, keep int")
    kept = nearcopies.without_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["keep"] for r in kept.collect()) == [2, 3, 4]
    assert nearcopies.without_near_copies(df.limit(0)).count() == 0


@pytest.mark.parametrize("task_links", [components.TASK_LINKS, 20, 1])
def test_components_of_chains_and_stars(spark, task_links):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (5, 4)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long"), task_links).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 300, (2, 200))
    nodes, least = components.least_reachable(a, b)
    reach = {n: {n} for n in nodes}
    for x, y in zip(a, b):
        both = reach[x] | reach[y]
        for n in both:
            reach[n] = both
    assert {n: min(reach[n]) for n in nodes} == dict(zip(nodes, least))
