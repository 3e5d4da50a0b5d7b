"""Exact copies, near copies and repeated passages against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import CLASHING, rows_of, words

from watchledger.llm import exact_dedup, jaccard_join, suffix_dedup
from watchledger.llm.components import components


def lower(text):
    return (text or "").encode().lower()


# --- exact ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 3000])
def test_perfect_hash_is_minimal_and_perfect(n):
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), np.uint8).reshape(-1, 32)
    seeds, slots = exact_dedup.build_hash(digests)
    assert sorted(slots.tolist()) == list(range(n))
    assert (exact_dedup.find_slots(digests, seeds, n) == slots).all()


def exact_by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [2, 40_000])
def test_exact_groups(documents, hostile, clashing, monkeypatch, shard):
    monkeypatch.setattr(exact_dedup, "SHARD_DIGESTS", shard)
    found = exact_dedup.exact_dedup(clashing(documents(hostile)), exact_dedup.in_history())
    assert rows_of(found, "doc_id", "keep_id", "group_size", "text_sha256") == exact_by_hand(hostile)
    kept = Counter(r["text_sha256"] for r in found.where("kept").collect())
    assert set(kept.values()) == {1} and len(kept) == len({lower(r[1]) for r in hostile})


def test_first_load_goes_through_many_tasks(spark, monkeypatch):
    """With no history the new texts decide how many shards there are."""
    from pyspark.sql import functions as F

    seen = []
    look_up = exact_dedup.look_up
    monkeypatch.setattr(exact_dedup, "look_up", lambda index, groups, shards: seen.append((shards, groups)) or look_up(index, groups, shards))
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    assert exact_dedup.exact_dedup(docs, F.lit(False)).where("kept").count() == 200_000
    (shards, groups), = seen
    assert groups.groupBy(exact_dedup._shard(shards)).count().agg(F.max("count")).first()[0] <= 2 * exact_dedup.SHARD_DIGESTS


def test_winners_keep_all_columns(documents, hostile, clashing):
    docs = clashing(documents(hostile))
    kept = exact_dedup.keep_winners(docs, exact_dedup.in_history())
    assert kept.columns == docs.columns and kept.select(*[f"`{c}`" for c in CLASHING]).distinct().count() == 1
    best = {t: k for _, k, _, t in exact_by_hand(hostile)}
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(best.values(), key=repr)


def test_exact_on_empty_table_and_one_sided_history(documents):
    empty = documents([])
    assert exact_dedup.exact_dedup(empty, exact_dedup.in_history()).count() == 0
    assert exact_dedup.keep_winners(empty, exact_dedup.in_history()).count() == 0
    same = documents([(2 * i, "x") for i in range(50)])
    from pyspark.sql import functions as F

    for side in (F.lit(True), F.lit(False)):
        assert rows_of(exact_dedup.exact_dedup(same, side).where("kept"), "doc_id", "group_size") == [(98, 50)]


# --- near ----------------------------------------------------------------------------------------


def shingles(text):
    w = lower(text).split()
    return set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else ({tuple(w)} if w else set())


def near_by_hand(rows):
    """Set size and smallest reachable id per row (rows with null ids are left to the caller)."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    return sorted(((r[0], len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, r in enumerate(rows)), key=repr)


def edited(seed, n, edits):
    w = words(seed, n).split()
    for e in edits:
        w[e % n] = f"edit{e}"
    return " ".join(w)


NEAR = [(100 + i, edited(11, 120, range(i * 3, i * 3 + i % 4))) for i in range(24)] + [(200 + i, words(12, 40) + " " + words(50 + i, 20 + i)) for i in range(12)] + [
    (300 + i, " ".join(words(13, 100).split()[i * 4 :])) for i in range(12)]


@pytest.mark.parametrize("hot", [0, 9])
def test_near_components(documents, hostile, clashing, hot, monkeypatch):
    monkeypatch.setattr(jaccard_join.class_components, "__defaults__", (hot,))
    rows = hostile + NEAR
    found = jaccard_join.jaccard_join(clashing(documents(rows)))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == near_by_hand(rows)


def test_one_of_each_near_group_stays(documents, hostile, clashing):
    rows = hostile + NEAR
    docs = clashing(documents(rows))
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = Counter()
    seen = set()
    for i, n, c in near_by_hand(rows):
        if n == 0:
            want[i] += 1
        elif c not in seen:
            seen.add(c)
            want[c] += 1
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def test_links_inside_a_group(documents):
    """Short texts that differ after the prefix: the head is no neighbour of two classes that are each other's."""
    rows = []
    for i in range(150):
        base = words(1_000 + i, 9)
        rows += [(10 * i + 1, base + f" a{i} a{i}"), (10 * i + 2, base + f" b{i} b{i}"), (10 * i + 3, base + f" b{i} c{i}")]
    docs = documents(rows, 1).orderBy("doc_id").selectExpr("doc_id", "doc_id AS row", "text")
    sets = jaccard_join.written(jaccard_join.set_table(docs, np.zeros(jaccard_join.SLOTS, np.uint8)), "sets")
    groups = Counter(Counter((r["n"], r["prefix_id"]) for r in sets.collect()).values())
    assert groups[3] > 10  # all three classes in one group
    classes, roots = jaccard_join.class_components(sets, docs)
    found = roots.join(classes.select("row", "doc_id"), "row").groupBy("root").agg({"doc_id": "min", "*": "count"}).collect()
    assert sorted((r["min(doc_id)"], r["count(1)"]) for r in found) == sorted(x for i in range(150) for x in ((10 * i + 1, 1), (10 * i + 2, 2)))


def test_near_on_empty_table(documents):
    assert jaccard_join.jaccard_join(documents([])).count() == 0
    assert jaccard_join.keep_one(documents([])).count() == 0
    assert rows_of(jaccard_join.jaccard_join(documents([(1, None), (2, "")])), "doc_id", "component_id") == [(1, 1), (2, 2)]


def test_bitmap_bounds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
        a, b = np.unique(rng.choice(pool, 300)), np.unique(rng.choice(pool, 250))
        apart = sum(int(x).bit_count() for x in (jaccard_join.bitmap(a) ^ jaccard_join.bitmap(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))


def test_sketch_bounds_the_difference_of_sets_of_any_size():
    rng = np.random.default_rng(3)
    for n, m, other in [(1, 1, 0), (6, 5, 1), (300, 260, 40), (9_000, 7_500, 2_000), (40_000, 20_000, 20_000)]:
        a = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[:m], rng.integers(0, 1 << 64, other, dtype=np.uint64)]))
        d = len(np.setxor1d(a, b))
        apart = jaccard_join.bits_apart(jaccard_join.sketch(a), jaccard_join.sketch(b))
        assert 0.5 * d <= apart <= d
    # What the bitmap of 4,096 bits cannot tell: a third of a large set differs.
    assert apart * 175 > 25 * (len(a) + len(b))
    assert 2 * jaccard_join.bitmap(a, jaccard_join.WIDE_WORDS).size * 64 * 175 < 4 * 25 * (len(a) + len(b))


def test_near_group_comes_together_without_the_square(documents, monkeypatch):
    """The smallest set of every list links with nothing, the others with most of their kind."""
    base = words(31, 110).split()
    rows = [(i, " ".join(w if k != edit else f"n{i}" for k, w in enumerate(base))) for i, edit in enumerate([*range(2, 108)] * 2)]
    rows += [(1_000 + i, " ".join(base[:84])) for i in range(2)] + [(2_000 + i, " ".join(base[26:])) for i in range(2)]
    counts, kept = Counter(), jaccard_join.written

    def recorded(df, label):
        table = kept(df, label)
        counts[label] = max(counts[label], table.count())
        return table

    monkeypatch.setattr(jaccard_join, "written", recorded)
    found = jaccard_join.jaccard_join(documents(rows))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == near_by_hand(rows)
    assert counts["near"] < 5 * len(rows)


def near_rows(n, first=3_000):
    return [(first + i, " ".join([*words(900 + i // 3, 60).split(), f"n{i}"])) for i in range(n)]


@pytest.mark.parametrize("slices", [1, 4, 16])
def test_lists_in_slices_are_the_same(documents, hostile, monkeypatch, slices):
    """One slice of the tokens at a time: its written lists are smaller, and all of them are there."""
    monkeypatch.setattr(jaccard_join, "SLICES", slices)
    sizes, kept = [], jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, label: (label == "lists" and sizes.append(df.count()), kept(df, label))[1])
    rows = hostile + near_rows(60)
    assert rows_of(jaccard_join.jaccard_join(documents(rows)), "doc_id", "n_shingles", "component_id") == near_by_hand(rows)
    assert len(sizes) == slices and max(sizes) < 2 * sum(sizes) / slices + 50


def on_disk(spark):
    from pathlib import Path

    from watchledger.workspace import session_dir

    return {p for p in Path(session_dir(spark).removeprefix("file:")).glob("*") if p.is_dir()}


@pytest.mark.parametrize("drop", [lambda docs: jaccard_join.keep_one(docs), lambda docs: exact_dedup.keep_winners(docs, exact_dedup.in_history())])
def test_no_copy_of_the_texts_stays_behind(spark, documents, drop):
    """Afterwards the shared folder holds ids and digests, neither sets nor texts nor lists."""
    rows = near_rows(60) + [(5_000 + i, words(950, 2_000)) for i in range(4)]
    before = on_disk(spark)
    kept = drop(documents(rows))
    assert 1 < kept.count() < len(rows)
    left = {p.name.rsplit("-", 1)[0] for p in on_disk(spark) - before}
    assert not left & {"numbered", "sets", "lists", "members", "classes", "open", "rest", "wanted", "digests", "digest-index"}


def test_only_named_documents_are_shuffled(spark, documents):
    """Documents that no fate names pass by the join, whatever the size of the table of fates."""
    rows = [(i, words(i, 20)) for i in range(200)] + [(300 + i, words(0, 20)) for i in range(3)]
    kept = exact_dedup.keep_winners(documents(rows), exact_dedup.in_history())
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.split("Join LeftAnti")[0].count("MapInArrow") == 1
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(1, 200), 302]


def test_repeats_of_the_row_that_stays(documents):
    """Rows with the id and the set of the one that stays, in other words' order and case, go; so do null ids."""
    base = words(970, 40)
    rows = [(7, base), (7, base.upper()), (7, base + "  "), (8, base), (None, base), (None, base), (9, words(971, 40)), (9, words(972, 40)), (None, None), (None, "")]
    kept = [(r["doc_id"], (r["text"] or "").lower().strip()) for r in jaccard_join.keep_one(documents(rows)).collect()]
    assert sorted(kept, key=repr) == sorted([(7, base), (9, words(971, 40)), (9, words(972, 40)), (None, ""), (None, "")], key=repr)


def test_shuffle_files_of_ended_queries_are_gone(spark):
    from watchledger.llm.common import small_batches

    assert small_batches(spark).conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 200)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 200: 200, 300: 200}


# --- passages ------------------------------------------------------------------------------------


def passages_by_hand(rows, window):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    counts = Counter(t[k : k + window] for _, t in texts for k in range(len(t) - window + 1))
    out = []
    for i, t in texts:
        spans = suffix_dedup.merged((k, k + window) for k in range(len(t) - window + 1) if counts[t[k : k + window]] > 1)
        out.append((i, len(t), sum(z - a for a, z in spans), len(spans), hashlib.sha256(suffix_dedup.cut_out(t, spans)).hexdigest()))
    return sorted(out, key=repr)


PASSAGE = words(21, 70)
SHARED = [(400 + i, words(400 + i, 30) + " " + PASSAGE[i * 5 :] + " " + words(500 + i, 30)) for i in range(10)] + [
    (420, "ab" * 900), (421, "x" * 400), (422, "x" * 399), (423, PASSAGE + PASSAGE), (424, words(430, 150) + PASSAGE[:399]), (425, "é" * 300)]


@pytest.mark.parametrize("limits", [{}, {"group": 2}, {"buffer": 1024, "group": 3}, {"window": 40, "digit": 8, "step": 16}])
def test_passages(documents, hostile, clashing, limits):
    rows = hostile + SHARED
    found = suffix_dedup.suffix_dedup(clashing(documents(rows)), **limits)
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == passages_by_hand(rows, limits.get("window", 400))


def test_passages_on_empty_table(documents):
    assert suffix_dedup.suffix_dedup(documents([])).count() == 0
    assert rows_of(suffix_dedup.suffix_dedup(documents([(1, None)])), "doc_id", "n_bytes", "n_spans") == [(1, 0, 0)]


def test_sliding_minimum():
    keys = np.random.default_rng(2).integers(0, 1 << 60, 500, dtype=np.uint64)
    for width in (1, 2, 37, 500):
        assert suffix_dedup.sliding_minimum(keys, width).tolist() == [min(keys[i : i + width]) for i in range(len(keys) - width + 1)]
