"""Best-fit-decreasing shards against brute force."""

import random
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from llm_rows import words

from watchledger.llm import queries, sharding

SMALL = "/root/testdata/sf0.001"


def one_by_one(sizes, capacity):
    """Rooms after best fit of single groups, every bin looked at."""
    rooms = []
    for size in sorted(sizes, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fits:
            rooms[min(fits)[1]] -= size
        else:
            rooms.append(max(capacity, size) - size)
    return rooms


def classes(sizes):
    count = Counter(sizes)
    falling = sorted(count, reverse=True)
    return falling, [count[s] for s in falling]


def filled(placed, sizes):
    bins = Counter()
    for c, bin, n in placed:
        bins[bin] += n * sizes[c]
    return bins


@pytest.mark.parametrize("seed", range(20))
def test_bulk_placement_equals_one_by_one(seed):
    rng = random.Random(seed)
    groups = [rng.choice([rng.randrange(1, 60), rng.randrange(1, 500), 40]) for _ in range(rng.randrange(1, 400))]
    capacity = rng.choice([500, 1000, 50])
    sizes, counts = classes(groups)
    placed = sharding.best_fit(sizes, counts, capacity)
    left = Counter(max(capacity, max((s for c, b, _ in placed for s in [sizes[c]] if b == bin), default=0)) - n for bin, n in filled(placed, sizes).items())
    assert left == Counter(one_by_one(groups, capacity))
    assert sum(n for *_, n in placed) == len(groups)


def test_rooms_stay_balanced():
    rng, rooms, kept = random.Random(1), sharding.Rooms(), set()
    for i in range(5000):
        if kept and rng.random() < 0.4:
            key = rng.choice(sorted(kept)) if i % 50 == 0 else next(iter(kept))
            kept.remove(key)
            rooms.remove(key)
        else:
            key = (rng.randrange(1000), i)
            kept.add(key)
            rooms.add(key)
        if i % 100 == 0:
            size = rng.randrange(1000)
            assert rooms.tightest(size) == min((k for k in kept if k[0] >= size), default=None)
            assert rooms.top[3] <= 1.45 * (len(kept) + 2).bit_length()


@pytest.mark.parametrize("seed", range(10))
def test_level_shards(seed):
    rng = random.Random(seed)
    groups = [int(rng.lognormvariate(5, 1.5)) + 1 for _ in range(3000)]
    sizes, counts = classes(groups)
    bins = filled(sharding.level_fit(sizes, counts, 16), sizes)
    assert len(bins) == 16 and sum(bins.values()) == sum(groups)
    shared = [b for b in bins.values() if not (b in groups and b > sum(groups) / 16)]  # without groups that stand alone
    assert max(shared) - min(shared) <= 50


def test_hot_groups_stand_alone():
    sizes, counts = classes([5000, 3000] + [10] * 800)
    bins = sorted(filled(sharding.level_fit(sizes, counts, 10), sizes).values())
    assert bins == [1000] * 8 + [3000, 5000]
    assert sharding.level_fit([], [], 16) == []
    assert filled(sharding.level_fit([7], [3], 16), [7]) == {0: 7, 1: 7, 2: 7}


def holds(rows, texts, even=None):
    """What any sharding must hold: every row once, sizes, checks, gapless slots, equal texts together."""
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == sorted(((i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t in texts), key=repr)
    slots, of = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        of[r.text_crc32, r.size].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())
    return Counter({s: sum(r.size for r in rows if r.shard == s) for s in slots})


def test_hostile_rows(documents, hostile, clashing):
    rows = [*hostile, *[(100 + i, "copy of one text", "en", "a") for i in range(300)]]
    out = sharding.sharding_report(clashing(documents(rows))).collect()
    holds(out, [r[:2] for r in rows])
    whole = sharding.shard_documents(clashing(documents(rows))).where("document.doc_id = 4").first()
    assert whole["document"]["size"] == "own size" and whole["document"]["text"] == words(1, 30_000)


def test_empty_table(documents):
    assert sharding.sharding_report(documents([])).count() == 0


def test_fixed_capacity(documents):
    rows = [(i, words(i, 1 + i % 40), "en", "a") for i in range(300)] + [(300, words(7, 900), "en", "a")]
    out = sharding.shard_documents(documents(rows), shards=None, capacity=2000).collect()
    used = Counter()
    for r in out:
        used[r.shard] += r.size
    groups = {r[1]: 0 for r in rows}
    for r in rows:
        groups[r[1]] += len(r[1]) + 1
    assert len(used) == len(one_by_one(list(groups.values()), 2000))
    assert sorted(used.values())[-2] <= 2000


def test_shards_are_written(spark, documents, tmp_path):
    sharding.write_shards(documents([(i, words(i, 30), "en", "a") for i in range(50)]), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and back.select("shard").distinct().count() == 4


def test_query_is_level(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op13_sharding(spark, SMALL).collect()
    used = holds(out, texts)
    groups = Counter()
    for _, t in texts:
        groups[t] += len((t or "").encode()) + 1
    assert len(used) == 16
    assert max(used.values()) <= max(max(groups.values()), sum(groups.values()) / 16 + 200)
