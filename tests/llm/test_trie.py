"""Prefix trie of conversations against a dictionary of prefixes."""

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from check import compare
from watchledger.llm import conversation_trie, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"
SMALL = "/root/testdata/sf0.001"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h, giver = crc32(str(c).encode()) % 4, c - int(c / abs(c) * (abs(c) % 20)) if c else 0
        out[c] = own.get(giver, [])[:h] + turns[h:]
    return out


def brute(rows):
    """Every prefix by itself."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        gain = (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += gain
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], sha(ends[p])) for p, m in members.items())


def result(df):
    return sorted(tuple(r) for r in df.collect())


def conversations(rng, n, length, texts):
    rows = []
    for c in rng.sample(range(-30, 4 * n), n):
        for t in range(rng.randrange(1, length)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(texts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "n", "length", "segment", "block"), [(1, 60, 7, 65_536, 10**6), (2, 80, 9, 65_536, 12), (3, 60, 10, 4, 10)])
def test_equals_brute_force(spark, seed, n, length, segment, block):
    """Whole, and with so small blocks and segments that most nodes are boundary nodes."""
    rng = random.Random(seed)
    rows = conversations(rng, n, length, ["a b", "c", "", "d e f"])
    turns, lengths = conversation_trie.rebuilt(conversation_trie.conversation_turns(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert result(conversation_trie.prefix_trie(turns, lengths, segment, block)) == brute(rows)


def test_hostile_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "hello you"), (1, 0, "user", "hello you"), (1, 0, "assistant", "hello you"), (None, 0, "user", "nobody"), (2, 3, "", ""), (2, None, "user", " "),
            (20, 0, "user", "start here"), (20, 1, None, "second turn \t of\nit"), (25, 0, "user", "own"), (39, 0, "x", "y"), (39, 1, "x", "y"), (7, 0, "u", "w" * 200_000), (8, 0, "u", "v " * 50_000)]
    rows += [(c, t, "user", f"same {t}") for c in range(100, 140) for t in range(5)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("token", "words", "position", "depth", "row", "key")})
    assert result(conversation_trie.trie_report(df)) == brute(rows)
    assert conversation_trie.trie_report(df.where("conv_id is null")).count() == 0


def test_hot_and_long(spark):
    """A third of all rows in one conversation, another third in copies of one."""
    rows = [(5, t, "user", f"turn {t % 70}") for t in range(300)] + [(c, t, "user", f"copy {t}") for c in range(1000, 1060) for t in range(5)]
    turns, lengths = conversation_trie.rebuilt(conversation_trie.conversation_turns(spark.createDataFrame(rows, SCHEMA)))
    assert result(conversation_trie.prefix_trie(turns, lengths, 150, 50)) == brute(rows)


def test_median_insertion_is_balanced():
    tree = conversation_trie.TernaryTree()
    tree.insert_sorted([[i] for i in range(1023)], [[1]] * 1023)
    height = lambda node: 1 + max(height(tree.low[node]), height(tree.high[node])) if node else 0
    assert height(tree.equal[0]) == 10
    assert len(tree.nodes()) == 1024


def test_query_equals_sql(spark):
    name = "op11_conversation_trie"
    assert compare(spark, name, queries.QUERIES[name], queries.SQL[name], SMALL).startswith("ok")
