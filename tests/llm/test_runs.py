"""Periodic runs against brute force."""

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import CLASHING, words

from watchledger.llm import periodic_runs, queries
from watchledger.llm.common import DOCUMENT_COLUMNS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def brute(w):
    """Every run by trying every period: stretches that recur q later, with no smaller period."""
    found, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, w):
    h = crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def report(doc_id, text):
    w = WORD.findall(text or "")
    w = planted(doc_id, w) if doc_id is not None else w
    runs = brute(w)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def in_block(texts):
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    runs = periodic_runs.runs_of(np.array([x for t in texts for x in t], np.int64), bounds)
    return [[tuple(r[1:]) for r in runs.tolist() if r[0] == i] for i in range(len(texts))]


def composed(rng, n, letters):
    """Words with periodic stretches of many periods, some inside one another."""
    out = []
    while len(out) < n:
        if rng.random() < 0.5:
            out += [rng.randrange(letters) for _ in range(rng.randrange(1, 30))]
        else:
            unit = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 40]))]
            if rng.random() < 0.3:
                unit = unit * rng.randrange(2, 6) + [rng.randrange(letters)]
            out += (unit * 8)[: rng.randrange(len(unit), 8 * len(unit) + 1)]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [composed(rng, rng.choice([0, 1, 5, 30, 200, 700]), rng.choice([1, 2, 3, 50])) for _ in range(12)]
    assert in_block(texts) == [brute(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4))
def test_short_texts_equal_brute_force(texts):
    assert in_block(texts) == [brute(t) for t in texts]


def test_long_periods():
    rng = random.Random(5)
    unit = [rng.randrange(10**6) for _ in range(3000)]
    text = [-1 + 10**7, *unit * 4, *unit[:17], 10**7]
    assert in_block([text]) == [[(1, 4 * 3000 + 17, 3000)]]
    assert in_block([[7] * 100_000]) == [[(0, 100_000, 1)]]


def test_report_on_hostile_rows(documents, hostile):
    again = " ".join(["a b c"] * 500)
    rows = [*hostile, (20, again, "en", "a"), (21, again, "en", "a"), (21, again, "en", "a"), (22, "x\x0bx\x0cx\tx x\nx x x", None, None)]
    got = sorted((tuple(r) for r in periodic_runs.run_report(documents(rows)).collect()), key=repr)
    assert got == sorted((report(*r[:2]) for r in rows), key=repr)


def test_empty_table(documents):
    assert periodic_runs.run_report(documents([])).count() == 0


def test_columns_are_kept(documents, clashing):
    rows = [(1, "a b a b a b a b a b c", "en", "s"), (2, words(1, 50), None, None), (3, None, None, None)]
    out = periodic_runs.periodic_runs(clashing(documents(rows))).orderBy("doc_id").collect()
    assert [r["collapsed"] for r in out] == ["a b c", words(1, 50), ""]
    assert [tuple(x) for x in out[0]["runs"]] == [(0, 10, 2)]
    assert set(DOCUMENT_COLUMNS + CLASHING) <= set(out[0].asDict())
    assert out[0]["size"] == "own size"


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r.text or "") < 6000]
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, SMALL).collect()}
    for r in rows:
        assert got[r.doc_id] == report(r.doc_id, r.text)
