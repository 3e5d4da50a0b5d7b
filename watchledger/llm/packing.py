"""Packing: optimal length buckets and token-budget batches.

A document of n words has n + 1 tokens (the end counts).  Documents longer than
``CONTEXT`` tokens are cut into full pieces and a rest, so nothing is lost and
the global histogram of piece lengths has at most ``CONTEXT`` entries whatever
the corpus.  Dynamic programming over the histogram chooses ``BUCKETS``
boundaries with the least padding.  Inside a bucket the pieces, in order of
(doc_id, row number, piece), fill batches of ``BUDGET // boundary`` sequences.

The order comes from range partitioning with offsets per slice, so a bucket with
a third of all rows is no single task.  Null and empty texts are one end token.
Repeated rows and ids are packed once each; an empty table gives no rows; columns
besides doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import WORD, written
from watchledger.operators.ordering import running_total

CONTEXT = 2048
BUCKETS = 8
BUDGET = 65_536


def pieces(docs: DataFrame, context: int = CONTEXT) -> DataFrame:
    """doc_id, row, piece, first_token, length: every document cut at the context length."""
    tokens = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long") + 1
    counted = docs.select(F.col("doc_id").cast("long"), tokens.alias("doc_tokens"), F.monotonically_increasing_id().alias("row"))
    counted = written(counted, "token-counts")
    cut = counted.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("doc_tokens") - 1) / context))))
    first = F.col("piece") * context
    return cut.withColumn("first_token", first).withColumn("length", F.least(F.lit(context), F.col("doc_tokens") - first).cast("long"))


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` ranges of the sorted ``lengths`` that minimise the summed padding.

    cost(i, j) pads lengths i..j to lengths[j].  Each round adds one bucket; the
    best split moves right with j, so divide and conquer takes L log L steps.
    """
    n = len(lengths)
    if not n:
        return []
    size, count = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    upto = np.concatenate([[0], np.cumsum(count)])
    words = np.concatenate([[0], np.cumsum(count * size)])
    best = size * upto[1:] - words[1:]  # one bucket for lengths 0..j
    splits = []
    for _ in range(min(buckets, n) - 1):
        new, at = best.copy(), np.full(n, -1)
        stack = [(1, n - 1, 0, n - 2)]
        while stack:
            lo, hi, first, last = stack.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(first, min(last, j - 1) + 1)  # the new bucket holds i+1..j
            cost = best[i] + size[j] * (upto[j + 1] - upto[i + 1]) - (words[j + 1] - words[i + 1])
            k = int(i[np.argmin(cost)])
            if cost.min() < new[j]:
                new[j], at[j] = cost.min(), k
            stack += [(lo, j - 1, first, k), (j + 1, hi, k, last)]
        splits.append(at)
        best = new
    ends, j = [], n - 1
    for at in reversed(splits):
        if at[j] >= 0:
            ends.append(int(size[j]))
            j = int(at[j])
    return sorted([*ends, int(size[j])])


def pack(docs: DataFrame, context: int = CONTEXT, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per piece: doc_id, piece, first_token, n_tokens, bucket, padded_length, batch, slot."""
    if budget < context:
        raise ValueError("the token budget must hold one sequence of the context length")
    cut = pieces(docs, context)
    histogram = cut.groupBy("length").count().collect()  # at most ``context`` rows
    by_length = sorted((r["length"], r["count"]) for r in histogram)
    ends = best_boundaries([a for a, _ in by_length], [b for _, b in by_length], buckets) or [context]
    bounds = F.array(*map(F.lit, ends))
    bucket = F.array_size(F.filter(bounds, lambda e: e < F.col("length")))
    placed = cut.withColumn("bucket", bucket.cast("int")).withColumn("padded_length", F.get(bounds, F.col("bucket")).cast("long"))
    ordered = running_total(placed, ["doc_id", "row", "piece"], F.lit(1), by=["bucket"], out="_place")
    place = F.col("_place") - 1
    room = F.floor(F.lit(budget) / F.col("padded_length"))
    return ordered.select(
        "doc_id", "piece", "first_token", F.col("length").alias("n_tokens"), F.col("bucket").cast("long").alias("bucket"), "padded_length",
        F.floor(place / room).alias("batch"), (place % room).cast("long").alias("slot"))
