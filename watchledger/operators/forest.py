"""Isolation forest as a Spark job.

1. Every row gets two 32-bit numbers from md5 of its key; they give its place in
   the order of each tree, without further hashing.  A tree takes the ``sample``
   rows with the lowest places of the whole table (a filter on the place first,
   so that only a few more rows than needed are moved).
2. Each tree grows in its own task.  Split feature and cut come from md5 of the
   tree and the node, so the forest is the same on any engine and partitioning.
3. The grown forest (100 trees of at most 511 nodes, a fixed size) is shipped to
   the executors, which score rows, or distinct feature combinations where these
   are few, in Arrow batches.  Path lengths are summed as integers.
4. The label threshold is an exact weighted quantile over the scores.

Per-feature scaling is left out: a random split between minimum and maximum
isolates the same rows on any affine scale.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.operators.ordering import exact_quantiles
from watchledger.workspace import materialize

# Tasks receive the functions of this module by value: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES = 100
SAMPLE = 256
DEPTH = 8  # ceil(log2(SAMPLE))
SLOTS = 2 ** (DEPTH + 1) - 1
#: Places in a tree's order are integers below this prime.
PLACES = 4_294_967_291
#: Path lengths are kept in whole units of this size.
UNIT = 1e-6
_EULER = 0.5772156649015329


def average_path(n):
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    long = 2 * (np.log(safe - 1) + _EULER) - 2 * (safe - 1) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays over heap slots: split feature (-1 for a leaf), threshold, path length."""

    features: tuple[str, ...]
    split: np.ndarray
    threshold: np.ndarray
    path: np.ndarray
    norm: float


def _random(*parts) -> tuple[float, float]:
    """Two numbers in [0, 1) from md5 of the parts."""
    digest = hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()
    return int(digest[:8], 16) / 2**32, int(digest[8:16], 16) / 2**32


def _grow(tree: int, points: np.ndarray, seed: int) -> list[tuple]:
    """Nodes of one tree grown from its sample."""
    nodes, pending = [], [(0, 0, np.arange(len(points)))]
    while pending:
        slot, depth, rows = pending.pop()
        inside = points[rows]
        lo, hi = inside.min(axis=0), inside.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if depth >= DEPTH or len(rows) <= 1 or len(usable) == 0:
            nodes.append((tree, slot, -1, 0.0, round((depth + float(average_path(len(rows)))) / UNIT), len(points)))
            continue
        which, where = _random(seed, tree, slot)
        feature = int(usable[int(which * len(usable))])
        cut = float(lo[feature] + where * (hi[feature] - lo[feature]))
        nodes.append((tree, slot, feature, cut, 0, len(points)))
        right = inside[:, feature] > cut
        pending += [(2 * slot + 1, depth + 1, rows[~right]), (2 * slot + 2, depth + 1, rows[right])]
    return nodes


def _numbers(features: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]


def tree_samples(df: DataFrame, features: Sequence[str], key: Sequence[str], seed: int = 42, sample: int = SAMPLE) -> DataFrame:
    """tree, the features and the key of the ``sample`` rows of the whole table that each tree takes."""
    total = df.count()
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]))
    word = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    # Far more rows than ``sample`` fall below the bound, or all of them do.
    bound = PLACES if total <= 2 * sample else min(PLACES, int(PLACES * (sample + 12 * sample**0.5 + 64) / total))
    place = lambda tree: (F.col("_a") + tree * F.col("_b")) % PLACES
    drawn = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(TREES - 1).cast("long")), lambda tree: place(tree) < bound)
    rows = df.select(*key, *_numbers(features), word(1).alias("_a"), word(9).alias("_b"))
    trees = rows.withColumn("tree", F.explode(drawn)).withColumn("_place", place(F.col("tree")))
    order = Window.partitionBy("tree").orderBy("_place", *key)
    return trees.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sample).drop("_a", "_b", "_place")


def fit_forest(df: DataFrame, features: Sequence[str], key: Sequence[str], seed: int = 42, sample: int = SAMPLE) -> Forest:
    """Grow the trees; ``key`` identifies rows so that the sample does not depend on partitioning."""
    features, key = list(features), list(key)
    samples = tree_samples(df, features, key, seed, sample)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_rank")
        nodes = _grow(int(group["tree"].iloc[0]), group[features].to_numpy(dtype=float), seed)
        return pd.DataFrame(nodes, columns=["tree", "slot", "feature", "threshold", "path", "size"])

    grown = samples.select("tree", "_rank", *features).groupBy("tree").applyInPandas(
        grow, "tree int, slot int, feature int, threshold double, path long, size int")
    # At most TREES * SLOTS node rows, whatever the table size.
    nodes = grown.toPandas()
    split = np.full((TREES, SLOTS), -1, dtype=np.int64)
    threshold, path = np.zeros((TREES, SLOTS)), np.zeros((TREES, SLOTS), dtype=np.int64)
    at = (nodes["tree"].to_numpy(), nodes["slot"].to_numpy())
    split[at], threshold[at], path[at] = nodes["feature"], nodes["threshold"], nodes["path"]
    size = int(nodes["size"].max()) if len(nodes) else 1
    return Forest(tuple(features), split, threshold, path, float(max(average_path(size), 1e-9)))


def score_forest(df: DataFrame, forest: Forest, out: str = "iso_raw") -> DataFrame:
    """Add ``2 ** (-mean path / norm)`` per row, in Arrow batches."""
    shared = df.sparkSession.sparkContext.broadcast((forest.split, forest.threshold, forest.path))
    norm = forest.norm

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        rows, total = np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
        for split, threshold, path in zip(*shared.value):
            slot = np.zeros(len(points), dtype=np.int64)
            for _ in range(DEPTH):
                feature = split[slot]
                inner = feature >= 0
                right = points[rows, np.maximum(feature, 0)] > threshold[slot]
                slot = np.where(inner, 2 * slot + 1 + right, slot)
            total += path[slot]
        return pd.Series(np.exp2(-(total * UNIT) / TREES / norm))

    return df.withColumn(out, score(*_numbers(forest.features)))


def isolation_forest(df: DataFrame, features: Sequence[str], key: Sequence[str], contamination: float, seed: int = 42, sample: int = SAMPLE,
                     few_values: bool = False) -> DataFrame:
    """Add ``iso_anomaly`` (1 outlier, 0 inlier) and ``iso_score`` (positive for outliers).

    With ``few_values`` only the distinct combinations of the features are scored
    and joined back through a written lookup table; otherwise every row is scored
    and the scored rows are written.
    """
    features = list(features)
    forest = fit_forest(df, features, key, seed, sample)
    if not few_values:
        scored = materialize(score_forest(df, forest, "_raw"), "iso-scores")
        limit = exact_quantiles(scored, "_raw", {"q": 1 - contamination}).scalar()
        return scored.withColumn("_limit", limit).withColumns({
            "iso_anomaly": (F.col("_raw") > F.col("_limit")).cast("int"), "iso_score": F.col("_raw") - F.col("_limit")}).drop("_raw", "_limit")
    keyed = df.withColumns({f"_f{i}": c for i, c in enumerate(_numbers(features))})
    names = [f"_f{i}" for i in range(len(features))]
    combos = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"))
    scored = score_forest(combos.select(*[F.col(n).alias(c) for n, c in zip(names, features)], "_rows"), forest)
    scored = materialize(scored.select(*[F.col(c).alias(n) for n, c in zip(names, features)], "_rows", "iso_raw"), "iso-scores")
    limit = exact_quantiles(scored, "iso_raw", {"q": 1 - contamination}, weight="_rows").scalar()
    labels = scored.withColumn("_limit", limit).select(
        *names, (F.col("iso_raw") > F.col("_limit")).cast("int").alias("iso_anomaly"), (F.col("iso_raw") - F.col("_limit")).alias("iso_score"))
    return keyed.join(materialize(labels, "iso-labels"), names, "left").drop(*names)
