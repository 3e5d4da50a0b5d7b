"""Boosted histogram trees for next week's risk.

Features are cut at exact quantiles into a few bins.  A tree grows level by level:
one aggregate gives rows and residual sums per (node, feature, bin), at most
``2 ** depth x features x bins`` numbers, and the best cut of every node follows from
it; the last level's sums are the leaves'.  A tree becomes an expression over the
bins, so rows never leave the JVM, and the fitted value is written every few trees.
Targets, residuals and leaves are whole units, so sums do not depend on their order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.operators.measures import RISK_FEATURES, risk_prediction, weekly_risk, with_next_week
from watchledger.operators.ordering import exact_quantiles
from watchledger.workspace import materialize

#: Units of one point of risk.
UNIT = 1_000_000
#: Trees between two written tables of the fitted values.
WRITE_EVERY = 5


@dataclass(frozen=True)
class Tree:
    """(feature, cut) of every node of every level, breadth first (rows with a bin above the cut go right), and the leaves' values."""

    levels: tuple[tuple[tuple[int, int], ...], ...]
    leaves: tuple[int, ...]

    def node(self, bins: Sequence[Column]) -> Column:
        """Number of the node that a row reaches, from the left."""
        at = F.lit(0)
        for level in self.levels:
            right = F.lit(False)
            for n, (feature, cut) in reversed(list(enumerate(level))):
                right = F.when(at == n, bins[feature] > cut).otherwise(right)
            at = at * 2 + right.cast("int")
        return at

    def value(self, bins: Sequence[Column]) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in self.leaves]), self.node(bins) + 1)


def binned(df: DataFrame, features: Sequence[str], bins: int, fitted_on: DataFrame) -> DataFrame:
    """Adds b0, b1, ...: how many of the ``bins - 1`` quantiles of ``fitted_on`` each feature exceeds."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in features]
    rows = exact_quantiles(fitted_on.select(F.inline(F.array(*pairs))), "value", {f"q{i}": i / bins for i in range(1, bins)}, by=["column"]).collect()
    cuts = {r["column"]: [r[f"q{i}"] for i in range(1, bins)] for r in rows}  # features x bins numbers
    above = lambda c: sum((F.when(F.col(c) > F.lit(x), 1).otherwise(0) for x in cuts.get(c, [])), F.lit(0))
    return df.withColumns({f"b{i}": above(c) for i, c in enumerate(features)})


def _best_cuts(histogram: list, nodes: int, features: int, bins: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(feature, cut) of every node, and (rows, residuals) of its left and right side; ties go to the first feature, then cut."""
    counts = [[[(0, 0)] * bins for _ in range(features)] for _ in range(nodes)]
    for node, feature, bin, n, s in histogram:
        counts[node][feature][bin] = (n, s)
    cuts, sides = [], []
    for node in counts:
        total = (sum(n for n, _ in node[0]), sum(s for _, s in node[0]))
        best, cut, left = None, (0, bins), total  # without a cut all go left
        for f, row in enumerate(node):
            n = s = 0
            for b, (m, t) in enumerate(row[:-1]):
                n, s = n + m, s + t
                if 0 < n < total[0]:
                    right = total[1] - s
                    gain = float(s) * float(s) / n + float(right) * float(right) / (total[0] - n)
                    if best is None or gain > best:
                        best, cut, left = gain, (f, b), (n, s)
        cuts.append(cut)
        sides += [left, (total[0] - left[0], total[1] - left[1])]
    return cuts, sides


def boost(rows: DataFrame, features: int, bins: int, rounds: int, depth: int, shrink: int) -> DataFrame:
    """Adds ``fitted`` (units) to every row, from the rows whose ``y`` (units) is known; each leaf moves by its mean residual / ``shrink``."""
    b = [F.col(f"b{i}") for i in range(features)]
    rows = materialize(rows, "boosted")
    known = rows.agg(F.count("y"), F.sum("y")).first()
    rows = rows.withColumn("fitted", F.lit(known[1] // known[0] if known[0] else 0).cast("long"))
    for n in range(rounds if known[0] else 0):
        tree = Tree((), ())
        sides: list[tuple[int, int]] = []
        for level in range(depth):
            cells = rows.where("y is not null").select(
                tree.node(b).alias("node"), (F.col("y") - F.col("fitted")).alias("r"),
                F.inline(F.array(*[F.struct(F.lit(i).alias("feature"), x.alias("bin")) for i, x in enumerate(b)])))
            histogram = cells.groupBy("node", "feature", "bin").agg(F.count(F.lit(1)), F.sum("r")).collect()
            cuts, sides = _best_cuts([tuple(r) for r in histogram], 2**level, features, bins)
            tree = Tree((*tree.levels, tuple(cuts)), ())
        tree = Tree(tree.levels, tuple(int(float(s) / (k * shrink) // 1) if k else 0 for k, s in sides))
        rows = rows.withColumn("fitted", F.col("fitted") + tree.value(b))
        if (n + 1) % WRITE_EVERY == 0:
            rows = materialize(rows, "boosted")
    return rows


def risk_prediction_trees(df: DataFrame, rounds: int = 20, depth: int = 3, bins: int = 16, shrink: int = 5) -> DataFrame:
    """Next week's risk per source from this week's features by boosted trees; takes prepared incidents."""
    weekly = weekly_risk(df)
    training, newest = with_next_week(weekly)
    units = lambda c: F.round(F.col(c) * UNIT).cast("long")
    rows = training.withColumn("y", units("y")).unionByName(newest.withColumn("y", F.lit(None).cast("long")))
    rows = binned(rows, RISK_FEATURES, bins, training)
    fitted = boost(rows, len(RISK_FEATURES), bins, rounds, depth, shrink).where("y is null")
    return fitted.select("source_ip", "week_start", "risk", F.greatest(F.col("fitted") / UNIT, F.lit(0.0)).alias("predicted_risk"))


def risk_model_errors(df: DataFrame, **trees: int) -> DataFrame:
    """How far the linear model, the trees and last week's risk itself lie from the newest week, which none of them has seen."""
    newest = df.agg(F.date_trunc("week", F.max("timestamp")).alias("w")).first()["w"]
    if newest is None:
        return df.limit(0).select(F.lit("").alias("model"), F.lit(0).cast("long").alias("sources"), F.lit(0.0).alias("mean_absolute_error"), F.lit(0.0).alias("root_mean_square_error"))
    start = F.lit(newest).cast("timestamp_ntz")
    earlier = df.where(F.col("timestamp") < start)
    truth = materialize(weekly_risk(df.where(F.col("timestamp") >= start)).select("source_ip", F.col("risk").alias("truth")), "truth")
    linear, boosted = risk_prediction(earlier), risk_prediction_trees(earlier, **trees)
    guesses = linear.select("source_ip", F.inline(F.array(
        F.struct(F.lit("linear").alias("model"), F.col("predicted_risk").alias("guess")), F.struct(F.lit("same again").alias("model"), F.col("risk").alias("guess")))))
    guesses = guesses.unionByName(boosted.select("source_ip", F.lit("trees").alias("model"), F.col("predicted_risk").alias("guess")))
    miss = F.col("guess") - F.coalesce("truth", F.lit(0.0))
    return guesses.join(truth, "source_ip", "left").groupBy("model").agg(
        F.count(F.lit(1)).alias("sources"), F.avg(F.abs(miss)).alias("mean_absolute_error"), F.sqrt(F.avg(miss * miss)).alias("root_mean_square_error"))
