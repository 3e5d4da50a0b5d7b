"""Mixing sources to target weights.

1. Words per document, and from them the words per source (map-side sums).
2. Sources in code point order, null last, weigh ``WEIGHTS`` in turn and share
   all words.  A target stops at ``MOST`` times its source's size; what is left
   over is shared again by weight among the others until none is above.  The
   level of the shares is found by one-row aggregates over the source table.
3. The repetition rate of a source is target / size.  A document is taken
   floor(rate) times, and once more if its seeded hash falls below the fraction.

All steps are DataFrame expressions.  The source table is written, so the planner
knows its size: small ones are broadcast, large ones joined with adaptive skew
splitting.  Null texts have size 0; a source of size 0 has target 0 and rate 0.
Repeated rows draw alike (the draw depends on seed and id only), null ids share
one draw, an empty table gives no rows, reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import WORD, whole_row, written
from watchledger.operators.ordering import running_total

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix-1"


def sizes(docs: DataFrame) -> DataFrame:
    """Adds ``size``, the number of words, and ``_source``, a key without nulls that sorts null last."""
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    source = F.col("source").cast("string")
    return docs.withColumn("size", words).withColumn("_source", F.coalesce(F.concat(F.lit("s"), source), F.lit("z")))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """_source, source_size, target, rate."""
    totals = sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    ranked = running_total(totals, ["_source"], F.lit(1), out="_rank")
    turn = F.array(*map(F.lit, weights))
    ranked = written(ranked.withColumn("_weight", F.get(turn, ((F.col("_rank") - 1) % len(weights)).cast("int")).cast("double")).drop("_rank"), "sources")
    level = share_level(ranked, most)
    target = F.least(F.lit(level) * F.col("_weight"), F.col("source_size") * F.lit(float(most)))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    return written(ranked.select("_source", "source_size", target.alias("target"), rate.alias("rate")), "targets")


def share_level(sources: DataFrame, most: int) -> float:
    """Words per unit of weight at which all targets sum to the total.  It only rises, so each pass caps further sources."""
    level, total = 0.0, sources.agg(F.sum("source_size")).first()[0] or 0
    while total:
        limit = F.col("source_size") * most
        capped = limit < F.lit(level) * F.col("_weight")
        at_limit, weight = sources.agg(F.sum(F.when(capped, limit).otherwise(0)), F.sum(F.when(capped, 0.0).otherwise(F.col("_weight")))).first()
        if not weight or (new := (total - at_limit) / weight) <= level:
            break
        level = new
    return level


def draw(seed: str = SEED):
    """A number in [0, 1) from 52 bits of md5(seed:doc_id)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Every document with size, source_size, target, rate and copies; further columns stay."""
    sized = sizes(docs)
    targets = source_targets(written(sized.select("doc_id", "_source", "size"), "sizes"))
    whole = F.floor("rate")
    copies = (whole + (draw(seed) < F.col("rate") - whole).cast("int")).cast("int")
    return sized.join(targets, "_source").withColumn("copies", copies).drop("_source")


def mixing_report(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every document."""
    narrow = docs.select(F.col("doc_id").cast("long"), "text", "source")
    return mixed(narrow, seed).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "rate", "copies")


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as many times as it is taken.

    Documents without a word have nothing to add to a target and are taken by the same draw.
    """
    plain = docs.select("doc_id", "text", "source", whole_row(docs))
    taken = mixed(plain, seed).where("copies > 0").withColumn("_copy", F.explode(F.expr("array_repeat(0, copies)")))
    return taken.select("document.*")
