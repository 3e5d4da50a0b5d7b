"""Shards of near equal size by best-fit-decreasing bin packing.

Equal texts form one group that is never divided.  Groups go by falling size into
the bin with the least room that still holds them; a balanced tree over the rooms
finds it.  ``capacity`` alone minimises the number of bins of that capacity; a
given number of shards is filled with the least capacity, found by bisection, for
which the packing needs no more of them.

Groups of one size are alike, so the packing sees sizes and their counts: of
positive whole numbers that add up to T there are at most sqrt(2 T) different
ones, 14 million (224 MB) for 100 TB.  Only this histogram reaches the driver.
Each group then takes its place by its rank among the groups of its size, ranked
over range slices, so neither a frequent size nor a group that holds a third of
all rows meets in one task.

A group above the mean of what is left has a shard of its own (or, with a given
capacity, a bin above capacity); sizes can then be no more equal than that.
Null texts count as empty, so all of them are one group of one byte a row.
Repeated rows get slots of their own, ties of size are broken by the text's
digest, rows without an id come first, an empty table has no shards.  All columns
of a row travel as one, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import whole_row, written
from watchledger.operators.ordering import running_total

SHARDS = 16


class Rooms:
    """Keys (room, bin) in a height-balanced (AVL) tree."""

    def __init__(self):
        self.top = None  # a node is [key, left, right, height]

    def add(self, key: tuple[int, int]) -> None:
        self.top = self._add(self.top, key)

    def remove(self, key: tuple[int, int]) -> None:
        self.top = self._remove(self.top, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least key whose room is ``size`` or more."""
        node, best = self.top, None
        while node:
            if node[0][0] >= size:
                node, best = node[1], node[0]
            else:
                node = node[2]
        return best

    def _add(self, node, key):
        if node is None:
            return [key, None, None, 1]
        side = 1 if key < node[0] else 2
        node[side] = self._add(node[side], key)
        return self._balanced(node)

    def _remove(self, node, key):
        if key != node[0]:
            side = 1 if key < node[0] else 2
            node[side] = self._remove(node[side], key)
        elif node[1] is None or node[2] is None:
            return node[1] or node[2]
        else:
            following = node[2]
            while following[1]:
                following = following[1]
            node[0] = following[0]
            node[2] = self._remove(node[2], following[0])
        return self._balanced(node)

    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _measure(self, node):
        node[3] = 1 + max(self._height(node[1]), self._height(node[2]))
        return node

    def _turned(self, node, low: int):
        """Rotation that lifts the child on side ``low``."""
        high, child = 3 - low, node[low]
        node[low] = child[high]
        child[high] = self._measure(node)
        return self._measure(child)

    def _balanced(self, node):
        lean = self._height(node[1]) - self._height(node[2])
        if abs(lean) > 1:
            heavy = 1 if lean > 0 else 2
            child = node[heavy]
            if self._height(child[3 - heavy]) > self._height(child[heavy]):
                node[heavy] = self._turned(child, 3 - heavy)
            return self._turned(node, heavy)
        return self._measure(node)


def best_fit(sizes: list[int], counts: list[int], capacity: int, most: int | None = None) -> list[tuple[int, int, int]] | None:
    """(class, bin, number) placements of ``counts`` groups of each of the falling ``sizes``; None if more than ``most`` bins are needed.

    A group above ``capacity`` fills a bin by itself.
    """
    rooms, placed, bins = Rooms(), [], 0
    for c, (size, left) in enumerate(zip(sizes, counts)):
        while left:
            found = rooms.tightest(size)
            if found is None:
                if bins == most:
                    return None
                room, bin = max(capacity, size), bins
                bins += 1
            else:
                rooms.remove(found)
                room, bin = found
            here = min(left, room // size)  # the tightest bin stays the tightest until it is full
            placed.append((c, bin, here))
            left -= here
            rooms.add((room - here * size, bin))
    return placed


def level_fit(sizes: list[int], counts: list[int], shards: int) -> list[tuple[int, int, int]]:
    """Placements into ``shards`` bins of the least capacity that bisection finds."""
    alone, total, first = [], sum(s * n for s, n in zip(sizes, counts)), 0
    counts = list(counts)
    for c, size in enumerate(sizes):
        while counts[c] and len(alone) < shards - 1 and size * (shards - len(alone)) > total:  # above the mean of what is left
            alone.append((c, len(alone), 1))
            counts[c] -= 1
            total -= size
        if counts[c]:
            first = c
            break
    else:
        return alone
    rest = shards - len(alone)
    low = max(-(-total // rest), sizes[first])
    high = low + sizes[first]  # enough: a bin opened beyond the last would leave all others fuller than the mean
    best = best_fit(sizes, counts, high, rest)
    while low < high:
        middle = (low + high) // 2
        placed = best_fit(sizes, counts, middle, rest)
        if placed is None:
            low = middle + 1
        else:
            best, high = placed, middle
    return alone + [(c, bin + len(alone), n) for c, bin, n in best]


def group_shards(groups: DataFrame, shards: int | None = SHARDS, capacity: int | None = None) -> DataFrame:
    """digest and shard of every group (digest, bytes)."""
    spark = groups.sparkSession
    ranked = written(running_total(groups, ["digest"], F.lit(1), by=["bytes"], out="rank"), "ranked")
    classes = ranked.groupBy("bytes").count().toArrow()  # at most sqrt(2 x all bytes) rows
    sizes, counts = (classes.column(c).to_numpy() for c in ("bytes", "count"))
    order = np.argsort(-sizes)
    sizes, counts = sizes[order].tolist(), counts[order].tolist()
    placed = level_fit(sizes, counts, shards) if capacity is None else best_fit(sizes, counts, capacity)
    places: dict[int, tuple[list[int], list[int]]] = {}
    for c, bin, n in placed:
        upto, bins = places.setdefault(c, ([], []))
        upto.append((upto[-1] if upto else 0) + n)
        bins.append(bin)
    plan = pa.table({"bytes": pa.array([sizes[c] for c in places], pa.int64()), "upto": pa.array([p[0] for p in places.values()], pa.list_(pa.int64())),
                     "bins": pa.array([p[1] for p in places.values()], pa.list_(pa.int32()))})
    plan = written(spark.createDataFrame(plan, "bytes long, upto array<long>, bins array<int>"), "plan")
    place = F.size(F.filter("upto", lambda u: u < F.col("rank")))
    return ranked.join(plan, "bytes").select("digest", F.get("bins", place).alias("shard"))


def shard_documents(docs: DataFrame, shards: int | None = SHARDS, capacity: int | None = None, order: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """``document`` (``keep``, or all columns), size, text_crc32, shard and slot: the row's gapless number within its shard, by ``order``."""
    text = F.coalesce("text", F.lit(""))
    measured = docs.select(
        whole_row(docs.select(*[f"`{c}`" for c in keep]) if keep else docs), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"), F.monotonically_increasing_id().alias("row"))
    measured = written(measured, "measured")
    groups = measured.groupBy("digest").agg(F.sum("size").alias("bytes"))
    placed = measured.join(group_shards(groups, shards, capacity), "digest").withColumn("at", F.col(f"document.`{order}`"))
    numbered = running_total(placed, ["at", "digest", "row"], F.lit(1), by=["shard"], out="slot")
    return numbered.select("document", "size", "text_crc32", "shard", (F.col("slot") - 1).alias("slot"))


def write_shards(docs: DataFrame, path: str, **packing) -> None:
    """The documents in one folder a shard."""
    placed = shard_documents(docs, **packing)
    placed.select("document", "slot", "shard").write.partitionBy("shard").parquet(path)


def sharding_report(docs: DataFrame) -> DataFrame:
    """Shard and slot of every document."""
    placed = shard_documents(docs, keep=["doc_id"])
    return placed.select(
        "document.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
