"""Exact deduplication against a minimal perfect hash of historical digests.

Texts are equal when their bytes agree after lower-casing A-Z; null counts as
empty.  A digest is the SHA-256 of the normalised text.

* The history's distinct digests are dealt into shards by hash.  Each shard, of
  bounded size, gets a minimal perfect hash (hash and displace): n digests fill
  n slots, and every slot holds its full digest and the locator of the winner.
* New documents are counted per digest first (map-side), so a digest that holds
  a third of all rows is one row here.  Their digests meet the index shard by
  shard.  The hash sends any digest to some slot; all 32 bytes are compared.
* Members join the group in the slot.  Nonmembers are grouped by themselves.

The winner of a group is the row with the largest doc_id; a null id is smaller
than any other; of repeated rows with one id the last-numbered row wins.  An
empty history or empty input gives the plain groups of the other side.  Further
columns are left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from watchledger.llm.common import as_bytes, blocks, discard, record, row_numbers, without_losers, written

#: Digests of one index shard; bounds a task's memory at any size of history.
SHARD_DIGESTS = 40_000
KEYS_PER_BUCKET = 4

_DIGESTS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("digest", pa.binary())])
_INDEX = "shard long, seeds binary, digests binary, winner_ids binary, winner_null binary, winner_rows binary, copies binary"
_HITS = "digest binary, member boolean, winner struct<doc_id:long,row:long>, copies long"


def normalised_digest(text: bytes) -> bytes:
    return hashlib.sha256(text.lower()).digest()  # bytes.lower() touches A-Z only


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, row (a number of its own) and digest of each document."""

    def run(batches):
        rows = row_numbers()
        for b in blocks(batches):
            found = [normalised_digest(t) for t in as_bytes(b.column("text"))]
            yield record(_DIGESTS, {"doc_id": b.column("doc_id"), "row": [next(rows) for _ in found], "digest": found})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, row long, digest binary")


def digest_groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the winner's locator and the number of rows."""
    return rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("winner"), F.count(F.lit(1)).alias("copies"))


def _parts(digests: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and two hashes of each digest, from its own bytes."""
    words = digests.view(">u8").astype(np.uint64)
    return (words[:, 0] % np.uint64(buckets)).astype(np.int64), words[:, 1], words[:, 2] | np.uint64(1)


def _slot(a: np.ndarray, b: np.ndarray, seed, n: int) -> np.ndarray:
    z = a + np.uint64(seed) * b if np.isscalar(seed) else a + seed.astype(np.uint64) * b
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return ((z ^ (z >> np.uint64(29))) % np.uint64(n)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds per bucket and the slot of each of the n distinct digests; a negative seed -s-1 names slot s."""
    n = len(digests)
    buckets = max(1, -(-n // KEYS_PER_BUCKET))
    bucket, a, b = _parts(digests, buckets)
    seeds, slots, taken = np.zeros(buckets, np.int64), np.full(n, -1, np.int64), np.zeros(n, bool)
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=buckets)
    starts = np.concatenate([[0], np.cumsum(counts)])
    for k in np.argsort(-counts, kind="stable"):
        if counts[k] < 2:
            break
        keys = order[starts[k] : starts[k + 1]]
        seed = 0
        while True:
            s = _slot(a[keys], b[keys], seed, n)
            if not taken[s].any() and len(set(s.tolist())) == len(s):
                break
            seed += 1
        seeds[k], slots[keys], taken[s] = seed, s, True
    free = iter(np.flatnonzero(~taken).tolist())
    for k in np.flatnonzero(counts == 1):
        slots[order[starts[k]]] = s = next(free)
        seeds[k] = -s - 1
    return seeds, slots


def find_slots(digests: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    bucket, a, b = _parts(digests, len(seeds))
    seed = seeds[bucket]
    return np.where(seed < 0, -seed - 1, _slot(a, b, np.maximum(seed, 0), n))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """One row per shard with its perfect hash and slots."""

    def build(table: pa.Table) -> pa.Table:
        digests = _matrix(table.column("digest"))
        seeds, slots = build_hash(digests)
        place = np.argsort(slots)
        ids = table.column("doc_id")
        out = {
            "shard": [table.column("shard")[0].as_py()],
            "seeds": [seeds.tobytes()],
            "digests": [digests[place].tobytes()],
            "winner_ids": [pa.compute.fill_null(ids, 0).to_numpy()[place].tobytes()],
            "winner_null": [np.asarray(ids.is_null())[place].tobytes()],
            "winner_rows": [table.column("row").to_numpy()[place].tobytes()],
            "copies": [table.column("copies").to_numpy()[place].tobytes()],
        }
        return pa.table(out)

    flat = groups.select(_shard(shards), "digest", "winner.doc_id", "winner.row", "copies")
    return flat.groupBy("shard").applyInArrow(build, _INDEX)


def _shard(shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard")


def look_up(index: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
    """Each digest of ``groups`` with the slot that holds it, if one does."""

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        column = left.column("digest").combine_chunks().cast(pa.binary())
        n = len(column)
        member, ids, rows, copies = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        null = np.ones(n, bool)
        if n and right.num_rows:
            shard = {name: right.column(name)[0].as_py() for name in right.column_names}
            stored = np.frombuffer(shard["digests"], np.uint8).reshape(-1, 32)
            asked = _matrix(column)
            slot = find_slots(asked, np.frombuffer(shard["seeds"], np.int64), len(stored))
            member = (stored[slot] == asked).all(axis=1)
            ids, rows, copies = (np.frombuffer(shard[k], np.int64)[slot] for k in ("winner_ids", "winner_rows", "copies"))
            null = np.frombuffer(shard["winner_null"], bool)[slot]
        winner = pa.StructArray.from_arrays([pa.array(ids, pa.int64(), mask=null), pa.array(rows, pa.int64())], ["doc_id", "row"])
        return pa.table({"digest": column, "member": member, "winner": winner, "copies": copies})

    asked = groups.select(_shard(shards), "digest")
    return asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probe, _HITS)


def merge_with_history(new: DataFrame, history: DataFrame) -> DataFrame:
    """Groups over both inputs: digest, winner, copies.  Inputs are digest rows."""
    old = written(digest_groups(history), "history-groups")
    fresh = written(digest_groups(new), "new-groups")
    shards = max(1, -(-max(old.count(), fresh.count()) // SHARD_DIGESTS))  # the larger side bounds what one task holds
    index = written(build_index(old, shards), "digest-index")
    hits = written(look_up(index, fresh, shards), "digest-hits")
    found = fresh.join(hits.withColumnsRenamed({"winner": "old", "copies": "old_copies"}), "digest")
    repeats = found.where("member").select(
        "digest", F.greatest("winner", "old").alias("winner"), (F.col("copies") + F.col("old_copies")).alias("copies"))
    alone = found.where("not member").select("digest", "winner", "copies")
    unseen = old.join(repeats.select("digest"), "digest", "left_anti")
    discard(index)
    return repeats.unionByName(alone).unionByName(unseen)


def exact_dedup(docs: DataFrame, is_history) -> DataFrame:
    """Every document with its group; ``is_history`` tells which rows of ``docs`` are in the index already.

    Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    rows = written(digest_rows(docs), "digests")
    groups = merge_with_history(rows.where(~is_history), rows.where(is_history))
    # Only groups of two or more are joined back; a frequent digest is split by the adaptive skew join.
    shared = written(groups.where("copies > 1"), "groups")
    mine = rows.join(shared, "digest", "left")
    return mine.select(
        "doc_id",
        F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("winner.doc_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("winner.row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def in_history(doc_id: str = "doc_id"):
    """The half of the documents that queries and pipeline take as indexed before: those with an even crc32 of the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 2 == 0, F.lit(False))


def keep_winners(docs: DataFrame, is_history) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that repeat the winner's id and text are one document; one of them stays.
    """
    rows = written(digest_rows(docs), "digests")
    groups = merge_with_history(rows.where(~is_history), rows.where(is_history))
    shared = written(groups.where("copies > 1").select("digest", F.col("winner.doc_id").alias("keep")), "groups")
    same = F.col("doc_id").eqNullSafe(F.col("keep"))
    fates = rows.join(shared, "digest").groupBy("doc_id", "digest", same.alias("stays")).agg(F.count(F.lit(1)).alias("rows"))
    fates = written(fates.where("rows > 1 or not stays").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_key"), "stays"), "fates")
    discard(rows, shared)
    return without_losers(docs, fates, _with_digest)


def _with_digest(packed: DataFrame) -> DataFrame:
    """id, digest as key, and document (the whole row)."""

    def run(batches):
        for b in batches:
            for block in blocks([b.append_column("text", b.column("document").field("text").cast(pa.string()))]):
                found = [normalised_digest(t) for t in as_bytes(block.column("text"))]
                yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(found, pa.binary()), block.column("document")], names=["id", "key", "document"])

    return packed.mapInArrow(run, StructType([StructField("id", LongType()), StructField("key", BinaryType()), packed.schema["document"]]))
