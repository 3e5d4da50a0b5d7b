"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from watchledger.workspace import discard, materialize

#: A word is a run of other characters than these six (space and 0x09 to 0x0D).
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes of text that one block of in-task work holds at most, unless one text is longer.
BLOCK_BYTES = 8 << 20
#: Rows of such a block, at most.
BLOCK_ROWS = 10_000
#: Rows of an Arrow batch, at most: texts are long, and the executor and its Python worker each hold a whole batch of them.
BATCH_ROWS = 1_000

#: Bits of a filter of ids, at most.
FILTER_BITS = 1 << 27
#: Bytes in which a table goes to the driver.
CHUNK = 1 << 12

written = materialize


def small_batches(spark: SparkSession) -> SparkSession:
    """``spark`` with Arrow batches of at most ``BATCH_ROWS`` rows (a smaller setting stays), and without the shuffle files of queries that have ended.  Results depend on neither."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one, ``document``: whatever their names, they clash with nothing."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id has remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(divisor)), F.lit(0))


def as_bytes(column: pa.Array) -> list[bytes]:
    """Strings as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices, and lay small ones together, so that ``column`` holds at most ``limit`` bytes in a block, or one row."""
    parts: list[pa.RecordBatch] = []
    held = rows = 0

    def block() -> pa.RecordBatch:
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = 0
        for i, n in enumerate(sizes):
            if rows and (held + n > limit and held or rows == BLOCK_ROWS):
                if start < i:
                    parts.append(batch.slice(start, i - start))
                yield block()
                start, held, rows = i, 0, 0
                parts.clear()
            held, rows = held + n, rows + 1
        if start < batch.num_rows:
            parts.append(batch.slice(start))
    if parts:
        yield block()
    pa.default_memory_pool().release_unused()  # workers live longer than tasks


def map_blocks(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str = "text") -> DataFrame:
    """``function`` over blocks of bounded text size."""

    def run(batches):
        for block in blocks(batches, column):
            yield function(block)

    return df.mapInArrow(run, schema)


def row_numbers() -> Iterator[int]:
    """Ids that no other row of this job gets: the task's partition, then a count."""
    n = TaskContext.get().partitionId() << 40
    while True:
        yield n
        n += 1


def record(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """A batch from lists or arrays in the order of ``schema``."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def gather(chunks: DataFrame, size: int) -> np.ndarray:
    """A byte table of fixed ``size`` from rows (chunk, data)."""
    table = np.zeros(size, np.uint8)
    for c, data in zip(*chunks.toArrow().select(["chunk", "data"]).to_pydict().values()):
        table[c * CHUNK : (c + 1) * CHUNK] = np.frombuffer(data, np.uint8)
    return table


def _places(ids: pa.Array, bits: int) -> list[np.ndarray]:
    x = pa.compute.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    return [(x % np.uint64(bits)).astype(np.int64), ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) % bits]


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bit table, of at most ``FILTER_BITS``, in which ``passes`` finds every doc_id of the written table ``ids``, and few others."""
    bits = min(FILTER_BITS, 1 << max(15, (8 * max(1, ids.count()) - 1).bit_length()))

    def mark(batches):
        for b in batches:
            at = np.unique(np.concatenate(_places(b.column("doc_id"), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(at // 8 // CHUNK), pa.array(at % (8 * CHUNK))], names=["chunk", "bit"])

    def pack(table: pa.Table) -> pa.Table:
        data = np.zeros(8 * CHUNK, np.uint8)
        data[table.column("bit").to_numpy()] = 1
        return pa.table({"chunk": [table.column("chunk")[0].as_py()], "data": [np.packbits(data).tobytes()]})

    marks = ids.select("doc_id").mapInArrow(mark, "chunk long, bit long").distinct()
    return gather(marks.groupBy("chunk").applyInArrow(pack, "chunk long, data binary"), bits // 8)


def passes(table: np.ndarray, ids: pa.Array) -> np.ndarray:
    """Which ``ids`` may be in the filter."""
    a, z = ((table[at // 8] >> (7 - at % 8)) & 1 for at in _places(ids, 8 * len(table)))
    return (a & z).astype(bool)


def without_losers(docs: DataFrame, fates: DataFrame, keyed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``docs`` without those of an id and key that the written ``fates`` (_id, _key, stays) names; of several rows of one that stays, one is left.

    ``keyed`` adds the key, a binary column, to rows (id, document).  Only documents whose id is in a filter of the named ids are
    shuffled to their fates; the others stay where they are.
    """
    named = docs.sparkSession.sparkContext.broadcast(id_filter(fates.select(F.col("_id").alias("doc_id"))))
    packed = docs.select(F.col("doc_id").cast("long").alias("id"), whole_row(docs.withColumn("text", F.col("text").cast("string"))))

    def passing(hit: bool) -> DataFrame:
        def run(batches):
            for b in batches:
                yield b.filter(pa.array(passes(named.value, b.column("id")) == hit))

        return packed.mapInArrow(run, packed.schema)

    marked = keyed(passing(True))
    is_fate = marked["id"].eqNullSafe(fates["_id"]) & (marked["key"] == fates["_key"])
    kept = marked.join(fates.where("not stays"), is_fate, "left_anti")
    if not fates.where("stays").isEmpty():  # the same id and key twice or more: only these rows are compared
        place = F.row_number().over(Window.partitionBy("id", "key").orderBy("document.text"))
        repeats = kept.join(fates.where("stays"), is_fate, "left_semi").withColumn("place", place).where("place = 1").drop("place")
        kept = kept.join(fates.where("stays"), is_fate, "left_anti").unionByName(repeats)
    return passing(False).unionByName(kept.drop("key")).select("document.*")
