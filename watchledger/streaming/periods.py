"""Profiles of sources by period of activity, for streams that run without end.

A period is a stretch of incidents of a source without a silence of the given
length.  Open periods are keyed state in the RocksDB store with one event-time timer a
source; when the watermark has passed the silence, the period is written as closed and
leaves the state.  The sink merges each batch into its table by key: a batch rewrites
the hash buckets that it touches and no others, into a folder of its own, so that
a batch that is tried again replaces itself.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from itertools import islice

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from watchledger.functions.cleaning import severity_score
from watchledger.streaming.jobs import END_OF_INPUT, LATENESS, event_time, wall_clock
from watchledger.workspace import new_path

# Tasks receive the functions of this module by value: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

@contextmanager
def rocks_store(spark: SparkSession):
    """Queries that are started inside keep their state in the RocksDB store, which keyed state needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


KEYS = ["source_ip", "period_start"]
BUCKETS = 64
#: Rows of a source that a task holds at once.
INPUT_ROWS = 10_000
_PERIODS = "start array<long>, last array<long>, incidents array<long>, severity_sum array<long>"
_OUTPUT = f"source_ip string, closed boolean, {_PERIODS}"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def joined_periods(periods: Iterable[tuple], silence: int) -> list[tuple]:
    """Periods (start, last, incidents, severity_sum) in order; those less than ``silence`` apart become one."""
    out: list[tuple] = []
    for start, last, n, severity in sorted(periods):
        if out and start - out[-1][1] < silence:
            before = out.pop()
            out.append((before[0], max(before[1], last), before[2] + n, before[3] + severity))
        else:
            out.append((start, last, n, severity))
    return out


def periods_of(at: np.ndarray, severity: np.ndarray, silence: int) -> list[tuple]:
    """Periods (start, last, incidents, severity_sum) of single incidents, in order."""
    order = np.argsort(at, kind="stable")
    at, severity = at[order], severity[order]
    first = np.flatnonzero(np.concatenate([[True], np.diff(at) >= silence]))
    n = np.diff(np.append(first, len(at)))
    return list(zip(at[first].tolist(), at[first + n - 1].tolist(), n.tolist(), np.add.reduceat(severity, first).tolist()))


class PeriodTracker(StatefulProcessor):
    """Open periods of a source; times are microseconds.

    All open periods of a source are one state row and one timer, for the period that ends first: it closes all
    that the watermark has passed and is set anew.  Periods leave as one row of lists, which Spark unpacks.  So a
    source with many periods costs a few calls, not a few for each of them.
    """

    def __init__(self, silence: int):
        self.silence = silence

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _PERIODS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self._held()
        periods = before
        while batch := [(r["at"], r["severity_sum"]) for r in islice(rows, INPUT_ROWS)]:  # of a busy source only the periods are kept
            periods = joined_periods([*periods, *periods_of(*np.asarray(batch, np.int64).T, self.silence)], self.silence)
        self.open.update(self._lists(periods))
        timer = self._timer(periods)
        if not before or self._timer(before) != timer:
            if before:
                self.handle.deleteTimer(self._timer(before))
            self.handle.registerTimer(timer)
        known, gone = set(before), {p[0] for p in before} - {p[0] for p in periods}
        yield self._row(key, [p for p in periods if p not in known] + [(start, start, 0, 0) for start in gone], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) * 1000
        due, later = [], []
        for p in self._held():
            (due if p[1] + self.silence <= now else later).append(p)
        if later:
            self.open.update(self._lists(later))
            self.handle.registerTimer(self._timer(later))
        else:
            self.open.clear()
        yield self._row(key, due, True)

    def close(self) -> None:
        pass

    def _held(self) -> list[tuple]:
        return list(zip(*(self.open.get() or ())))

    def _timer(self, periods: list[tuple]) -> int:
        """Milliseconds at which the first of the periods ends."""
        return -(-(min(p[1] for p in periods) + self.silence) // 1000)

    def _lists(self, periods: list[tuple]) -> tuple:
        return tuple(map(list, zip(*periods))) or ([],) * 4

    def _row(self, key, periods: list[tuple], closed: bool) -> Row:
        return Row(source_ip=key[0], closed=closed, **dict(zip(("start", "last", "incidents", "severity_sum"), self._lists(periods))))


def stream_ip_periods(incidents: DataFrame, silence: str = "6 hours", lateness: str = LATENESS) -> DataFrame:
    """Running and closed periods of every source, for update mode; a row with no incidents takes back a period that has become part of another."""
    spark = incidents.sparkSession
    length = spark.sql(f"SELECT CAST(unix_micros(TIMESTAMP '1970-01-01 00:00:00' + INTERVAL {silence}) AS bigint)").first()[0]
    narrow = event_time(incidents.where("source_ip is not null and timestamp is not null"), "timestamp", lateness).select(
        "source_ip", "timestamp", F.unix_micros("timestamp").alias("at"),
        F.coalesce(severity_score(F.col("severity")), F.lit(0)).cast("long").alias("severity_sum"))
    found = narrow.groupBy("source_ip").transformWithState(PeriodTracker(length), _OUTPUT, "Update", "EventTime")
    periods = found.select("source_ip", "closed", F.inline(F.arrays_zip("start", "last", "incidents", "severity_sum")))
    periods = periods.select("source_ip", F.timestamp_micros("start").alias("period_start"), F.timestamp_micros("last").alias("period_end"), "incidents", "severity_sum", "closed")
    return wall_clock(periods, "period_start", "period_end")


class MergedTable:
    """A table of one row per key below ``path``: ``epoch=E/bucket=B`` holds all rows of a bucket as of batch E.

    Rows that ``keep`` does not hold for take their key's row back; they stay until the bucket's next batch.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], keep: Column, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.keep, self.buckets = spark, path, list(keys), keep, buckets

    def _newest(self, before: int | None = None) -> dict[int, tuple[int, str]]:
        """(epoch, folder) of every bucket, from batches that are complete and older than ``before``."""
        jvm = self.spark._jvm
        top = jvm.org.apache.hadoop.fs.Path(self.path)
        files = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        newest: dict[int, tuple[int, str]] = {}
        for done in files.globStatus(jvm.org.apache.hadoop.fs.Path(self.path, "epoch=*/_SUCCESS")) or []:
            folder = done.getPath().getParent()
            epoch = int(folder.getName().split("=")[1])
            if before is None or epoch < before:
                for part in files.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "bucket=*")) or []:
                    bucket = int(part.getPath().getName().split("=")[1])
                    newest[bucket] = max(newest.get(bucket, (-1, "")), (epoch, part.getPath().toString()))
        return newest

    def merge(self, batch: DataFrame, epoch: int) -> None:
        """Rows of the batch replace those with their key."""
        batch = batch.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        batch = batch.persist()
        try:
            touched = [r[0] for r in batch.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
            older = self._newest(before=epoch)
            folders = [older[b][1] for b in touched if b in older]
            merged = batch
            if folders:
                held = self.spark.read.schema(batch.drop("bucket").schema).parquet(*folders).where(self.keep)
                held = held.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
                merged = merged.unionByName(held.join(batch.select(*self.keys), self.keys, "left_anti"))
            # Spread by key within the buckets, so that a bucket is not one task.
            merged.repartition("bucket", F.pmod(F.hash(*self.keys), F.lit(4))).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/epoch={epoch}")
        finally:
            batch.unpersist()

    def read(self, schema) -> DataFrame:
        folders = [folder for _, folder in self._newest().values()]
        return self.spark.read.schema(schema).parquet(*folders).where(self.keep) if folders else self.spark.createDataFrame([], schema)


def run_periods(periods: DataFrame, out: str, checkpoint: str) -> tuple[DataFrame, StreamingQuery]:
    """Runs over all input available now into the merged table at ``out``; going on from ``checkpoint`` neither loses nor repeats a row."""
    spark = periods.sparkSession
    table = MergedTable(spark, out, KEYS, F.col("incidents") > 0)

    def write(batch: DataFrame, epoch: int) -> None:
        # A period that is merged and closed in one batch has several rows: the closed one is the last.
        last = batch.groupBy(*KEYS).agg(F.max_by(F.struct("period_end", "incidents", "severity_sum", "closed"), F.struct("closed", "incidents")).alias("v"))
        table.merge(last.select(*KEYS, "v.*"), epoch)

    with rocks_store(spark):
        query = periods.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return table.read(periods.schema), query


def drain_periods(periods: DataFrame) -> DataFrame:
    """The periods of a finite stream; the row that ends it (``jobs.with_end``) is left out."""
    spark = periods.sparkSession
    found, _ = run_periods(periods, new_path(spark, "periods"), new_path(spark, "periods-state"))
    return found.where(F.col("period_start") < F.lit(END_OF_INPUT).cast("timestamp_ntz"))
