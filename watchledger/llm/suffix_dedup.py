"""Repeated-passage removal by a depth-limited radix sort of suffixes.

Every start of a ``WINDOW``-byte string inside a document is a suffix, ordered
only through ``WINDOW`` bytes; groups that are equal so far are exactly the
repeated strings.  Passes go from the most significant digit down, and a suffix
leaves as soon as no other shares its digits:

1. *First digit, all suffixes.*  The digit of a suffix is the ``DIGIT``-byte
   string inside its window with the least hash (leftmost on ties).  That choice
   depends on the window's bytes alone, so equal windows have equal digits, and
   neighbouring suffixes share one: a run of about 170 suffixes is one row.
2. *Second digit, whole runs.*  Runs with one digit whose hulls (all bytes that
   any of their windows covers) agree are repeated as a whole: copies end here.
3. *Further digits, single suffixes.*  Only runs that share the first digit with
   a different hull are left, one per hull.  Their bytes are fetched, dealt by the
   first digit, and refined in passes over ``STEP``-byte digits inside the task.
   A digit with more than ``GROUP`` different hulls is dealt in parts; windows
   that are alone in their part are compared across parts in one more pass.

Digits are compared by 64-bit fingerprints, so two different strings pass as
equal with a probability of about 2**-64 per compared pair.  Strings never cross
documents.  A document with fewer bytes than ``WINDOW`` loses nothing; null texts
are empty; repeated rows repeat each other and lose everything of that length; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import as_bytes, blocks, record, written

WINDOW = 400
DIGIT = 64
STEP = 100
GROUP = 8_192
#: Bytes that one pass of the first digit works on; the position must fit _POSITION bits.
BUFFER = 1 << 18
_POSITION = np.uint64(20)
_CHUNK_BYTES = 1 << 20

_random = np.random.default_rng(20260101)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _random.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Fingerprints:
    """Hashes of byte ranges of a buffer."""

    def __init__(self, most: int):
        self.power, self.inverse = _powers(_BASE, most), _powers(_INVERSE, most)

    def load(self, data: np.ndarray, widest: int = DIGIT) -> None:
        if len(data) > len(self.power):
            self.power, self.inverse = _powers(_BASE, 2 * len(data)), _powers(_INVERSE, 2 * len(data))
        h = _BYTE[data]
        self.by_width = {1: h}
        for k, width in enumerate((1, 2, 4, 8, 16, 32)):
            if width >= widest:
                break
            h = h[:-width] * _ODD[k] + h[width:]
            h ^= h >> np.uint64(29)
            self.by_width[2 * width] = h
        eight = self.by_width[8]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(eight * self.power[: len(eight)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprint of bytes [start, end), at least eight of them."""
        return mixed((self.sums[end - 7] - self.sums[start]) * self.inverse[start])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _ODD[6]
    return x ^ (x >> np.uint64(29))


def sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def digit_runs(data: np.ndarray, valid: np.ndarray, prints: Fingerprints, window: int, digit: int):
    """Runs of valid starts with one first digit: first start, number of starts, position and hash of the digit, hull."""
    prints.load(data)
    hashes = prints.by_width[digit]
    keys = ((mixed(hashes) >> _POSITION) << _POSITION) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_minimum(keys, window - digit + 1) & ((np.uint64(1) << _POSITION) - np.uint64(1))).astype(np.int64)
    at = np.where(valid[: len(at)], at, -1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.concatenate([first, [len(at)]]))
    first, count = first[at[first] >= 0], count[at[first] >= 0]
    place = at[first]
    hull = prints.of(first, first + count - 1 + window)
    shape = (place - first).astype(np.uint64) * _ODD[4] + count.astype(np.uint64) * _ODD[5]
    return first, count, place, hashes[place].view(np.int64), mixed(hull ^ shape).view(np.int64)


_RUNS = pa.schema([(n, pa.int64()) for n in ("doc_id", "key", "first", "n", "digit", "hull")])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


def first_pass(docs: DataFrame, window: int = WINDOW, digit: int = DIGIT, buffer: int = BUFFER) -> DataFrame:
    """A row per run of suffixes with one first digit.  Long documents are cut into overlapping parts."""
    step = buffer // 2

    def run(batches):
        prints = Fingerprints(buffer + 2 * window)
        for b in blocks(batches):
            ids, keys = b.column("doc_id"), b.column("key").to_pylist()
            parts, size, out = [], 0, []

            def flush():
                data = np.frombuffer(b"".join(t for _, _, t in parts), np.uint8)
                begins = np.cumsum([0, *(len(t) for _, _, t in parts)])
                valid = np.ones(len(data), bool)
                for z in begins[1:]:
                    valid[z - window + 1 : z] = False
                first, count, _, digits, hulls = digit_runs(data, valid, prints, window, digit)
                part = np.searchsorted(begins, first, "right") - 1
                row = np.asarray([i for i, _, _ in parts])[part]
                offset = np.asarray([o for _, o, _ in parts])[part]
                out.append((row, first - begins[part] + offset, count, digits, hulls))
                parts.clear()

            for i, t in enumerate(as_bytes(b.column("text"))):
                for o in range(0, len(t) - window + 1, step):
                    piece = t[o : o + step + window - 1]
                    if parts and size + len(piece) > buffer:
                        flush()
                        size = 0
                    parts.append((i, o, piece))
                    size += len(piece)
            if parts:
                flush()
            if out:
                row, first, count, digits, hulls = (np.concatenate(x) for x in zip(*out))
                yield record(_RUNS, {"doc_id": ids.take(pa.array(row)), "key": np.asarray(keys, np.int64)[row], "first": first, "n": count, "digit": digits, "hull": hulls})

    return _keyed(docs).mapInArrow(run, "doc_id long, key long, first long, n long, digit long, hull long")


_CONTEXTS = pa.schema([("digit", pa.int64()), ("salt", pa.int64()), ("parts", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("first", pa.int64()), ("n", pa.int64()),
                       ("copies", pa.int64()), ("data", pa.binary())])
_CONTEXT_SCHEMA = "digit long, salt long, parts long, doc_id long, key long, first long, n long, copies long, data binary"


def with_bytes(docs: DataFrame, runs: DataFrame, window: int) -> DataFrame:
    """The hull bytes of ``runs`` (digit, salt, parts, doc_id, key, first, n, copies)."""
    lists = runs.groupBy("doc_id", "key").agg(F.collect_list(F.struct("digit", "salt", "parts", "first", "n", "copies")).alias("runs"))
    named = lists.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "runs")
    keyed = _keyed(docs)
    joined = keyed.join(named, (keyed["key"] == named["_key"]) & keyed["doc_id"].eqNullSafe(named["_id"])).select("doc_id", "key", "text", "runs")

    def cut(batches):
        for b in blocks(batches, limit=1 << 20):
            found = {f.name: [] for f in _CONTEXTS}
            for i, key, t, runs in zip(b.column("doc_id").to_pylist(), b.column("key").to_pylist(), as_bytes(b.column("text")), b.column("runs").to_pylist()):
                for r in runs:
                    for name in ("digit", "salt", "parts", "first", "n", "copies"):
                        found[name].append(r[name])
                    found["doc_id"].append(i)
                    found["key"].append(key)
                    found["data"].append(t[r["first"] : r["first"] + r["n"] - 1 + window])
            yield record(_CONTEXTS, found)

    return joined.mapInArrow(cut, _CONTEXT_SCHEMA)


def window_digits(data: list[bytes], n: np.ndarray, prints: Fingerprints, window: int, step: int) -> np.ndarray:
    """Fingerprints of the ``step``-byte digits of every window, most significant first, and of the whole window."""
    edges = [*((a, min(a + step, window)) for a in range(0, window, step)), (0, window)]
    found, start = [], 0
    while start < len(data):
        end, size = start, 0
        while end < len(data) and (end == start or size + len(data[end]) <= _CHUNK_BYTES):
            size += len(data[end])
            end += 1
        prints.load(np.frombuffer(b"".join(data[start:end]), np.uint8), 8)
        begins = np.cumsum([0, *(len(d) for d in data[start : end - 1])])
        at = np.repeat(begins - np.cumsum(n[start:end]) + n[start:end], n[start:end]) + np.arange(n[start:end].sum())
        found.append(np.stack([prints.of(at + a, at + z) for a, z in edges]))
        start = end
    return np.concatenate(found, axis=1)


def equal_windows(data: list[bytes], group: np.ndarray, n: np.ndarray, copies: np.ndarray, prints: Fingerprints, window: int, step: int):
    """Row, start in the row, fingerprint and "is repeated" of every window; a pass per digit."""
    digits = window_digits(data, n, prints, window, step)
    row = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    weight = copies[row]
    repeated = np.zeros(len(row), bool)
    left, label = np.arange(len(row)), group[row].astype(np.uint64)
    for digit in digits[:-1]:
        _, where = np.unique(mixed(label * _ODD[3] + digit[left]), return_inverse=True)
        twice = np.bincount(where, weights=weight[left])[where] > 1
        left, label = left[twice], where[twice].astype(np.uint64)
    repeated[left] = True
    return row, inside, digits[-1], repeated


_FOUND = pa.schema([(n, pa.int64()) for n in ("doc_id", "key", "first", "end", "digit", "window", "copies")])


def refine(contexts: DataFrame, window: int, step: int) -> DataFrame:
    """Repeated ranges (window is null), and for digits dealt in parts the windows still to be compared."""
    spread = contexts.repartition("digit", "salt").sortWithinPartitions("digit", "salt")

    def found_in(table: pa.Table, prints: Fingerprints) -> pa.RecordBatch:
        digit, salt = table.column("digit").to_numpy(), table.column("salt").to_numpy()
        group = np.cumsum(np.concatenate([[0], (digit[1:] != digit[:-1]) | (salt[1:] != salt[:-1])]))
        copies, first = table.column("copies").to_numpy(), table.column("first").to_numpy()
        row, inside, prints_of, repeated = equal_windows(table.column("data").to_pylist(), group, table.column("n").to_numpy(), copies, prints, window, step)
        mine = np.flatnonzero(repeated & (copies[row] == 1))
        breaks = np.flatnonzero(np.concatenate([[True], (np.diff(mine) != 1) | (np.diff(row[mine]) != 0)])) if len(mine) else np.zeros(0, np.int64)
        last = np.concatenate([breaks[1:], [len(mine)]]) - 1 if len(mine) else breaks
        rows = [row[mine[breaks]]]
        starts, ends = [first[rows[0]] + inside[mine[breaks]]], [first[rows[0]] + inside[mine[last]] + window]
        windows, weights = [np.zeros(len(breaks), np.int64)], [np.ones(len(breaks), np.int64)]
        asked = np.flatnonzero((table.column("parts").to_numpy() > 1)[row])
        if len(asked):
            keep = ~repeated[asked]
            _, one = np.unique(np.stack([group[row[asked]], prints_of[asked].view(np.int64)]), axis=1, return_index=True)
            keep[one] = True  # one of each repeated window speaks for its part
            asked = asked[keep]
            rows.append(row[asked])
            starts.append(first[row[asked]] + inside[asked])
            ends.append(starts[-1] + window)
            windows.append(prints_of[asked].view(np.int64))
            weights.append(np.where(repeated[asked], 2, copies[row[asked]]))
        rows = np.concatenate(rows)
        open_ = np.arange(len(rows)) >= len(breaks)
        return record(_FOUND, {
            "doc_id": table.column("doc_id").combine_chunks().take(pa.array(rows)), "key": table.column("key").to_numpy()[rows], "first": np.concatenate(starts),
            "end": np.concatenate(ends), "digit": digit[rows], "window": pa.array(np.concatenate(windows), mask=~open_), "copies": np.concatenate(weights)})

    def run(batches):
        prints, held, size = Fingerprints(2 * _CHUNK_BYTES), [], 0
        for b in batches:
            for piece in blocks([b], "data", 1 << 20):
                if held and size > _CHUNK_BYTES:  # everything before the last group can be worked on
                    table = pa.Table.from_batches(held)
                    digit, salt = table.column("digit").to_numpy(), table.column("salt").to_numpy()
                    change = np.flatnonzero((digit[1:] != digit[:-1]) | (salt[1:] != salt[:-1]))
                    if len(change):
                        cut = int(change[-1]) + 1
                        yield found_in(table.slice(0, cut), prints)
                        held = table.slice(cut).to_batches()
                        size = sum(pa.compute.sum(pa.compute.binary_length(x.column("data"))).as_py() for x in held)
                held.append(piece)
                size += pa.compute.sum(pa.compute.binary_length(piece.column("data"))).as_py() or 0
        if held:
            yield found_in(pa.Table.from_batches(held), prints)

    return spread.mapInArrow(run, "doc_id long, key long, first long, end long, digit long, window long, copies long")


def repeated_ranges(docs: DataFrame, window: int = WINDOW, digit: int = DIGIT, step: int = STEP, group: int = GROUP, buffer: int = BUFFER) -> DataFrame:
    """doc_id, key, first, end: byte ranges that repeated windows cover, in any order and with overlaps."""
    runs = written(first_pass(docs, window, digit, buffer), "runs")
    place = F.struct("doc_id", "key", "first", "n")
    hulls = written(runs.groupBy("digit", "hull").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("one")), "hulls")
    whole = runs.join(hulls.where("copies > 1").select("digit", "hull"), ["digit", "hull"], "left_semi")
    whole = whole.select("doc_id", "key", "first", (F.col("first") + F.col("n") - 1 + window).alias("end"))
    digits = hulls.groupBy("digit").agg(F.count(F.lit(1)).alias("hulls"), F.min("copies").alias("least")).where("hulls > 1 and least = 1")
    parts = F.ceil(F.col("hulls") / group)
    rest = hulls.join(digits.select("digit", parts.alias("parts")), "digit").select("digit", "parts", F.least("copies", F.lit(2)).cast("long").alias("copies"), "one.*")
    rest = rest.withColumn("salt", F.pmod(F.xxhash64("doc_id", "key", "first"), F.col("parts")))
    found = written(refine(with_bytes(docs, rest, window), window, step), "found")
    ranges = found.where("window is null").select("doc_id", "key", "first", "end")
    asked = found.where("window is not null")
    twice = asked.groupBy("digit", "window").agg(F.sum("copies").alias("copies")).where("copies > 1").select("digit", "window")
    late = asked.where("copies = 1").join(twice, ["digit", "window"]).select("doc_id", "key", "first", "end")
    return whole.unionAll(ranges).unionAll(late)


def merged(ranges) -> list[tuple[int, int]]:
    """Ascending ranges without overlap or contact."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2]))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def suffix_dedup(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    ranges = repeated_ranges(docs, **limits)
    lists = ranges.groupBy("doc_id", "key").agg(F.collect_set(F.struct("first", "end")).alias("ranges"))
    named = written(lists.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "ranges"), "ranges")
    keyed = _keyed(docs)
    joined = keyed.join(named, (keyed["key"] == named["_key"]) & keyed["doc_id"].eqNullSafe(named["_id"]), "left").select("doc_id", "text", "ranges")

    def finish(batches):
        for b in blocks(batches):
            rows = []
            for t, ranges in zip(as_bytes(b.column("text")), b.column("ranges").to_pylist()):
                spans = merged((r["first"], r["end"]) for r in ranges or ())
                rows.append((len(t), sum(z - a for a, z in spans), len(spans), hashlib.sha256(cut_out(t, spans)).hexdigest()))
            columns = dict(zip(_OUT.names[1:], zip(*rows))) if rows else {k: [] for k in _OUT.names[1:]}
            yield record(_OUT, {"doc_id": b.column("doc_id"), **columns})

    return joined.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
