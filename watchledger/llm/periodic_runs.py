"""Runs: maximal periodic stretches of words, found with string synchronising sets.

A run is a stretch of consecutive words with smallest period q and at least
``MIN_EXPONENT`` periods, which no neighbouring word extends.  The texts of a
block are laid end to end, parted by words of their own, and worked on together.

* Periods below the first scale are found by comparing the words with themselves
  shifted: the highly periodic regions.
* At each dyadic scale t the periods t to 2t - 1 come from a synchronising set.
  Every window of t words has a hash; windows inside a known run of period t / 4
  at most count as highly periodic and have none.  Position i is chosen if the
  least hash of the windows at i, ..., i + t is that at i or at i + t.  The choice
  depends on 2t words only, and t consecutive positions hold a chosen one unless
  all is highly periodic.  So the first t positions of a run of period q hold a
  chosen s; s + q has the same 2t > q words, is chosen too and is the next such
  position: neighbouring equal contexts propose (s, q).
* A proposal is extended to both sides by comparing words, never hashes.
* A text without two equal contexts at one scale has no longer period and is left out of the next.

Null and empty texts have no words and no runs.  Repeated rows are rows of their
own, ties cannot arise, an empty table gives an empty result, further columns are
kept by name (``keep``).  A text is held whole by one task, about 100 bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import map_blocks

MIN_EXPONENT = 4
MIN_LENGTH = 6
#: The first scale; smaller periods are found by shifts.  A power of two, so that known runs cover a scale's highly periodic windows.
FIRST_SCALE = 4
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Word bounds of every text (one more than texts) and all words, parted at the six white-space characters; null has none."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, ends = parts.values, parts.offsets.to_numpy()
    words, ends = words.slice(ends[0], ends[-1] - ends[0]), ends - ends[0]
    full = pc.not_equal(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)])
    return before[ends], words.filter(full)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two neighbouring hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ahead(x: np.ndarray, by: int, fill) -> np.ndarray:
    out = np.full_like(x, fill)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


def _matching(w: np.ndarray, at: int, q: int, step: int) -> int:
    """How many positions at, at + step, ... hold a word that recurs q later; looks ahead in growing pieces."""
    found, size = 0, 64
    while True:
        lo, hi = (at + found, min(at + found + size, len(w) - q)) if step > 0 else (max(at - found - size + 1, 0), at - found + 1)
        if lo >= hi:
            return found
        differ = np.flatnonzero(w[lo:hi] != w[lo + q : hi + q])
        if len(differ):
            return found + int(differ[0] if step > 0 else hi - lo - 1 - differ[-1])
        found, size = found + hi - lo, size * 2


class _Texts:
    """Texts laid end to end: word numbers, text and offset of each; a word of its own after every text."""

    def __init__(self, words: np.ndarray, texts: np.ndarray, sizes: np.ndarray):
        self.texts, self.sizes = texts, sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.words = words
        self.owner = np.repeat(np.arange(len(texts)), sizes + 1)

    def only(self, kept: np.ndarray) -> tuple["_Texts", np.ndarray]:
        """The kept texts alone, and the mask of their words."""
        mask = kept[self.owner]
        return _Texts(self.words[mask], self.texts[kept], self.sizes[kept]), mask


def _shifted(t: _Texts, q: int) -> list[np.ndarray]:
    """Runs of a period so small that shifting all words by it finds them."""
    w = t.words
    same = np.zeros(len(w) + 1, bool)
    same[1 : len(w) - q + 1] = w[:-q] == w[q:] if len(w) > q else False
    edges = np.flatnonzero(same[1:] != same[:-1])
    first, last = edges[::2], edges[1::2]
    enough = last - first >= (MIN_EXPONENT - 1) * q
    first, last = first[enough], last[enough]
    smallest = np.ones(len(first), bool)
    for p in range(1, q):
        if q % p == 0:  # with so many periods a smaller one divides q
            smallest &= ~np.array([(w[f : f + q - p] == w[f + p : f + q]).all() for f in first], bool)
    first, last = first[smallest], last[smallest]
    return [np.stack([t.owner[first], first - t.starts[t.owner[first]], last - first + q, np.full(len(first), q)], axis=1)]


def runs_of(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """All runs as rows (text, start, length, period), by text, start and period; ``words`` are numbers, text i holds ``bounds[i]`` to ``bounds[i + 1]``."""
    sizes = np.diff(bounds)
    laid = np.empty(len(words) + len(sizes), np.int64)
    ends = bounds[1:] + np.arange(len(sizes))
    inside = np.ones(len(laid), bool)
    inside[ends] = False
    laid[inside], laid[ends] = words, -1 - np.arange(len(sizes))
    t = _Texts(laid, np.arange(len(sizes)), sizes)
    found: list[np.ndarray] = [np.zeros((0, 4), np.int64)]
    for q in range(1, FIRST_SCALE):
        found += _shifted(t, q)
    scale = 1
    hashes = _mixed(laid.astype(np.uint64), laid.astype(np.uint64))
    while True:
        t, mask = t.only(t.sizes >= max(scale, FIRST_SCALE) * MIN_EXPONENT)
        hashes = hashes[mask]
        if not len(t.texts):
            break
        if scale >= FIRST_SCALE:
            runs, repeated = _at_scale(t, hashes, scale, np.concatenate(found))
            found.append(runs)
            t, mask = t.only(repeated)
            hashes = hashes[mask]
        hashes = _mixed(hashes, _ahead(hashes, scale, 0))
        scale *= 2
    runs = np.concatenate(found)
    runs = runs[runs[:, 2] >= MIN_LENGTH]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _at_scale(t: _Texts, hashes: np.ndarray, scale: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs with periods ``scale`` to ``2 * scale - 1``, and which texts have two equal contexts; ``hashes`` are those of the windows of ``scale`` words."""
    place = np.full(int(max(t.texts[-1], known[:, 0].max(initial=0))) + 1, -1)
    place[t.texts] = np.arange(len(t.texts))
    ids = hashes.copy()
    for text, start, length, _ in known[(known[:, 3] * MIN_EXPONENT <= scale) & (known[:, 2] >= scale)]:
        if place[text] >= 0:
            first = t.starts[place[text]] + start
            ids[first : first + length - scale + 1] = _NONE
    least, width = ids, 1
    while width < scale:
        least = np.minimum(least, _ahead(least, width, _NONE))
        width *= 2
    after = _ahead(ids, scale, _NONE)
    least = np.minimum(least, after)
    chosen = np.flatnonzero((least != _NONE) & ((least == ids) | (least == after)))
    chosen = chosen[t.starts[t.owner[chosen]] + t.sizes[t.owner[chosen]] - chosen >= 2 * scale]
    context = _mixed(hashes[chosen], hashes[chosen + scale])
    order = np.argsort(context, kind="stable")
    at, context = chosen[order], context[order]
    pairs = np.flatnonzero((context[1:] == context[:-1]) & (t.owner[at[1:]] == t.owner[at[:-1]]))
    repeated = np.zeros(len(t.texts), bool)
    repeated[t.owner[at[pairs]]] = True
    period = at[pairs + 1] - at[pairs]
    near = (period >= scale) & (period < 2 * scale)
    at, period = at[pairs][near], period[near]
    order = np.lexsort((at, period))
    runs, end, last = [], -1, 0
    for s, q in zip(at[order].tolist(), period[order].tolist()):
        if q == last and s + q < end:  # inside the run found before
            continue
        ahead = _matching(t.words, s, q, 1)
        first, end, last = s - _matching(t.words, s - 1, q, -1), s + ahead + q, q
        if ahead < 2 * scale:  # equal hashes of different words
            end = -1
        elif end - first >= MIN_EXPONENT * q:
            text = int(t.owner[s])
            runs.append((int(t.texts[text]), first - int(t.starts[text]), end - first, q))
    return np.array(runs, np.int64).reshape(-1, 4), repeated


def collapsed_words(bounds: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Mask of the words that stay: all but those that a run contains after its first period."""
    change = np.zeros(int(bounds[-1]) + 1, np.int64)
    np.add.at(change, bounds[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
    np.add.at(change, bounds[runs[:, 0]] + runs[:, 1] + runs[:, 2], -1)
    return np.cumsum(change)[:-1] == 0


def _joined(words: pa.Array, bounds: np.ndarray) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words.cast(pa.string())), " ")


def _block(block: pa.RecordBatch) -> pa.RecordBatch:
    bounds, words = split_words(block.column("_text"))
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = runs_of(numbers, bounds)
    stays = collapsed_words(bounds, runs)
    kept = np.concatenate([[0], np.cumsum(stays, dtype=np.int64)])[bounds]
    items = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
    upto = pa.array(np.searchsorted(runs[:, 0], np.arange(len(bounds))), pa.int32())
    made = [pa.ListArray.from_arrays(upto, items).cast(_RUN_TYPE), _joined(words.filter(pa.array(stays)), kept)]
    return pa.RecordBatch.from_arrays([*block.columns[:-1], *made], [*block.schema.names[:-1], "runs", "collapsed"])


def periodic_runs(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) of every row, its ``runs`` and its ``collapsed`` text: the words that no run repeats."""
    keep = [c for c in docs.columns if c not in ("runs", "collapsed")] if keep is None else keep
    narrow = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return map_blocks(narrow, _block, f"{kept}, runs {_RUNS}, collapsed string", "_text")


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest exponent, exactly compared; ties go to the smallest start, then period; null without a run."""
    power = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    best = lambda a, b: F.when(power(b, a) > 0, b).otherwise(a)  # runs are in order: the earlier one stays
    return F.aggregate(runs, F.get(F.col(runs), F.lit(0)), best)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; of every tenth id (by crc32) the words from one position on repeat with one period.

    A row without an id is left as it is.
    """

    def plant(block: pa.RecordBatch) -> pa.RecordBatch:
        texts = block.column("text").to_pylist()
        for i, h in enumerate(block.column("h").to_pylist()):
            if h is not None and h % 10 == 0 and texts[i]:
                words = texts[i].encode().split()  # bytes are split at the six white-space characters only
                if n := len(words):
                    g = h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    tail = words[a : a + p]
                    texts[i] = b" ".join(words[:a] + (tail * ((n - a) // p + 1))[: n - a]).decode()
        return pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    narrow = docs.select("doc_id", F.crc32(F.col("doc_id").cast("string")).alias("h"), "text")
    return map_blocks(narrow, plant, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string")


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document with planted runs: number of runs, the strongest one, digests of all runs and of the collapsed text."""
    found = periodic_runs(with_planted_runs(docs), ["doc_id"])
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("_best", strongest()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
