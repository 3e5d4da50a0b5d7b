"""Quality rules: bands of zstandard ratios over whole documents and fixed chunks.

Repetitive text compresses far better than prose, noise far worse.  A ratio is
the compressed size over the size in bytes.  Short texts compress less well, so
every length class has its own band.  A document is kept if its base rules hold,
its whole-text ratio lies in the band of its length, and at most
``BAD_CHUNKS`` of its bytes lie in chunks of ``CHUNK`` bytes outside the chunk
band; the last partial chunk has the band of its own length.

Up to 128 bytes prose compresses as badly as base64 or printable noise, and up to
4 KB as badly as hex digits in words, so a ratio cannot tell these apart there.

Limits are learned (``learn_bands``) from all labelled clean documents: in each
length class the lowest and highest ratio that all but a small share of them reach on
either side, as exact quantiles over ranks that Spark finds.  ``DEFAULT`` stands in where there are no labels.

Base rules, on words ``[^\\x20\\x09-\\x0D]+``: fewer than 10 words, or more than
20 % of the words inside 5-word windows that occur twice or more.  Null and empty
texts have no words and fail.  Repeated rows and ids get the same verdict each;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from functools import reduce
from math import inf, log2
from operator import or_

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import as_bytes, blocks, record, written
from watchledger.operators.ordering import exact_quantiles, running_total

LEVEL = 3
CHUNK = 4096
#: (up to so many bytes, lowest and highest ratio allowed).  The upper limits lie just above the highest ratio that the clean documents
#: of sf0.01, sf0.1 and a third of check_l (quality 1) and their tails reach at that length; fine classes, because the ratio of prose falls quickly with the length.
WHOLE_BANDS = [
    (32, 0.45, 10.0), (48, 0.45, 1.30), (64, 0.45, 1.22), (96, 0.45, 1.17), (128, 0.45, 1.10), (160, 0.42, 0.98), (192, 0.42, 0.915), (224, 0.42, 0.89),
    (256, 0.42, 0.83), (320, 0.38, 0.82), (384, 0.38, 0.775), (448, 0.38, 0.75), (512, 0.38, 0.74), (640, 0.34, 0.71), (768, 0.34, 0.70), (896, 0.34, 0.675),
    (1024, 0.34, 0.635), (1280, 0.30, 0.625), (1536, 0.30, 0.59), (1792, 0.30, 0.58), (2048, 0.30, 0.57), (2560, 0.30, 0.57), (3072, 0.30, 0.545),
    (4096, 0.30, 0.528), (16384, 0.26, 0.52), (None, 0.20, 0.47)]
CHUNK_BAND = (0.25, 0.52)
#: The share of the clean documents below the lower and above the upper limit of their class.
OUTSIDE = (0.01, 0.001)
#: Length classes per doubling, and the clean documents (of the nearest lengths) that the limits of a class come from, at least.
CLASSES = 8
CLASS_DOCS = 400
#: Share of the bytes that may lie in chunks outside their band.
BAD_CHUNKS = 0.25
WINDOW = 5

_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_OUT = pa.schema([("doc_id", pa.int64())] + [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_bytes", pa.int64()), ("ratio", pa.float64()), ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64())])


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    windows = list(zip(*(words[i:] for i in range(window))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total = end = 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + window - max(end, i)
            end = i + window
    return total


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def base_figures(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()  # bytes split at the same six characters
    letters = len(b"".join(words).translate(None, _CONTINUATION))
    return len(words), letters, len(text) - len(text.translate(None, _SYMBOLS)), duplicate_lines(text), repeated_words(words)


@dataclass(frozen=True)
class Bands:
    """Limits of the whole text by length, (up to so many bytes, lowest, highest), and of full chunks."""

    whole: tuple[tuple[float, float, float], ...]
    chunk: tuple[float, float]

    def of(self, n_bytes: int) -> tuple[float, float]:
        return self.whole[bisect_left(self.whole, (n_bytes,))][1:]


DEFAULT = Bands(tuple((upto or inf, lo, hi) for upto, lo, hi in WHOLE_BANDS), CHUNK_BAND)


_MEASURED = "_id long, n long, class int, ratio double, least double, most double"


def measured(texts: DataFrame) -> DataFrame:
    """_id, size, length class, ratio, and the least and greatest chunk ratio of every text that keeps the base rules."""

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for b in blocks(batches):
            found = []
            for doc, t in zip(b.column("_id").to_pylist(), as_bytes(b.column("text"))):
                n_words, *_, repeats = base_figures(t)
                if t and not _base_failed(n_words, repeats):
                    chunks = [len(compressor.compress(t[i : i + CHUNK])) / CHUNK for i in range(0, len(t) - CHUNK + 1, CHUNK)]
                    found.append((doc, len(t), int(CLASSES * log2(len(t))), len(compressor.compress(t)) / len(t), min(chunks, default=None), max(chunks, default=None)))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)], names=["_id", "n", "class", "ratio", "least", "most"])

    return texts.select("_id", F.col("text").cast("string").alias("text")).mapInArrow(run, _MEASURED)


def placed_ratios(found: DataFrame, spans: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
    """(first place, place behind the last, ratio) of the rows that ``spans`` of places in the order of (n, ratio) touch; equal rows are one."""
    counts = found.groupBy("n", "ratio").agg(F.count(F.lit(1)).alias("rows"))
    placed = running_total(counts, ["n", "ratio"], F.col("rows"), out="upto").select((F.col("upto") - F.col("rows")).alias("start"), "upto", "ratio")
    merged: list[list[int]] = []
    for a, z in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(z, merged[-1][1])
        else:
            merged.append([a, z])
    inside = reduce(or_, [(F.col("start") < z) & (F.col("upto") > a) for a, z in merged])
    return sorted(map(tuple, placed.where(inside).collect()))


def fitted(found: DataFrame, outside: tuple[float, float] = OUTSIDE, class_docs: int = CLASS_DOCS) -> Bands:
    """Limits that all but ``outside`` (below, above) of the measured texts keep.

    A class with fewer than ``class_docs`` texts takes in the texts of the nearest lengths; only these
    few come to the driver, of the other classes their two quantiles.
    """
    found = written(found, "ratios")
    held = {r["class"]: (r["rows"], r["chunked"]) for r in found.groupBy("class").agg(F.count(F.lit(1)).alias("rows"), F.count("least").alias("chunked")).collect()}  # some hundred rows
    if not held:
        return DEFAULT
    shares = {"lo": outside[0], "hi": 1 - outside[1]}
    full = [c for c, (n, _) in held.items() if n >= class_docs]
    limits = {r["class"]: (r["lo"], r["hi"]) for r in exact_quantiles(found.where(F.col("class").isin(full)), "ratio", shares, by=["class"]).collect()} if full else {}
    total, before, spans = sum(n for n, _ in held.values()), 0, {}
    for c in range(min(held), max(held) + 1):
        n = held.get(c, (0, 0))[0]
        if c not in limits:
            short = (class_docs - n + 1) // 2
            spans[c] = max(0, before - short), min(total, before + n + short)
        before += n
    if spans:
        rows = placed_ratios(found, list(spans.values()))
        for c, (a, z) in spans.items():
            near = np.concatenate([np.full(min(upto, z) - max(start, a), ratio) for start, upto, ratio in rows if start < z and upto > a])
            limits[c] = tuple(np.quantile(near, list(shares.values())).tolist())
    whole = tuple((inf if c == max(held) else 2 ** ((c + 1) / CLASSES), *limits[c]) for c in sorted(limits))
    if not any(chunked for _, chunked in held.values()):
        return Bands(whole, CHUNK_BAND)
    return Bands(whole, tuple(exact_quantiles(found, side, {"limit": share}).first()["limit"] for side, share in (("least", shares["lo"]), ("most", shares["hi"]))))


def learn_bands(docs: DataFrame, labels: DataFrame, outside: tuple[float, float] = OUTSIDE) -> Bands:
    """Limits from all documents of quality 1 that keep the base rules."""
    clean = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("_id")).distinct()
    # All texts are measured where they lie; only the figures meet the labels.
    every = measured(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("_id"), "text"))
    return fitted(every.join(clean, "_id", "left_semi").drop("_id"), outside)


def _base_failed(n_words: int, repeats: int) -> bool:
    return n_words < 10 or 100 * repeats > 20 * n_words


def ratios(text: bytes, compressor: zstandard.ZstdCompressor, bands: Bands = DEFAULT) -> tuple[float, int, int, int]:
    """Ratio of the whole text, number of chunks, how many of these are outside their band, and the bytes in those."""
    if not text:
        return 0.0, 0, 0, 0
    whole = len(compressor.compress(text)) / len(text)
    view = memoryview(text)
    bad = []
    for i in range(0, len(text), CHUNK):
        c = view[i : i + CHUNK]
        lo, hi = bands.chunk if len(c) == CHUNK else bands.of(len(c))
        if not lo <= (whole if len(c) == len(text) else len(compressor.compress(c)) / len(c)) <= hi:
            bad.append(len(c))
    return whole, -(-len(text) // CHUNK), len(bad), sum(bad)


def verdict(text: bytes, compressor: zstandard.ZstdCompressor, bands: Bands = DEFAULT) -> tuple:
    n_words, letters, symbols, lines, repeats = base_figures(text)
    failed = _base_failed(n_words, repeats)
    ratio, chunks, bad, bad_bytes = ratios(text, compressor, bands)
    lo, hi = bands.of(len(text))
    kept = not failed and lo <= ratio <= hi and bad_bytes <= BAD_CHUNKS * len(text)
    return n_words, letters, symbols, lines, repeats, failed, kept, len(text), ratio, chunks, bad


def quality_bands(docs: DataFrame, bands: Bands = DEFAULT) -> DataFrame:
    """Base figures, compression figures and the verdict of every document."""

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for b in blocks(batches):
            rows = [verdict(t, compressor, bands) for t in as_bytes(b.column("text"))]
            columns = dict(zip(_OUT.names[1:], zip(*rows))) if rows else {n: [] for n in _OUT.names[1:]}
            yield record(_OUT, {"doc_id": b.column("doc_id"), **columns})

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_bytes long, ratio double, n_chunks long, n_bad_chunks long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
