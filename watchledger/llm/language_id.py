"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent character n-grams (n = 1..3, words framed by a
boundary mark) by rank.  A document's own profile, from its whole text, is
compared with each language's: every n-gram adds the distance between its two
ranks, or ``PROFILE`` if the language lacks it.  The least sum wins, ties go to
the first language in code point order.

The language profiles are learned from all labelled documents or, by default, from
at most about ``TRAIN_DOCS`` per language, chosen by a hash of their id, which is the
documented bound of the training sample.  Floors of the score come from all.  Counting is spread over the tasks and only the
``PROFILE`` best n-grams per language come to the driver.

Null texts and texts without a letter are ``und`` with score 0.  With no labelled
rows every document is ``und``.  Rows keep their number, repeated ones agree; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchledger.llm.common import blocks, record
from watchledger.operators.ordering import exact_quantiles

ORDERS = (1, 2, 3)
PROFILE = 300
TRAIN_DOCS = 2_000
#: Languages a profile set may hold: the bound of what is broadcast.
MOST_LANGUAGES = 1_000
UNKNOWN = "und"
#: Bytes of text whose n-grams a task holds and sorts together when it learns: they take some 70 times as much.
COUNTED_BYTES = 1 << 20
#: A text is in no learned language if it scores below this share of a low quantile of the labelled documents' own scores.
FLOOR_QUANTILE, FLOOR_SHARE = 0.01, 0.5
_BITS = 21  # of a code point; three of them fit 64 bits


class Letters:
    """Lower-cased code points with everything but letters as 0."""

    def __init__(self):
        self.is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)

    def __call__(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(self.is_letter[codes], codes, 0).astype(np.int64)
        codes = np.concatenate([[0], codes, [0]])
        return codes[(codes != 0) | np.concatenate([[True], codes[:-1] != 0])]  # runs of boundaries become one


def grams(codes: np.ndarray) -> np.ndarray:
    """All n-grams of framed words, each as one integer; none goes beyond a boundary."""
    inside = codes != 0
    found = [codes[inside]]
    if len(codes) > 1:
        pair = (codes[:-1] << _BITS) | codes[1:]
        found.append(pair)
        middle = inside[1:-1]
        found.append(((pair[:-1] << _BITS) | codes[2:])[middle])
    return np.concatenate(found)


def top_grams(found: np.ndarray, k: int = PROFILE) -> np.ndarray:
    """The ``k`` most frequent, most frequent first, ties by value."""
    values, counts = np.unique(found, return_counts=True)
    return values[np.argsort(-counts, kind="stable")[:k]]


def _training_rows(labelled: DataFrame, train_docs: int | None) -> DataFrame:
    """text and lang of the labelled documents; with ``train_docs``, of about so many of each language, drawn by a hash of the id."""
    rows = labelled.where("lang is not null and text is not null").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES + 1).collect()
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not known:
        return rows.select("text", "lang").limit(0)
    if train_docs is None:
        return rows.select("text", "lang")
    share = F.create_map(*[F.lit(x) for r in known for x in (r["lang"], min(1.0, train_docs / r["count"]))])
    place = F.pmod(F.xxhash64(F.lit("profile"), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    return rows.where(place < F.element_at(share, F.col("lang"))).select("text", "lang")


def learn_profiles(labelled: DataFrame, profile: int = PROFILE, train_docs: int | None = TRAIN_DOCS) -> dict[str, np.ndarray]:
    """Profiles by language from the columns doc_id, text and lang; from all rows if ``train_docs`` is None."""
    chosen = _training_rows(labelled, train_docs)

    def count(batches):
        letters = Letters()
        for b in blocks(batches, limit=COUNTED_BYTES):
            by_lang: dict[str, list] = {}
            for t, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                by_lang.setdefault(lang, []).append(grams(letters(t)))
            for lang, found in by_lang.items():
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(counts)], names=["lang", "gram", "n"])

    counts = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("rank", rank).where(F.col("rank") <= profile).select("lang", "gram", "rank").collect()
    found: dict[str, list] = {}
    for r in sorted(best, key=lambda r: (r["lang"], r["rank"])):
        found.setdefault(r["lang"], []).append(r["gram"])
    return {lang: np.asarray(g, np.int64) for lang, g in found.items()}


class Classifier:
    """Out-of-place distances of texts to all profiles."""

    def __init__(self, profiles: dict[str, np.ndarray], profile: int = PROFILE):
        self.langs = sorted(profiles)
        self.size = profile
        self.keys = np.unique(np.concatenate([np.zeros(0, np.int64), *profiles.values()]))
        # rank of each known n-gram in each language; the last row stands for unknown ones
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int32)
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.keys, profiles[lang]), j] = np.arange(len(profiles[lang]))
        self.letters = Letters()

    def __call__(self, text: str | None) -> tuple[str, float]:
        codes = self.letters(text or "")
        if not self.langs or not codes.any():
            return UNKNOWN, 0.0
        mine = top_grams(grams(codes), self.size)
        at = np.searchsorted(self.keys, mine)
        at[at == len(self.keys)] = 0
        rows = self.ranks[np.where(self.keys[at] == mine, at, len(self.keys))]
        out = np.where(rows < 0, self.size, np.abs(rows - np.arange(len(mine))[:, None])).sum(axis=0)
        best = int(np.argmin(out))
        return self.langs[best], float(1 - out[best] / (self.size * len(mine)))


_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], profile: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred, score; only the text is looked at."""

    def run(batches):
        classify = Classifier(profiles, profile)
        for b in blocks(batches):
            found = [classify(t) for t in b.column("text").to_pylist()]
            yield record(_OUT, {"doc_id": b.column("doc_id"), "lang_pred": [x for x, _ in found], "score": [y for _, y in found]})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def score_floors(labelled: DataFrame, profiles: dict[str, np.ndarray]) -> dict[str, float]:
    """For each language the score below which a text is in none: ``FLOOR_SHARE`` of the ``FLOOR_QUANTILE`` of all labelled documents' own scores."""
    scores = predict(_training_rows(labelled, None).select(F.lit(0).alias("doc_id"), "text"), profiles).where(F.col("lang_pred") != UNKNOWN)
    rows = exact_quantiles(scores, "score", {"low": FLOOR_QUANTILE}, by=["lang_pred"]).collect()  # one row a language
    return {r["lang_pred"]: FLOOR_SHARE * r["low"] for r in rows}


def in_a_language(docs: DataFrame, profiles: dict[str, np.ndarray], floors: dict[str, float] | None = None, profile: int = PROFILE) -> DataFrame:
    """The rows of ``docs`` whose text is in some learned language and scores no less than its floor, with all their columns."""
    least = floors or {}

    def run(batches):
        classify = Classifier(profiles, profile)
        for b in blocks(batches):
            found = [classify(t) for t in b.column("text").to_pylist()]
            yield b.filter(pa.array([lang != UNKNOWN and score >= least.get(lang, 0.0) for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
