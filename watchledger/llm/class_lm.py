"""Language-model scoring with Brown classes.

Tokens are lower-cased (A-Z) words and one end per text.  The model is a class
bigram: P(w | v) = P(class(w) | class(v)) * P(w | class(w)), both smoothed by
adding to the counts, and ``score`` is the log10 probability of the whole text.
``base_score`` is the add-one unigram over the same counts.

1. *Counts.*  Every training word is counted, per task first.  Words above a
   count threshold (at most ``HEAD`` of them, found from a log histogram) go to
   all tasks; the long tail of rare words is only ever joined.
2. *Units.*  The ``OWN`` most frequent words stand for themselves, every other
   word for its last two bytes (the ``ENDINGS`` most frequent, or one rest unit).
   Unit bigrams are counted over the whole training text, at most units**2 cells.
3. *Exchange clustering.*  Units move between ``CLASSES`` classes one by one, each
   to where the likelihood of the class bigrams is largest, until none moves or
   ``SWEEPS`` are done.  The end has its own.
4. *All others.*  Each other word that all tasks hold, and each ending without a unit,
   is then moved by the same gain to a class of its own choice, from its neighbours'
   classes, which Spark counts and looks at.  Words of the tail have their ending's
   class.  The class bigrams are counted anew with all classes.
5. *Scores.*  One pass scores transitions, frequent words and the end in place
   and lists the rare words; those meet their counts in a join on the word.

An unseen word has the class of its ending and the probability of one unseen
slot of that class.  Null texts are empty: one end token.  Null ids belong to the
training half.  Without training rows all counts are 0 and score equals
base_score.  Repeated rows are scored once each; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import as_bytes, blocks, record, remainder, row_numbers, written

HEAD = 100_000
OWN = 400
ENDINGS = 150
CLASSES = 48
SWEEPS = 8
ADD = 0.5
#: Distinct words a task holds before it passes its counts on.
_COUNTER = 400_000
#: Cells of neighbouring classes that a task gathers before it passes them on.
_CELLS = 2_000_000


def word_counts(texts: DataFrame) -> DataFrame:
    """word and c over all texts."""

    def run(batches):
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for b in blocks(batches):
            for t in as_bytes(b.column("text")):
                counts.update(t.lower().split())
            if len(counts) > _COUNTER:
                yield out()
                counts.clear()
        yield out()

    return texts.select(F.col("text").cast("string")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """Frequent words with their counts, and the unit of any word.  The end is the last unit."""

    words: list[bytes]
    counts: np.ndarray
    endings: dict[bytes, int]
    own: int
    ids: dict[bytes, int] = field(default_factory=dict)
    head_units: np.ndarray | None = None

    def __post_init__(self):
        self.ids = {w: i for i, w in enumerate(self.words)}
        self.head_units = np.asarray([i if i < self.own else self.ending_unit(w) for i, w in enumerate(self.words)] + [0], np.int64)

    def plain(self) -> tuple:
        """Built-in values only: what is broadcast needs no installed package."""
        return self.words, self.counts, self.endings, self.own

    @property
    def end(self) -> int:
        return self.own + len(self.endings) + 1

    def ending_unit(self, word: bytes) -> int:
        return self.endings.get(word[-2:], self.end - 1)

    def units(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of frequent words (-1 for others) and units."""
        ids = np.fromiter((self.ids.get(w, -1) for w in words), np.int64, len(words))
        units = self.head_units[ids]
        for i in np.flatnonzero(ids < 0):
            units[i] = self.ending_unit(words[i])
        return ids, units


def log_band(c):
    """Eight bands per doubling of the count."""
    return F.floor(F.log2(c) * 8).cast("int")


def vocabulary(counts: DataFrame, head: int = HEAD, own: int = OWN, endings: int = ENDINGS) -> tuple[Vocabulary, dict[bytes, int]]:
    """The vocabulary of a written count table, and the number of words per two-byte ending."""
    bands = sorted(counts.groupBy(log_band("c").alias("band")).count().collect(), reverse=True)  # some hundred rows at most
    held, least = 0, None
    for band, n in bands:
        if held + n > head:
            break
        held, least = held + n, band
    found = counts.where(log_band("c") >= least).toArrow().to_pydict() if least is not None else {"word": [], "c": []}
    order = sorted(range(len(found["word"])), key=lambda i: (-found["c"][i], found["word"][i]))
    words = [found["word"][i] for i in order]
    last = F.expr("substring(word, greatest(length(word) - 1, 1), 2)")
    by_ending = counts.groupBy(last.alias("ending")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toArrow().to_pydict()  # at most 65,792
    tokens = dict(zip(by_ending["ending"], by_ending["c"]))
    for i in order[:own]:
        tokens[found["word"][i][-2:]] -= found["c"][i]
    best = sorted(tokens, key=lambda e: (-tokens[e], e))[:endings]
    vocab = Vocabulary(words, np.asarray([found["c"][i] for i in order], np.int64), {e: min(own, len(words)) + k for k, e in enumerate(best)}, min(own, len(words)))
    return vocab, dict(zip(by_ending["ending"], by_ending["v"]))


def unit_bigrams(texts: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Counts of neighbouring units, the end standing before the first and after the last word."""
    n = vocab.end + 1
    shared = texts.sparkSession.sparkContext.broadcast(vocab.plain())

    def run(batches):
        v, cells = Vocabulary(*shared.value), np.zeros(n * n, np.int64)
        for b in blocks(batches, limit=1 << 20):
            for t in as_bytes(b.column("text")):
                units = np.concatenate([[v.end], v.units(t.lower().split())[1], [v.end]])
                np.add.at(cells, units[:-1] * n + units[1:], 1)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], names=["cell", "n"])

    found = texts.select(F.col("text").cast("string")).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n * n, np.int64)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def gains(table: np.ndarray, right: np.ndarray, left: np.ndarray, own: int) -> np.ndarray:
    """What the likelihood gains in each class but the last from a unit with these neighbours that ``table`` lacks."""
    k = len(table) - 1
    each = np.arange(k)
    rows, columns = table[:k], table[:, :k].T
    gain = (_xlogx(rows + right) - _xlogx(rows)).sum(axis=1) + (_xlogx(columns + left) - _xlogx(columns)).sum(axis=1)
    corner = table[each, each]
    gain += _xlogx(corner + right[:k] + left[:k] + own) - _xlogx(corner + right[:k]) - _xlogx(corner + left[:k]) + _xlogx(corner)
    # Totals of a class without the unit but with the other side of its bigrams, which stays wherever it goes.
    for total, added in ((table.sum(axis=1)[:k] + left[:k], right.sum() + own), (table.sum(axis=0)[:k] + right[:k], left.sum() + own)):
        gain -= _xlogx(total + added) - _xlogx(total)
    return gain


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of every unit; the last unit (the end) keeps the last class for itself."""
    n = len(bigrams)
    counts = bigrams.sum(axis=1) + bigrams.sum(axis=0)
    order = np.argsort(-counts[:-1], kind="stable")
    k = max(1, min(classes, n - 1))
    of = np.full(n, k)
    of[order] = np.arange(n - 1) % k
    table = np.zeros((k + 1, k + 1), np.int64)
    np.add.at(table, (of[:, None], of[None, :]), bigrams)
    for _ in range(sweeps):
        moves = 0
        for u in order:
            right, left = np.zeros(k + 1, np.int64), np.zeros(k + 1, np.int64)
            np.add.at(right, of, bigrams[u])
            np.add.at(left, of, bigrams[:, u])
            own, here = bigrams[u, u], of[u]
            right[here] -= own
            left[here] -= own
            table[here] -= right
            table[:, here] -= left
            table[here, here] -= own
            gain = gains(table, right, left, own)
            best = int(np.argmax(gain))
            best = best if gain[best] > gain[here] + 1e-9 else here
            table[best] += right
            table[:, best] += left
            table[best, best] += own
            of[u], moves = best, moves + (best != here)
        if not moves:
            break
    return of


@dataclass
class ClassModel:
    """Everything a task needs to score, but for the counts of rare words."""

    vocab: Vocabulary
    of_unit: np.ndarray
    transition: np.ndarray  # log10 P(class | class)
    norm: np.ndarray  # log10 of the emission denominators
    end_count: int
    tokens: int
    distinct: int

    def plain(self) -> tuple:
        return (self.vocab.plain(), self.of_unit, self.transition, self.norm, self.end_count, self.tokens, self.distinct)

    @staticmethod
    def of(vocab: tuple, *rest) -> ClassModel:
        return ClassModel(Vocabulary(*vocab), *rest)


def _neighbours(texts: DataFrame, vocab: Vocabulary, of: np.ndarray, moving: np.ndarray) -> DataFrame:
    """unit, at, n: how often each unit of ``moving`` stands before class ``at``, behind class ``at`` - k, and before itself (``at`` = 2 k), with k classes."""
    k = int(of.max()) + 1
    shared = texts.sparkSession.sparkContext.broadcast((vocab.plain(), of, moving))

    def run(batches):
        plain, of, moving = shared.value
        v, cells, held = Vocabulary(*plain), [], 0

        def out():
            cell, n = np.unique(np.concatenate([np.zeros(0, np.int64), *cells]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(cell // (2 * k + 1)), pa.array((cell % (2 * k + 1)).astype(np.int32)), pa.array(n)], names=["unit", "at", "n"])

        for b in blocks(batches, limit=1 << 20):
            for t in as_bytes(b.column("text")):
                units = np.concatenate([[v.end], v.units(t.lower().split())[1], [v.end]])
                at = np.flatnonzero(moving[units])
                u, classes = units[at] * (2 * k + 1), of[units]
                cells += [u + classes[at + 1], u + k + classes[at - 1], u[units[at + 1] == units[at]] + 2 * k]
                held += 2 * len(at)
            if held > _CELLS:
                yield out()
                cells, held = [], 0
        yield out()

    return texts.select(F.col("text").cast("string")).mapInArrow(run, "unit long, at int, n long").groupBy("unit", "at").agg(F.sum("n").alias("n"))


def own_classes(texts: DataFrame, vocab: Vocabulary, of: np.ndarray, bigrams: np.ndarray, endings: list[bytes]) -> tuple[Vocabulary, np.ndarray]:
    """A vocabulary with a unit for every word of ``vocab`` and every ending, and their classes."""
    k = int(of.max()) + 1
    words = len(vocab.words)
    wide = Vocabulary(vocab.words, vocab.counts, {e: words + i for i, e in enumerate(sorted(endings))}, words)
    start = of[np.concatenate([vocab.head_units[:-1], [vocab.ending_unit(e) for e in wide.endings], [vocab.end - 1, vocab.end]]).astype(np.int64)]
    moving = np.ones(wide.end + 1, bool)
    moving[: vocab.own] = moving[wide.end - 1 :] = False
    moving[[wide.endings[e] for e in vocab.endings]] = False  # these were exchanged
    table = np.zeros((k, k), np.int64)
    np.add.at(table, (of[:, None], of[None, :]), bigrams)

    def choose(batches):
        for b in batches:
            found = []
            for unit, cells in zip(b.column("unit").to_pylist(), b.column("cells").to_pylist()):
                sides = np.zeros(2 * k + 1, np.int64)
                sides[[c["at"] for c in cells]] = [c["n"] for c in cells]
                right, left, own, here = sides[:k], sides[k : 2 * k], sides[2 * k], start[unit]
                right[here] -= own
                left[here] -= own
                rest = table.copy()
                rest[here] -= right
                rest[:, here] -= left
                rest[here, here] -= own
                gain = gains(rest, right, left, own)
                best = int(np.argmax(gain))
                found.append(best if gain[best] > gain[here] + 1e-9 else int(here))
            yield pa.RecordBatch.from_arrays([b.column("unit"), pa.array(found, pa.int32())], names=["unit", "class"])

    sides = _neighbours(texts, wide, start, moving).groupBy("unit").agg(F.collect_list(F.struct("at", "n")).alias("cells"))
    moved = sides.mapInArrow(choose, "unit long, class int").toArrow()  # at most a number for each word of all tasks and each ending
    start[moved.column("unit").to_numpy()] = moved.column("class").to_numpy()
    return wide, start


def class_bigrams(texts: DataFrame, vocab: Vocabulary, of: np.ndarray) -> np.ndarray:
    """Counts of neighbouring classes."""
    k = int(of.max()) + 1
    shared = texts.sparkSession.sparkContext.broadcast((vocab.plain(), of))

    def run(batches):
        plain, of = shared.value
        v, cells = Vocabulary(*plain), np.zeros(k * k, np.int64)
        for b in blocks(batches, limit=1 << 20):
            for t in as_bytes(b.column("text")):
                classes = of[np.concatenate([[v.end], v.units(t.lower().split())[1], [v.end]])]
                cells += np.bincount(classes[:-1] * k + classes[1:], minlength=k * k)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], names=["cell", "n"])

    found = texts.select(F.col("text").cast("string")).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(k * k, np.int64)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(k, k)


def train(texts: DataFrame) -> tuple[ClassModel, DataFrame]:
    """The model and the written count table."""
    counts = written(word_counts(texts), "word-counts")
    seeds, ending_words = vocabulary(counts)
    bigrams = unit_bigrams(texts, seeds)
    vocab, of = own_classes(texts, seeds, exchange(bigrams), bigrams, list(ending_words))
    pairs = class_bigrams(texts, vocab, of)
    k = len(pairs)
    in_class = pairs.sum(axis=0)
    distinct = np.bincount(of[: vocab.own], minlength=k).astype(float)
    for ending, v in ending_words.items():
        distinct[of[vocab.ending_unit(ending)]] += v
    for w in vocab.words:
        distinct[of[vocab.ending_unit(w)]] -= 1
    distinct[of[vocab.end]] += 1
    ends = int(in_class[of[vocab.end]])
    model = ClassModel(
        vocab, of, np.log10((pairs + ADD) / (pairs.sum(axis=1, keepdims=True) + ADD * k)), np.log10(in_class + distinct + 1), ends,
        int(pairs.sum()), int(sum(ending_words.values())) + (ends > 0))
    return model, counts


_LOCAL = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("counted", pa.float64()), ("model", pa.float64()),
                    ("rare", pa.list_(pa.binary())), ("times", pa.list_(pa.int32()))])


def local_scores(docs: DataFrame, model: ClassModel) -> DataFrame:
    """What a task can tell by itself: sums over frequent words, transitions, and the rare words with their number."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    def run(batches):
        m, rows = ClassModel.of(*shared.value), row_numbers()
        log_counts = np.log10(np.append(m.vocab.counts, 0) + 1.0)  # the last stands for rare words
        end_log = float(np.log10(m.end_count + 1))
        for b in blocks(batches, limit=4 << 20):
            out = []
            for t in as_bytes(b.column("text")):
                words = t.lower().split()
                ids, units = m.vocab.units(words)
                classes = m.of_unit[np.concatenate([[m.vocab.end], units, [m.vocab.end]])]
                rare = Counter(words[i] for i in np.flatnonzero(ids < 0))
                fit = m.transition[classes[:-1], classes[1:]].sum() - m.norm[classes[1:]].sum()
                out.append((next(rows), len(words) + 1, int((ids >= 0).sum()) + (m.end_count > 0), log_counts[ids].sum() + end_log, fit, list(rare), list(rare.values())))
            columns = dict(zip(_LOCAL.names[1:], zip(*out))) if out else {n: [] for n in _LOCAL.names[1:]}
            yield record(_LOCAL, {"doc_id": b.column("doc_id"), **columns})

    schema = "doc_id long, row long, n_tokens long, known long, counted double, model double, rare array<binary>, times array<int>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def class_lm_scores(docs: DataFrame, held_out=None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every document."""
    held_out = remainder("doc_id", 7) == 2 if held_out is None else held_out
    model, counts = train(docs.where(~held_out))
    local = written(local_scores(docs, model), "local-scores")
    rare = local.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    met = rare.join(counts, "word")
    sums = met.groupBy("row").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("rare_counted"))
    all_ = local.drop("rare", "times").join(sums, "row", "left")
    counted = F.col("counted") + F.coalesce("rare_counted", F.lit(0.0))
    base = counted - F.col("n_tokens") * F.lit(float(np.log10(model.tokens + model.distinct + 1)))
    score = counted + F.col("model") if model.tokens else base
    return all_.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"))
