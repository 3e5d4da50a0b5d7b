"""Token ids as ORC files: sorted by document, indexed and pruned by metadata.

Documents are range-partitioned by id and sorted, encoded in the same stage, and
written as ORC.  ORC keeps integers in run-length encoding (version 2), writes a
row index with minimum and maximum every ``INDEX_ROWS`` rows, and Bloom filters
on ``doc_id``, so a look-up reads only stripes and row groups that can hold the
id, and stripes are read in parallel.  The shard number is a column too: a
document's place is the tokens of all shards before it plus those before it in
its shard, both summed from the files.

Encoding: with the byte-level pre-tokenizer ``encode`` of a text is the
concatenation of the encodings of its pieces cut before every space that a non-space
follows, because it always breaks there.  The pieces of a block are dictionary-encoded
in Arrow, each different one is encoded once and the ids are gathered.  A worker
keeps the ids of pieces it has met (bounded by ``CACHE_PIECES``).  The tokenizer's
file is looked at first: with any other normaliser, pre-tokenizer, model or added
token than these allow, whole texts go through the library's ``encode``.

Null texts are empty and hold the end id alone.  Null ids come first.  Repeated
rows and ids are all kept; among equal ids the order is by text.  An empty table
gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from watchledger.llm.common import blocks, record, written
from watchledger.workspace import new_path

END_ID = 2
INDEX_ROWS = 1_000
STRIPE_BYTES = 16 << 20
CACHE_PIECES = 250_000
#: A space that does not lead a piece, the places before those that do, and the pre-tokenizer's parts.
_ODD_SPACE = re.compile(r" (?=\s|\Z)")
_ODD_SPACE_RE2 = r" ([\s\x0b\x1c-\x1f\x85\p{Z}]|\z)"
_CUT = re.compile(r"(?<!\A)(?= \S)")
_FOREIGN = re.compile("[^\x00-\u024f]")
_LAST_PLAIN = "\u024f"
_MARKS = frozenset(".,;:!?")
_PART = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same for ASCII, where the standard library's faster classes say the same.
_ASCII_PART = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, int]:
    """The vocabulary's letter for each byte that is not printable Latin-1: they follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in plain)}


class _Filled(dict):
    """A dictionary that computes what it lacks and keeps what was asked for lately: at most twice ``limit`` entries."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        self[key] = value = self.make(key) if value is None else value
        return value


def cuts_at_spaces(path: str) -> bool:
    """Whether the tokenizer of the file encodes a text as its pieces one by one: byte-level BPE, nothing before or beside it."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    pre, model = config.get("pre_tokenizer") or {}, config.get("model") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True) and pre.get("use_regex", True) and config.get("normalizer") is None
    unusual = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    added = [t for t in config.get("added_tokens") or [] if not t["content"].startswith("<|") or t.get("lstrip") or t.get("rstrip")]
    return bool(plain and model.get("type") == "BPE" and not any(model.get(k) for k in unusual) and not added and not config.get("truncation") and not config.get("padding"))


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    Pieces of plain Latin text are cut by the pre-tokenizer's own pattern and each
    part goes to the library's BPE model; all other pieces go through ``encode``.
    """

    def __init__(self, path: str, cache: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread, and one memory arena, per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_piece = cuts_at_spaces(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.as_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        letters = byte_letters()
        self.letter = "".join(chr(letters.get(b, b)) for b in range(256))
        self.space = self.letter[0x20]
        self.parts = _Filled(self.part, cache)
        self.spaced = _Filled(self.word, cache)
        self.first = _Filled(self.piece, cache // 10)

    def part(self, part: str) -> bytes:
        mapped = codecs.charmap_decode(part.encode(), "strict", self.letter)[0]
        return b"".join([self.as_bytes[t.id] for t in self.tokenize(mapped)])

    def word(self, word: str) -> bytes:
        """The piece of a space and ``word``."""
        if word.isalpha():  # one part for the pre-tokenizer
            if word.isascii():
                return b"".join([self.as_bytes[t.id] for t in self.tokenize(self.space + word)])
            if max(word) <= _LAST_PLAIN:
                return self.part(" " + word)
        elif word[-1:] in _MARKS and word[:-1].isalpha() and max(word) <= _LAST_PLAIN:
            return self.spaced[word[:-1]] + self.parts[word[-1]]
        return self.piece(" " + word)

    def piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        if piece.isascii() and "<|" not in piece:
            return b"".join(map(self.parts.__getitem__, _ASCII_PART.findall(piece)))
        if "<|" in piece or _FOREIGN.search(piece):
            return np.asarray(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.parts.__getitem__, _PART.findall(piece)))

    def __call__(self, text: str) -> bytes:
        if not self.by_piece:
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if _ODD_SPACE.search(text):
            head, *rest = _CUT.split(text)
            if head[:1] == " " and head[1:2].strip():
                head, rest = "", [head, *rest]
            rest = [p[1:] for p in rest]
        else:
            head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.spaced.__getitem__, rest))


    def lists(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every text (null is empty), each followed by ``END_ID``."""
        texts = pa.compute.fill_null(texts, "")
        if self.by_piece:
            odd = np.flatnonzero(pa.compute.match_substring_regex(texts, _ODD_SPACE_RE2).to_numpy(zero_copy_only=False))
        else:
            odd = np.arange(len(texts))
        whole = np.zeros(len(texts), bool)
        whole[odd] = True
        # The texts that are encoded whole have no pieces here.
        parts = pa.compute.split_pattern(pa.compute.if_else(pa.array(whole), "", texts), " ")
        bounds = parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()
        pieces = parts.values.slice(parts.offsets[0].as_py(), bounds[-1]).dictionary_encode()
        different = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist
        codes = pieces.indices.to_numpy().astype(np.int64)
        heads = bounds[:-1]
        leading = [self(t) if w else self.first[different[c]] for t, w, c in zip(texts.to_pylist() if len(odd) else [""] * len(texts), whole.tolist(), codes[heads].tolist())]
        used = np.ones(len(codes), bool)
        used[heads] = False
        needed = np.zeros(len(different), bool)
        needed[codes[used]] = True
        known = self.spaced
        encoded = [known[w] if n else b"" for w, n in zip(different, needed.tolist())]
        # Code numbers: the pieces, the leading parts of the texts, the end.
        end = len(encoded) + len(leading)
        codes[heads] = len(encoded) + np.arange(len(leading))
        codes = np.insert(codes, bounds[1:], end)
        encoded = [*encoded, *leading, END_ID.to_bytes(4, "little")]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        starts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(encoded), "<i4")
        length = sizes[codes]
        upto = np.cumsum(length)
        gathered = ids[np.arange(upto[-1] if len(upto) else 0) + np.repeat(starts[codes] - (upto - length), length)]
        ends = np.concatenate([[0], upto])[np.concatenate([[0], bounds[1:] + np.arange(1, len(bounds))])]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(gathered, pa.int32()))


_KEPT: dict[str, Encoder] = {}


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: the next task of the worker finds the pieces of the last."""
    import builtins

    kept = builtins.__dict__.setdefault("_corpus_encoders", _KEPT)  # functions travel by value, so a module of theirs ends with the task
    if path not in kept:
        kept.clear()
        kept[path] = Encoder(path)
    return kept[path]


_TOKENS = pa.schema([("doc_id", pa.int64()), ("place", pa.int32()), ("ids", pa.list_(pa.int32()))])


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, place (row of the partition) and ids, keeping the rows' order."""
    def run(batches):
        encoder, place = worker_encoder(path), 0
        for b in blocks(batches, limit=4 << 20):
            n = b.num_rows
            yield record(_TOKENS, {"doc_id": b.column("doc_id"), "place": np.arange(place, place + n, dtype=np.int32), "ids": encoder.lists(b.column("text"))})
            place += n

    return docs.mapInArrow(run, "doc_id long, place int, ids array<int>")


def write_tokens(docs: DataFrame, out: str, path: str | None = None) -> None:
    """Write the token files of all documents below ``out``, in ascending doc_id order."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Rows of one id, and even repeated rows, are dealt over several ranges.
    ranges = texts.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("doc_id", F.substring("text", 1, 64), "row")
    ordered = ranges.sortWithinPartitions("doc_id", "text").select("doc_id", "text")
    rows = encoded(ordered, path or tokenizer_file()).withColumn("shard", F.spark_partition_id())
    options = {
        "compression": "zstd", "orc.stripe.size": str(STRIPE_BYTES), "orc.create.index": "true", "orc.row.index.stride": str(INDEX_ROWS),
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}
    rows.write.options(**options).orc(out)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, place int, ids array<int>, shard int").orc(path)


_SUMS = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("place", pa.int32()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def token_report(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the files."""

    def sums(batches):
        for b in batches:
            ids = b.column("ids")
            flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:z]) for a, z in zip(ends[:-1], ends[1:])]
            yield record(_SUMS, {"doc_id": b.column("doc_id"), "shard": b.column("shard"), "place": b.column("place"), "n_tokens": np.diff(ends).astype(np.int64), "ids_crc32": crc})

    # Written, so that the files are read once: both the shards' sums and the documents come from these rows.
    rows = written(tokens.mapInArrow(sums, "doc_id long, shard int, place int, n_tokens long, ids_crc32 long"), "token-sums")
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("_tokens"))  # one row per file
    before = F.sum("_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = shards.select("shard", F.coalesce(before, F.lit(0)).alias("_before"))
    here = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn("_upto", here).join(offsets, "shard")
    return placed.select("doc_id", (F.col("_before") + F.col("_upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")


def tokens_written(docs: DataFrame) -> DataFrame:
    """Write the files, read them back, and report every document from them."""
    out = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, out)
    return token_report(read_tokens(docs.sparkSession, out))
