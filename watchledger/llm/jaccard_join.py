"""N-gram Jaccard join with grouped prefixes, and its components.

A document's set holds its distinct ``SHINGLE``-word shingles (lower-cased A-Z);
with fewer words the whole sequence is the one element, without words it is
empty and links with nothing.  Two documents link when 100 * intersection >=
``PERCENT`` * union.  Elements are 64-bit hashes.

1. *Order.*  Each task counts the elements it holds twice or more;
   the counts are summed over ``SLOTS`` hash slots into a table of levels (log2)
   of fixed size.  The order of elements is (level of slot, hash): common
   passages come last.  Any order gives the same links; this one keeps lists short.
2. *Groups.*  Linked sets share an element among their first
   n - ceil(0.75 n) + 1.  Documents with one set are one class; classes with the
   same size and prefix are one group, and only groups enter the inverted lists.
   The lists of common elements are split by a hash (salt).  A list stays if it
   has two classes or more, be they of one group.
3. *Hubs.*  In each list every group is paired with the smallest one, in each
   group every class with the first one.  Pairs pass a size filter and bitmap
   bounds on the symmetric difference, then their sets are intersected.  The
   components of these links put most copies together without pairing them all.
4. *Rounds.*  Lists that still hold several components are expanded to classes.  In
   each of ``ROUNDS`` every such list draws another hub, and classes of other
   components are paired with it: most of a large group of near copies comes together
   for as many pairs as it has entries, not for the square.
5. *Rest.*  In lists that are open even then all pairs across components are filtered
   in the same way.  A few pairs for each two components are verified first, then
   every pair that still lies across, so no link between different texts is lost;
   links inside a component change nothing.

To be compared, sets travel once, to the class that they are compared with; a class
met by many is repeated for parts of them.  Sketches, bitmaps that grow with the set
but have a tenth of its bytes, travel first; only pairs that they let through are
compared by sets.

Lists are formed slice by slice of the tokens, and tables and shuffle files that have been
read for the last time are removed, so the disk holds one slice's entries at a time.

Null texts are empty.  A component is named by its smallest doc_id (null ids do
not count unless there is no other).  Repeated rows fall into one class; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from watchledger.llm.common import CHUNK, blocks, discard, gather, id_filter, passes, record, without_losers, written
from watchledger.llm.components import components

SHINGLE = 5
PERCENT = 75
#: Slots of the level table: its size in bytes, whatever the corpus.
SLOTS = 1 << 21
#: Bytes of text whose sets a task makes together; they and the batch they leave in take a dozen times as much.
SET_BYTES = 1 << 20
#: Elements that a task counts together, at least; it holds little more.
COUNTED = 2_000_000
#: Lists of elements above this level (log2 of the count) are split.
HOT_LEVEL = 9
BITMAP_WORDS = 8
#: Sets of ``WIDE_FROM`` elements or more have a second bitmap of so many words.
WIDE_WORDS, WIDE_FROM = 64, 512
#: Pairs of two components that are verified before all others, round by round; they change speed, never links.
FEW = (1, 16)
#: Lists that a pair's earlier meeting is looked for in.
EARLIER = 8
#: Bits of a sketch for each element, at least.
SKETCH_BITS = 4
#: Rounds in which every list that is still open has another hub; they change speed, never links.
ROUNDS = 2
#: Sets that one task compares with the same set.
COMPARED = 1000
#: Parts of the hash range whose lists are formed one after the other; the shuffle of one is gone before the next. A power of two.
SLICES = 4
_LEVEL_BITS = 6
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Distinct shingle hashes of every text (null is empty), sorted; every different word of the block is hashed once."""
    lowered = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    split = pc.ascii_split_whitespace(lowered)
    bounds = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
    words = split.values.slice(split.offsets[0].as_py(), bounds[-1]).dictionary_encode()
    different = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, different), np.uint64, len(different))[words.indices.to_numpy()]
    out = h[: max(0, len(h) - size + 1)].copy()
    for i in range(1, size):
        out *= _MULTIPLIER
        out += h[i : i + len(out)]
    out ^= out >> np.uint64(29)
    out *= _MULTIPLIER
    out ^= out >> np.uint64(32)

    def of(i: int, start: int, end: int) -> np.ndarray:
        if end - start >= size:
            s = np.sort(out[start : end - size + 1])
            return s[np.concatenate([[True], s[1:] != s[:-1]])]
        alone = lowered[i].as_py().encode().split()
        return np.asarray([xxhash.xxh3_64_intdigest(b" ".join(alone), seed=len(alone))] if alone else [], np.uint64)

    return [of(i, *x) for i, x in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()))]


def prefix_length(n: int) -> int:
    return n - (PERCENT * n + 99) // 100 + 1


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def level_table(docs: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """log2 of how often the elements of a slot occur beside others of their kind; ``slots`` bytes."""

    def count(batches):
        sets = []

        def often():
            values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
            values, counts = values[counts > 1], counts[counts > 1]
            slot, where = np.unique(values & np.uint64(slots - 1), return_inverse=True)
            n = np.bincount(where, weights=counts, minlength=len(slot)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(n)], names=["slot", "n"])

        for b in blocks(batches, limit=SET_BYTES):
            sets += shingle_sets(b.column("text"))
            if sum(map(len, sets)) > COUNTED:
                yield often()
                sets.clear()
        yield often()

    def pack(table: pa.Table) -> pa.Table:
        data = np.zeros(CHUNK, np.uint8)
        data[table.column("slot").to_numpy() % CHUNK] = np.log2(table.column("n").to_numpy()).astype(np.uint8)
        return pa.table({"chunk": [table.column("chunk")[0].as_py()], "data": [data.tobytes()]})

    sums = _texts(docs).select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    chunks = sums.withColumn("chunk", F.floor(F.col("slot") / CHUNK)).groupBy("chunk").applyInArrow(pack, "chunk long, data binary")
    return np.minimum(gather(chunks, slots), (1 << _LEVEL_BITS) - 1)


def bitmap(elements: np.ndarray, words: int = BITMAP_WORDS) -> np.ndarray:
    """Parities of the elements per bit: two sets differ in at least as many elements as bits."""
    bits = words * 64
    odd = np.bincount((elements >> np.uint64(40)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch(elements: np.ndarray) -> bytes:
    """A bitmap that grows with the set, four bits or more an element; halves laid on each other are the next smaller one."""
    return bitmap(elements, max(BITMAP_WORDS, 1 << max(0, (len(elements) * SKETCH_BITS - 1).bit_length() - 6))).tobytes()


def bits_apart(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ once the longer is folded: no more than elements in which the sets do."""
    short, long = sorted((x, y), key=len)
    folded = np.bitwise_xor.reduce(np.frombuffer(long, np.uint64).reshape(-1, len(short) // 8), axis=0)
    return int(np.bitwise_count(folded ^ np.frombuffer(short, np.uint64)).sum())


_SETS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("set_id", pa.binary()), ("prefix_id", pa.binary()),
                   ("bits", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))])


def set_table(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """doc_id, row, n, set_id, prefix_id, bits, wide and prefix of each document of ``docs`` (doc_id, row, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        table = shared.value
        mask = np.uint64(len(table) - 1)
        for b in blocks(batches, limit=SET_BYTES):
            rows = []
            for s in shingle_sets(b.column("text")):
                n = len(s)
                level = table[(s & mask).astype(np.int64)]
                first = np.lexsort((s, level))[: prefix_length(n)] if n else np.zeros(0, np.int64)
                tokens = ((s[first] << np.uint64(_LEVEL_BITS)) | level[first].astype(np.uint64)).view(np.int64)
                wide = bitmap(s, WIDE_WORDS) if n >= WIDE_FROM else s[:0].view(np.int64)
                rows.append((n, xxhash.xxh3_128_digest(s.tobytes()), xxhash.xxh3_128_digest(tokens.tobytes()), bitmap(s), wide, tokens))
            columns = dict(zip(_SETS.names[2:], zip(*rows))) if rows else {k: [] for k in _SETS.names[2:]}
            yield record(_SETS, {"doc_id": b.column("doc_id"), "row": b.column("row"), **columns})

    schema = "doc_id long, row long, n long, set_id binary, prefix_id binary, bits array<long>, wide array<long>, prefix array<long>"
    return docs.select(F.col("doc_id").cast("long"), "row", F.col("text").cast("string")).mapInArrow(run, schema)


_FETCHED = pa.schema([("set_id", pa.binary()), ("size", pa.int64()), ("sketch", pa.binary()), ("elements", pa.list_(pa.int64()))])


def _fetch_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_id, size, sketch and elements of the ``wanted`` classes (doc_id), from the texts; a class may come twice, and a few others come along."""
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(wanted))

    def run(batches):
        for b in blocks(batches, limit=SET_BYTES):
            held = b.filter(pa.array(passes(shared.value, b.column("doc_id"))))
            sets = shingle_sets(held.column("text"))
            yield record(_FETCHED, {
                "set_id": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "size": [len(s) for s in sets], "sketch": [sketch(s) for s in sets], "elements": [s.view(np.int64) for s in sets]})

    return _texts(docs).mapInArrow(run, "set_id binary, size long, sketch binary, elements array<long>")


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of class ids that size and bitmaps let through."""
    side = lambda x: classes.select(F.col("row").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"), F.col("wide").alias(f"wide_{x}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    return near.where(_may_link("n_a", "n_b", "bits_a", "bits_b", "wide_a", "wide_b")).drop("n_a", "n_b", "bits_a", "bits_b", "wide_a", "wide_b")


def _pairs(found: tuple[list, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["a", "b"])


def _compare(batches):
    """Links among rows sorted so that the set that others are compared with (``first``) comes before them."""
    home = None
    for batch in batches:
        found: tuple[list, list] = ([], [])
        elements = batch.column("elements")
        offsets, values = elements.offsets.to_numpy(), elements.values.to_numpy().view(np.uint64)
        for i, (row, at, first) in enumerate(zip(batch.column("row").to_pylist(), batch.column("home").to_pylist(), batch.column("first").to_pylist())):
            x = values[offsets[i] : offsets[i + 1]]
            if first:
                home = x.copy()
                continue
            shared = np.intersect1d(home, x, assume_unique=True).size
            if 100 * shared >= PERCENT * (len(home) + len(x) - shared):
                found[0].append(row)
                found[1].append(at)
        yield _pairs(found)


def _compare_sketches(batches):
    """Pairs whose sketches differ in no more bits than linked sets in elements; rows are sorted as in ``_compare``."""
    home = size = None
    for batch in batches:
        found: tuple[list, list] = ([], [])
        for row, at, first, n, x in zip(*(batch.column(c).to_pylist() for c in ("row", "home", "first", "size", "sketch"))):
            if first:
                home, size = x, n
            elif bits_apart(home, x) * (100 + PERCENT) <= (100 - PERCENT) * (size + n):
                found[0].append(row)
                found[1].append(at)
        yield _pairs(found)


def _met(near: DataFrame, wanted: DataFrame, sets: DataFrame, compare) -> DataFrame:
    """The pairs (a, b) of ``near`` that ``compare`` keeps: rows of ``sets`` (set_id and further columns) travel to the set they are compared with."""
    met = near.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / COMPARED).cast("int").alias("parts"))
    met = written(met, "met")
    members = near.select("a", "b").join(met, "b").select(F.col("a").alias("row"), F.col("b").alias("home"), F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("first"))
    homes = met.select(F.col("b").alias("row"), F.col("b").alias("home"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("first"))
    roles = written(members.unionAll(homes).join(wanted.select("row", "set_id"), "row"), "roles")
    dealt = sets.join(roles, "set_id").select("row", "home", "part", "first", *sets.columns[1:]).repartition("home", "part").sortWithinPartitions("home", "part", F.desc("first"))
    links = written(dealt.drop("part").mapInArrow(compare, "a long, b long").distinct(), "links")
    discard(met, roles)
    return links


def _alike(near: DataFrame, wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``near`` that the sketches let through."""
    return _met(near, wanted, sets.select("set_id", "size", "sketch"), _compare_sketches)


def _compared(near: DataFrame, wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``near`` that are links, by the ``sets`` (set_id, elements) of both."""
    return _met(near, wanted, sets.select("set_id", "elements"), _compare)


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of class ids that are links, by sets fetched from the texts; the written ``pairs`` are gone afterwards."""
    near = written(_near(pairs, classes), "near")
    discard(pairs)
    if near.isEmpty():
        return near.select("a", "b")
    wanted = _wanted(near, classes)
    sets = written(_fetch_sets(docs, wanted), "sets")
    alike = _alike(near, wanted, sets)
    links = _compared(alike, wanted, sets)
    discard(near, wanted, sets, alike)
    return links


def _wanted(near: DataFrame, classes: DataFrame) -> DataFrame:
    """row, set_id and doc_id of the classes of the pairs (a, b)."""
    ids = near.select(F.col("a").alias("row")).unionAll(near.select(F.col("b").alias("row"))).distinct()
    return written(classes.join(ids, "row", "left_semi").select("row", "set_id", "doc_id"), "wanted")


def _may_link(n_a: str, n_b: str, bits_a: str, bits_b: str, wide_a: str, wide_b: str):
    """Size filter, and: |A ^ B| <= (100 - p) / (100 + p) * (|A| + |B|) for linked sets, and bitmaps differ in no more bits than that."""
    apart = sum((F.bit_count(F.get(bits_a, F.lit(i)).bitwiseXOR(F.get(bits_b, F.lit(i)))) for i in range(BITMAP_WORDS)), F.lit(0))
    wide = F.aggregate(F.zip_with(wide_a, wide_b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    within = lambda x: x * (100 + PERCENT) <= (100 - PERCENT) * (F.col(n_a) + F.col(n_b))
    either = (F.size(wide_a) == 0) | (F.size(wide_b) == 0)
    return _sizes_fit(n_a, n_b) & within(apart) & (either | within(wide))


def _sizes_fit(x: str, y: str):
    return 100 * F.least(x, y) >= PERCENT * F.greatest(x, y)


def class_components(sets: DataFrame, docs: DataFrame, hot_level: int = HOT_LEVEL) -> tuple[DataFrame, DataFrame]:
    """Classes (row, doc_id, n, set_id, ...) of a written set table, and (node, root) of those that have links."""
    full = sets.where("n > 0")
    classes = full.groupBy("n", "set_id").agg(F.min(F.struct("row", "doc_id", "prefix_id", "bits", "wide")).alias("r")).select("n", "set_id", "r.*")
    classes = written(classes, "classes")
    groups = classes.groupBy("n", "prefix_id").agg(F.min("row").alias("group"), F.count(F.lit(1)).alias("held"))
    member = written(classes.join(groups, ["n", "prefix_id"]).select("row", "group", "n", "held"), "members")
    slices = [written(_lists(full, member, k, hot_level), "lists") for k in range(SLICES)]
    shared = reduce(DataFrame.unionAll, slices)
    to_hub = shared.where("group != hub.group").where(_sizes_fit("n", "hub.n")).select(F.col("group").alias("a"), F.col("hub.group").alias("b"))
    to_head = member.where("row != group").select(F.col("row").alias("a"), F.col("group").alias("b"))
    first = _verified(written(to_hub.distinct().unionAll(to_head), "pairs"), classes, docs)
    found = written(components(first), "components")

    # What is left: lists with several components.  Each round pairs their classes with another hub.
    labelled = member.join(found, member["row"] == found["node"], "left").select("row", "group", "n", F.coalesce("root", "row").alias("root"))
    labelled = written(labelled, "labelled")
    discard(member, first, found)
    labels = labelled.select("row", "root")
    entries = shared.select("token", "group").join(labelled, "group").select("token", "row", "n", "root")
    for seed in range(ROUNDS):
        open_lists = written(_open_lists(entries, seed), "open")
        to_hub = open_lists.where("root != hub.root").where(_sizes_fit("n", "hub.n")).select(F.col("row").alias("a"), F.col("hub.row").alias("b"))
        discard(*slices)  # each round reads the lists of the one before
        slices = [open_lists]
        labels = _merged(labels, _verified(written(to_hub.distinct(), "pairs"), classes, docs))
        entries = open_lists.select("token", "row", "n").join(labels, "row").select("token", "row", "n", "root")
    rest = _open_lists(entries, ROUNDS).drop("hub")
    rest = rest.withColumn("before", F.collect_list("token").over(Window.partitionBy("row").orderBy("token").rowsBetween(-EARLIER, -1)))
    rest = written(rest.join(classes.select("row", "bits", "wide"), "row"), "rest")
    discard(*slices)
    # The filters are part of the join's condition: a pair that fails them is never a row.
    # A pair that shares one of the lists shortly before this one has met there.
    across = (F.col("x.row") < F.col("y.row")) & (F.col("x.root") != F.col("y.root")) & _may_link(*(f"{side}.{c}" for c in ("n", "bits", "wide") for side in "xy"))
    across = across & ~F.arrays_overlap("x.before", "y.before")
    pairs = rest.alias("x").join(rest.alias("y"), (F.col("x.token") == F.col("y.token")) & across)  # one side's exchange serves both
    near = written(pairs.select(F.col("x.row").alias("a"), F.col("y.row").alias("b")).distinct(), "near")
    discard(rest)
    if near.isEmpty():
        return classes, labels
    wanted = _wanted(near, classes)
    sets = written(_fetch_sets(docs, wanted), "sets")
    near = _alike(near, wanted, sets)
    # A few pairs for each two components first: most of the others then lie inside one.
    for few in (*FEW, None):
        tried = near = written(_across(near, labels), "across")
        if few:
            place = F.row_number().over(Window.partitionBy(F.least("root_a", "root_b"), F.greatest("root_a", "root_b")).orderBy(F.xxhash64("a", "b"), "a", "b"))
            tried = tried.withColumn("place", place).where(F.col("place") <= few)
        labels = _merged(labels, _compared(written(tried.select("a", "b"), "tried"), wanted, sets))
        near = near.select("a", "b")
    discard(wanted, sets)
    return classes, labels


def _lists(sets: DataFrame, member: DataFrame, k: int, hot_level: int) -> DataFrame:
    """token, group, n and hub of the lists with two classes or more in one slice of the tokens."""
    sliced = F.filter("prefix", lambda x: x.bitwiseAND((SLICES - 1) << _LEVEL_BITS) == k << _LEVEL_BITS)
    heads = sets.select("row", sliced.alias("prefix")).join(member.where("row = group").select("row", "n", "held"), "row")
    lists = heads.select(F.col("row").alias("group"), "n", "held", F.explode("prefix").alias("token"))
    level = F.col("token").bitwiseAND((1 << _LEVEL_BITS) - 1)
    parts = F.pow(F.lit(2.0), F.least(F.greatest(level - hot_level, F.lit(0)), F.lit(40))).cast("long")
    near = Window.partitionBy("token", "salt")
    hubs = lists.withColumn("salt", F.pmod(F.xxhash64("group", "token"), parts))
    hubs = hubs.withColumn("hub", F.min(F.struct("n", "group")).over(near)).withColumn("length", F.sum("held").over(near))
    # A list counts the classes of its groups: classes of one group meet here as well.
    return hubs.where((F.col("length") > 1) | (parts > 1)).select("token", "group", "n", "hub")


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components, with their roots."""
    of = lambda x: labels.select(F.col("row").alias(x), F.col("root").alias(f"root_{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where("root_a != root_b")


def _open_lists(by_token: DataFrame, seed: int) -> DataFrame:
    """The lists (token, row, n, root) that hold several components, each with a ``hub`` that ``seed`` draws; of those with the same members one stays."""
    mark = lambda x: F.bit_xor(F.xxhash64("row", F.lit(x)))
    hub = F.min(F.struct(F.xxhash64("row", F.lit(seed)).alias("drawn"), "row", "n", "root"))
    lists = by_token.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("length"), mark(1).alias("m1"), mark(2).alias("m2"), hub.alias("hub"))
    kept = lists.where("lo < hi").groupBy("length", "m1", "m2").agg(F.min(F.struct("token", "hub")).alias("kept")).select("kept.*")
    return by_token.join(kept, "token")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(row, root) with the components that ``links`` (a, b) bridge made one; written ``labels`` and ``links`` are gone afterwards."""
    bridged = _across(links, labels).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    roots = written(components(bridged), "components").withColumnRenamed("root", "to")
    merged = written(labels.join(roots, labels["root"] == roots["node"], "left").select("row", F.coalesce("to", "root").alias("root")), "labels")
    discard(labels, links)
    return merged


def near_components(docs: DataFrame) -> DataFrame:
    """row, doc_id, set_id, n, root of each document of ``docs`` (doc_id, row, text), written; the root is null for empty sets."""
    sets = written(set_table(docs, level_table(docs)), "sets")
    classes, roots = class_components(sets, docs)
    by_class = classes.select("set_id", "n", "row").join(roots, "row").select("set_id", "n", "root")
    found = written(sets.select("row", "doc_id", "n", "set_id").join(by_class, ["set_id", "n"], "left").select("row", "doc_id", "set_id", "n", "root"), "near-components")
    discard(sets, classes, roots)
    return found


def jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    numbered = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    found = near_components(numbered)
    names = found.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("size"))
    shared = names.where("size > 1").drop("size")
    return found.join(shared, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that follow another row of their component; the smallest doc_id stays.

    Rows that repeat its id and set are one document; one of them stays.
    """
    found = near_components(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text"))
    stays = found.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("size"))
    mine = found.join(stays.where("size > 1").select("root", F.col("first.row").alias("stay")), "root")
    fates = mine.groupBy("doc_id", "set_id").agg(F.max(F.col("row") == F.col("stay")).alias("stays"), F.count(F.lit(1)).alias("rows"))
    fates = written(fates.where("rows > 1 or not stays").select(F.col("doc_id").alias("_id"), F.col("set_id").alias("_key"), "stays"), "fates")
    discard(found)
    return without_losers(docs, fates, _with_set_id)


def _with_set_id(packed: DataFrame) -> DataFrame:
    """id, set_id as key, and document (the whole row)."""

    def run(batches):
        for b in batches:
            for block in blocks([b.append_column("text", b.column("document").field("text").cast(pa.string()))], limit=SET_BYTES):
                found = [xxhash.xxh3_128_digest(s.tobytes()) for s in shingle_sets(block.column("text"))]
                yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(found, pa.binary()), block.column("document")], names=["id", "key", "document"])

    return packed.mapInArrow(run, StructType([StructField("id", LongType()), StructField("key", BinaryType()), packed.schema["document"]]))
