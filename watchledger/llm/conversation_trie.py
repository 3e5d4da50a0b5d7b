"""Prefix trie of conversations from ternary search trees.

1. Turns are numbered within their conversation over range slices and encoded by a
   dictionary of the distinct turns.  Each conversation becomes an array of turn
   ids, cut into segments of ``SEGMENT`` turns; a segment knows what is before it by
   ``prefix``, sums of SHA-256 limbs of the earlier segments.  A conversation whose
   length is a multiple of ``SEGMENT`` ends in an empty segment.
2. Equal segments with equal prefix are one sequence with a count and the least
   conversation.  Sequences are range-sharded in lexicographic order.
3. A task reads its sequences in blocks of ``BLOCK_TURNS`` turns and builds a
   ternary search tree of each block.  Sequences enter median first, so that the
   siblings of a node stand balanced.  One iterative traversal adds up members,
   leaves and savings.
4. A node that may lie in several blocks lies on the path of a block's first or
   last sequence.  These boundary nodes carry a chained hash of their path as key.
   What lies below them inside a block is already summed; they are merged by key,
   and their own leaves and savings are passed up along the block paths by one
   window and one more sum.  No step depends on the depth of the trie.
5. Segments after the first form bands, worked on from the last to the first: the
   root of a band's group hands its sums, and the conversations that end there, to
   the node of the band above.

The list of the conversations that end at a node is hashed as it streams by in
order, never held.

Rows without a conversation belong to none.  Null role and text are empty.  Turns
are in the order of ``turn``, null first, ties by the turn's digest; repeated rows
are turns of their own.  A conversation without turns is a member of the root only;
without conversations there is no node.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.llm.common import WORD, row_numbers, written
from watchledger.operators.ordering import running_total

#: Turns of one segment; a task holds a few of them at a time.
SEGMENT = 65_536
#: Turns of the sequences that one tree is built from.
BLOCK_TURNS = 1_000_000
NO_ENDS = sha256(b"").hexdigest()
_NODES = "block long, path int, key binary, parent_key binary, depth long, first long, parent_first long, n long, children long, leaves long, saved long, words long, counted boolean, ends string"
_NODE_TYPES = pa.schema([
    ("block", pa.int64()), ("path", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), ("first", pa.int64()), ("parent_first", pa.int64()),
    ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("words", pa.int64()), ("counted", pa.bool_()), ("ends", pa.string())])


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), token (number of the distinct turn) and words of every turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    known = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"))
    known = written(known, "turns")
    dictionary = known.groupBy("digest").agg(F.min("words").alias("words")).withColumn("token", F.monotonically_increasing_id())
    placed = running_total(known.drop("words"), ["turn", "digest", "row"], F.lit(1), by=["conv_id"], out="position")
    return placed.join(written(dictionary, "dictionary"), "digest").select("conv_id", "position", "token", "words")


def rebuilt(turns: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Each conversation with its first turns taken from the one before it whose id ``every`` divides.

    Returns turns (conv_id, position, token, words) and conversations (conv_id, length).
    How many turns are taken is crc32 of the id modulo ``heads``: at most ``heads - 1`` of the other conversation.
    """
    counts = written(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conversations")
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads))
    of = F.col("conv_id") - F.col("conv_id") % every
    givers = counts.select(F.col("conv_id").alias("giver"), F.col("n").alias("given"))
    plan = counts.withColumn("h", taken).withColumn("giver", of).join(givers, "giver", "left").withColumn("k", F.least("h", F.coalesce("given", F.lit(0))))
    plan = written(plan.select("conv_id", "giver", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "plan")
    first = turns.where((F.col("position") < heads) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "giver")
    taken_turns = plan.join(first, "giver").where("position <= k").select("conv_id", "position", "token", "words")
    own = turns.join(plan, "conv_id").where("position > h").select("conv_id", (F.col("position") - F.col("h") + F.col("k")).alias("position"), "token", "words")
    return taken_turns.unionAll(own), plan.select("conv_id", "length")


def _limbs(digest: Column) -> list[Column]:
    return [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]


def segments(turns: DataFrame, lengths: DataFrame, size: int = SEGMENT) -> DataFrame:
    """conv_id, band, prefix, next (prefix of the band after a full segment, else null), tokens, words."""
    item = F.sort_array(F.collect_list(F.struct("position", "token", "words")))
    cut = turns.groupBy("conv_id", F.floor((F.col("position") - 1) / size).cast("long").alias("band")).agg(item.alias("s"))
    cut = cut.select("conv_id", "band", F.transform("s", lambda x: x["token"]).alias("tokens"), F.transform("s", lambda x: x["words"]).alias("words"))
    none = F.array().cast("array<long>")
    empty = lengths.where(F.col("length") % size == 0).select("conv_id", (F.col("length") / size).cast("long").alias("band"), none.alias("tokens"), none.alias("words"))
    cut = written(cut.unionAll(empty), "segments")
    full = cut.where(F.size("tokens") == size)
    text = F.concat_ws(",", F.col("band").cast("string"), F.transform("tokens", lambda x: x.cast("string")))
    upto = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    sums = full.select("conv_id", "band", *[x.alias(f"p{i}") for i, x in enumerate(_limbs(F.sha2(text, 256)))])
    after = sums.select("conv_id", "band", F.concat_ws("-", *[F.sum(f"p{i}").over(upto).cast("string") for i in range(4)]).alias("next"))
    after = written(after, "prefixes")  # empty unless a conversation is longer than a segment
    before = after.select("conv_id", (F.col("band") + 1).alias("band"), F.col("next").alias("prefix"))
    return cut.join(after, ["conv_id", "band"], "left").join(before, ["conv_id", "band"], "left").withColumn("prefix", F.coalesce("prefix", F.lit("")))


def _hashed_lists(batches) -> Iterator[pa.RecordBatch]:
    """(sequence, digest of its conversations) from rows sorted by both."""
    names = ["seq", "ends"]
    current, digest = None, None
    for batch in batches:
        done: tuple[list, list] = ([], [])
        for seq, conv_id in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()):
            if seq != current:
                if digest is not None:
                    done[0].append(current)
                    done[1].append(digest.hexdigest())
                current, digest = seq, sha256(b"%d" % conv_id)
            else:
                digest.update(b",%d" % conv_id)
        yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], names)
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names)


def sequences(cut: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Distinct segments with n (members), first (the least conversation) and ends (digest of the conversations that end there)."""
    seq = F.unhex(F.sha2(F.concat_ws("|", F.col("band").cast("string"), "prefix", F.array_join(F.col("tokens").cast("array<string>"), ",")), 256))
    cut = written(cut.withColumn("seq", seq), "sequences")
    ending = cut.where(F.size("tokens") < size).select("seq", "conv_id").repartition("seq").sortWithinPartitions("seq", "conv_id")
    ends = ending.mapInArrow(_hashed_lists, "seq binary, ends string")
    distinct = cut.groupBy("seq", "band", "prefix", "next", "tokens", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"))
    return written(distinct.join(ends, "seq", "left").drop("seq"), "distinct")


class TernaryTree:
    """Ternary search tree of number sequences: ``low`` and ``high`` lead to siblings, ``equal`` to the first child."""

    def __init__(self):
        self.token, self.words, self.parent, self.sequence = [-1], [0], [0], [-1]
        self.low, self.equal, self.high = [0], [0], [0]

    def _new(self, token: int, words: int, parent: int) -> int:
        for column, value in ((self.token, token), (self.words, words), (self.parent, parent), (self.sequence, -1), (self.low, 0), (self.equal, 0), (self.high, 0)):
            column.append(value)
        return len(self.token) - 1

    def insert(self, tokens: list[int], words: list[int], sequence: int) -> None:
        node, token = 0, self.token
        for x, w in zip(tokens, words):
            at = self.equal[node]
            if not at:
                at = self.equal[node] = self._new(x, w, node)
            while token[at] != x:
                side = self.low if x < token[at] else self.high
                if not side[at]:
                    side[at] = self._new(x, w, node)
                at = side[at]
            node = at
        self.sequence[node] = sequence

    def insert_sorted(self, tokens: list[list[int]], words: list[list[int]]) -> None:
        """Median first, then the medians of both halves."""
        ranges = [(0, len(tokens))]
        while ranges:
            a, b = ranges.pop()
            if a < b:
                middle = (a + b) // 2
                self.insert(tokens[middle], words[middle], middle)
                ranges += [(middle + 1, b), (a, middle)]

    def nodes(self) -> list[int]:
        """All nodes, parents before children."""
        order, waiting = [0], [self.equal[0]]
        while waiting:
            node = waiting.pop()
            if node:
                order.append(node)
                waiting += [self.high[node], self.equal[node], self.low[node]]
        return order

    def path(self, tokens: list[int]) -> list[int]:
        """The nodes from the root along a sequence that is in the tree."""
        found = [0]
        for x in tokens:
            at = self.equal[found[-1]]
            while self.token[at] != x:
                at = self.low[at] if x < self.token[at] else self.high[at]
            found.append(at)
        return found


def _root_key(prefix: str) -> Column:
    """The first key of ``_chained``."""
    return F.substring(F.unhex(F.sha2(prefix, 256)), 1, 16)


def _chained(prefix: str, tokens: list[int]) -> list[bytes]:
    """A key of every node on a path: a hash of the key before it and the turn."""
    keys = [sha256(prefix.encode()).digest()[:16]]
    for x in tokens:
        keys.append(blake2b(keys[-1] + x.to_bytes(8, "big"), digest_size=16).digest())
    return keys


def _tree_nodes(prefix: str, rows: list[dict], block: int) -> pa.RecordBatch:
    """The nodes of one block: finished ones (path -1), and those of its first and last path (0 and 1) to be merged."""
    tree = TernaryTree()
    tree.insert_sorted([r["tokens"] for r in rows], [r["words"] for r in rows])
    size = len(tree.token)
    key: dict[int, bytes] = {}
    paths = [tree.path(rows[0]["tokens"]), tree.path(rows[-1]["tokens"])] if len(rows) > 1 else [tree.path(rows[0]["tokens"])]
    for path, row in zip(paths, (rows[0], rows[-1])):
        key |= zip(path, _chained(prefix, row["tokens"]))
    n, children, leaves, saved = [0] * size, [0] * size, [0] * size, [0] * size
    first: list[int | None] = [None] * size
    depth, ends = [0] * size, [None] * size
    order = tree.nodes()
    for node in order[1:]:
        depth[node] = depth[tree.parent[node]] + 1
    for node in reversed(order):
        if (s := tree.sequence[node]) >= 0:
            row = rows[s]
            n[node] += row["n"]
            first[node] = row["first"] if first[node] is None else min(first[node], row["first"])
            children[node] += row["more_children"]
            leaves[node] += row["more_leaves"]
            saved[node] += row["more_saved"]
            ends[node] = row["ends"]
        if node not in key:
            leaves[node] = leaves[node] or 1
            saved[node] += (n[node] - 1) * tree.words[node]
        if node:
            up = tree.parent[node]
            n[up] += n[node]
            first[up] = first[node] if first[up] is None else min(first[up], first[node])
            children[up] += node not in key
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    out: list[list] = [[] for _ in _NODE_TYPES]

    def put(*values) -> None:
        for column, value in zip(out, values):
            column.append(value)

    for node in order:
        if node not in key:
            up = tree.parent[node]
            put(block, -1, None, key.get(up), depth[node], first[node], None if up in key else first[up], n[node], children[node], leaves[node], saved[node], tree.words[node], True, ends[node])
    seen: set[int] = set()
    for p, path in enumerate(paths):
        for node in path:
            up = key[tree.parent[node]] if node else None
            if node in seen:  # stands on the first path already: only receives from below
                put(block, p, key[node], up, depth[node], None, None, 0, 0, 0, 0, 0, False, None)
            else:
                put(block, p, key[node], up, depth[node], first[node], None, n[node], children[node], leaves[node], saved[node], tree.words[node], True, ends[node])
        seen.update(path)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _NODE_TYPES)], schema=_NODE_TYPES)


def _block_nodes(most: int):
    """Nodes of sorted sequences, one tree for each prefix and ``most`` turns."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        numbers, prefix, held, turns = row_numbers(), None, [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if held and (row["prefix"] != prefix or turns + len(row["tokens"]) > most):
                        yield _tree_nodes(prefix, held, next(numbers))
                        held, turns = [], 0
                    prefix = row["prefix"]
                    held.append(row)
                    turns += len(row["tokens"])
        if held:
            yield _tree_nodes(prefix, held, next(numbers))

    return run


def _band(rows: DataFrame, most: int) -> DataFrame:
    """All nodes of one band: key and prefix-free figures, parents by their least conversation; roots have depth 0."""
    sharded = rows.repartitionByRange("prefix", "tokens").sortWithinPartitions("prefix", "tokens")
    found = written(sharded.mapInArrow(_block_nodes(most), _NODES), "nodes")
    edge = found.where("path >= 0")
    total = lambda c: F.sum(c).alias(c)
    merged = edge.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("first").alias("first"), total("n"), total("children"), total("leaves"), total("saved"),
        F.max("words").alias("words"), F.max("ends").alias("ends"), F.min(F.when(F.col("counted"), F.col("block"))).alias("home"))
    merged = written(merged, "merged")
    kids = merged.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    merged = merged.join(kids, "key", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
    own = merged.select(
        "key", "home", F.when((F.col("kids") == 0) & (F.col("leaves") == 0), 1).otherwise(0).alias("leaf"), ((F.col("n") - 1) * F.col("words")).alias("saving"))
    mine = F.col("counted") & (F.col("block") == F.col("home"))
    below = Window.partitionBy("block", "path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    passed = edge.select("block", "path", "depth", "key", "counted").join(own, "key").select(
        "key", *[F.sum(F.when(mine, F.col(c)).otherwise(0)).over(below).alias(c) for c in ("leaf", "saving")])
    passed = passed.groupBy("key").agg(F.sum("leaf").alias("more_leaves"), F.sum("saving").alias("more_saved"))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("first").alias("parent"))
    edges = merged.join(passed, "key").join(parents, "parent_key", "left").select(
        "depth", "first", "parent", "n", (F.col("children") + F.col("kids")).alias("children"), (F.col("leaves") + F.col("more_leaves")).alias("leaves"),
        (F.col("saved") + F.col("more_saved")).alias("saved"), "ends", "key")
    inner = found.where("path < 0").join(parents, "parent_key", "left").select(
        "depth", "first", F.coalesce("parent_first", "parent").alias("parent"), "n", "children", "leaves", "saved", "ends", "key")
    return edges.unionAll(inner)


def prefix_trie(turns: DataFrame, lengths: DataFrame, segment: int = SEGMENT, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = sequences(segments(turns, lengths, segment), segment)
    top = rows.agg(F.max("band")).first()[0]
    trie, below = None, None
    for band in range(top or 0, -1, -1):
        more = {"more_children": "children", "more_leaves": "leaves", "more_saved": "saved"}
        columns = ["prefix", "tokens", "words", "n", "first", "ends", *more]
        level = rows.where(F.col("band") == band)
        whole = level.where("next is null").withColumns({c: F.lit(0).cast("long") for c in more}).select(*columns)
        if below is not None:
            whole = whole.unionAll(level.drop("ends").join(below, "next").select(*columns))
        nodes = _band(whole, block_turns)
        if band:
            nodes = written(nodes, "band")
            groups = level.select(F.col("prefix").alias("next")).distinct().withColumn("key", _root_key("next"))
            roots = nodes.where("depth = 0").join(groups, "key")
            below = written(roots.select("next", "ends", *[F.col(c).alias(m) for m, c in more.items()]), "roots")
            nodes = nodes.where("depth > 0").withColumn("depth", F.col("depth") + band * segment)
        trie = nodes if trie is None else trie.unionAll(nodes)
    return trie.select(
        F.col("first").alias("conv_id"), F.col("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def trie_report(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    turns, lengths = rebuilt(written(conversation_turns(conversations), "numbered"))
    return prefix_trie(turns, lengths)
