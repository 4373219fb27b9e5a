"""Operator 13: the trie of conversation prefixes, from sorted sequences and a sparse table of range minima."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import WORD, keep_table, table

# Bytes of a turn's code: the first of a SHA-256, so that codes of different turns differ.
CODE = 16
BLOCK_TURNS = 200_000
SHARED_TURNS = 4
FAMILY = 20
NO_ENDS = hashlib.sha256(b"").hexdigest()
SEQUENCES = "block string, place long, key binary, words array<int>, conv_id long, members long, ends string"
EDGES = "block string, node binary, members long, conv_id long, inner boolean"
NODES = ("node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")


class RangeMinimum:
    """Minima of every run of 2 ** k neighbours, so that any range takes two look-ups."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The minimum of each range, both ends included; none is empty."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.levels[k][first[own]], self.levels[k][last[own] - (1 << k) + 1])
        return out

    def right_extent(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last row reached from each row while all values after it are at least the bound."""
        reach, n = at.copy(), len(self.levels[0])
        for k in reversed(range(len(self.levels))):
            inside = reach + (1 << k) < n
            inside[inside] = self.levels[k][reach[inside] + 1] >= bound[inside]
            reach[inside] += 1 << k
        return reach

    def left_extent(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first row reached going back while every value passed is at least the bound."""
        reach = at.copy()
        for k in reversed(range(len(self.levels))):
            inside = reach - (1 << k) >= 0
            inside[inside] = self.levels[k][reach[inside] - (1 << k) + 1] >= bound[inside]
            reach[inside] -= 1 << k
        return reach


def common_prefixes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Turns of each key, and the turns it shares with the key before it (-1 for the first)."""
    lengths = np.fromiter(map(len, keys), np.int64, len(keys)) // CODE
    codes = np.frombuffer(b"".join(keys), np.dtype((np.void, CODE)))
    starts = np.cumsum(lengths) - lengths
    shared = np.full(len(keys), -1, np.int64)
    if len(keys) > 1:
        both = np.minimum(lengths[1:], lengths[:-1])
        offset = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
        differ = codes[np.repeat(starts[1:], both) + offset] != codes[np.repeat(starts[:-1], both) + offset]
        where = np.append(np.flatnonzero(differ), len(differ))
        ends = np.cumsum(both)
        first = where[np.searchsorted(where, ends - both)]
        shared[1:] = np.minimum(first - (ends - both), both)
    return lengths, shared


class Block:
    """Neighbouring distinct sequences, and the candidate prefixes that first appear among them."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("place")
        self.keys = rows["key"].to_pylist()
        self.members = rows["members"].to_numpy().astype(np.int64)
        self.convs = rows["conv_id"].to_numpy().astype(np.int64)
        self.ends = rows["ends"].to_pylist()
        words = rows["words"].combine_chunks()
        self.words = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.lengths, self.shared = common_prefixes(self.keys)
        new = self.lengths - self.shared
        self.row = np.repeat(np.arange(len(new)), new)
        self.depth = np.arange(new.sum()) - np.repeat(np.cumsum(new) - new, new) + self.shared[self.row] + 1
        self.shared_minima = RangeMinimum(self.shared)
        self.left = self.shared_minima.left_extent(self.row, self.depth)
        self.right = self.shared_minima.right_extent(self.row, self.depth)
        # A prefix of the block's first or last row may go on in another block.
        self.edge = (self.left == 0) | (self.right == len(new) - 1)
        before = np.concatenate([[0], np.cumsum(self.members)])
        self.n = before[self.right + 1] - before[self.left]
        self.least = RangeMinimum(self.convs).of(self.left, self.right)
        self.offset = np.cumsum(new) - new

    def index(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The candidate of a row that introduces the prefix of the depth."""
        return self.offset[row] + depth - self.shared[row] - 1

    def parents(self) -> np.ndarray:
        """The candidate one turn shorter; -1 for the root."""
        out = np.full(len(self.row), -1, np.int64)
        below = np.flatnonzero(self.depth > 0)
        first = self.shared_minima.left_extent(self.row[below], self.depth[below] - 1)
        out[below] = self.index(first, self.depth[below] - 1)
        return out

    def names(self) -> list[bytes]:
        """Digests of the edge candidates' prefixes, alike in every block; one pass along the two outer rows."""
        known: dict[int, bytes] = {}
        for row in {0, len(self.keys) - 1}:
            state, key = hashlib.sha256(), self.keys[row]
            depths = np.arange(self.lengths[row] + 1)
            for d, i in zip(depths, self.index(self.shared_minima.left_extent(np.full(len(depths), row), depths), depths)):
                state.update(key[(d - 1) * CODE:d * CODE] if d else b"")
                known[int(i)] = state.digest()
        return [known[int(i)] for i in np.flatnonzero(self.edge)]


def _turns(conversations: DataFrame) -> DataFrame:
    """One narrow row per conversation: its turns in order, each as a code and its number of words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(F.col("turn"), F.expr(f"substring(sha2(_told, 256), 1, {2 * CODE})").alias("code"),
                    F.regexp_count("_text", F.lit(WORD)).alias("words"))
    rows = (conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", text.alias("_text"), told.alias("_told"))
            .select("conv_id", turn.alias("turn")))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn"), _by_turn).alias("turns"))


def _by_turn(a: Column, b: Column) -> Column:
    """NULL turns first; equal turns by code."""
    def order(x: Column, y: Column, then: Column) -> Column:
        return F.when(x < y, -1).when(x > y, 1).otherwise(then)

    number = [F.coalesce(x["turn"].isNotNull().cast("int"), F.lit(0)) for x in (a, b)]
    value = [F.coalesce(x["turn"], F.lit(0)) for x in (a, b)]
    return order(*number, order(*value, order(a["code"], b["code"], F.lit(0))))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversations with the first h turns of their family's first one, then their own after the first h."""
    own = keep_table(_turns(conversations), "trie-turns")
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED_TURNS).cast("int")
    base = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED_TURNS - 1).alias("first"))
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(base, "base", "left").withColumn("h", h)
    empty = F.slice("turns", 1, 0)
    turns = F.concat(F.coalesce(F.slice("first", F.lit(1), F.col("h")), empty), F.expr("slice(turns, h + 1, size(turns))"))
    return (joined.select("conv_id", turns.alias("turns"))
            .select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["code"]), "")).alias("key"),
                    F.transform("turns", lambda t: t["words"]).alias("words")))


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """Every distinct sequence once, with its members' number, least id, and the hash of all their ids.

    Ids of equal sequences meet sorted in one task, which feeds them to one hash as they pass: a SHA-256
    of a list is one chain, but neither the list nor the sequences themselves are held.
    """
    named = keep_table(sequences.withColumn("name", F.unhex(F.sha2("key", 256))), "trie-sequences")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, state, count, least = None, [], None, 0, 0
        for batch in batches:
            for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name == now:
                    state.update(b",%d" % conv)
                    count += 1
                    continue
                if now is not None:
                    out.append((least, count, state.hexdigest()))
                now, state, count, least = name, hashlib.sha256(b"%d" % conv), 1, conv
            yield _listed(out)
            out = []
        if now is not None:
            yield _listed([(least, count, state.hexdigest())])

    met = named.select("name", "conv_id").repartition("name").sortWithinPartitions("name", "conv_id")
    firsts = met.mapInArrow(run, "conv_id long, members long, ends string")
    return named.drop("name").join(firsts, "conv_id")


def _listed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "members", "ends"])


def in_blocks(sequences: DataFrame, block_turns: int) -> DataFrame:
    """The sequences in order of their keys, cut into blocks of about ``block_turns`` turns of neighbours."""
    ordered = (sequences.select("key", "words", "conv_id", "members", "ends").repartitionByRange("key").sortWithinPartitions("key")
               .select(F.spark_partition_id().alias("part"), "*"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, turns, place = 0, 0, 0
        for batch in batches:
            blocks, places = [], []
            for part, size in zip(batch.column(0).to_pylist(), map(len, batch.column(1).to_pylist())):
                if turns and turns + size // CODE + 1 > block_turns:
                    block, turns = block + 1, 0
                turns, place = turns + size // CODE + 1, place + 1
                blocks.append(f"{part}-{block}")
                places.append(place)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.string()), pa.array(places, pa.int64()), *batch.columns[1:]],
                                             names=["block", "place", "key", "words", "conv_id", "members", "ends"])

    return keep_table(ordered.mapInArrow(run, SEQUENCES), "trie-blocks")


def trie(sequences: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The nodes of the trie of ``sequences`` (conv_id, key of codes, words of each turn).

    Sorted by key, the members of a prefix are neighbours.  Each candidate prefix, taken where it first
    appears, searches its left and right extent in the block's common-prefix lengths, each by halving
    steps over a sparse table of range minima and without regard to any other candidate.  Prefixes of a
    block's first and last row may go on in other blocks: their parts are named by the prefix's digest and
    added up, once for members and once for what depends on all members.  So a task holds one block, and a
    prefix that all conversations share is one small row per block.
    """
    blocks = in_blocks(distinct_sequences(sequences), block_turns)

    def parts(rows: pa.Table) -> pa.Table:
        b = Block(rows)
        at = np.flatnonzero(b.edge)
        inner = np.zeros(len(b.row), bool)
        parents = b.parents()
        inner[parents[parents >= 0]] = True
        return pa.table([[rows["block"][0].as_py()] * len(at), pa.array(b.names(), pa.binary()), b.n[at], b.least[at], inner[at]],
                        names=["block", "node", "members", "conv_id", "inner"])

    edges = keep_table(blocks.groupBy("block").applyInArrow(parts, EDGES), "trie-edges")
    whole = edges.groupBy("node").agg(F.sum("members").alias("members"), F.min("conv_id").alias("conv_id"),
                                      F.max("inner").alias("inner"), F.min("block").alias("home"))
    known = edges.select("block", "node").join(whole, "node")

    def count(rows: pa.Table, outer: pa.Table) -> pa.Table:
        b = Block(rows)
        block, at = rows["block"][0].as_py(), np.flatnonzero(b.edge)
        names, total = b.names(), {r["node"]: r for r in outer.to_pylist()}
        n, least = b.n.copy(), b.least.copy()
        parents = b.parents()
        inner, here = np.zeros(len(n), bool), np.ones(len(n), bool)
        inner[parents[parents >= 0]] = True
        for i, name in zip(at, names):
            found = total[name]
            n[i], least[i], inner[i], here[i] = found["members"], found["conv_id"], found["inner"], found["home"] == block
        # A node counts where its home is, so that blocks that share it add up to one.
        starts = np.cumsum(b.lengths) - b.lengths
        last = np.zeros(len(n), np.int64)
        below = b.depth > 0
        last[below] = b.words[starts[b.row[below]] + b.depth[below] - 1]
        saved = np.where(here, (n - 1) * last, 0)
        leaf = np.where(here & ~inner, 1, 0)
        children = np.bincount(parents[(parents >= 0) & here], minlength=len(n)) if len(n) else n
        ends = np.array([e if d == length else None for d, length, e in zip(b.depth, b.lengths[b.row], np.array(b.ends, object)[b.row])], object)
        # A subtree is the node's own way down from its first row and all that its other rows bring.
        stop = np.append(b.offset[1:], len(n))
        outs = []
        for value in (leaf, saved):
            sums = np.concatenate([[0], np.cumsum(value)])
            outs.append(sums[stop[b.right]] - sums[np.arange(len(n))])
        node = np.full(len(n), None, object)
        for i, name in zip(at, names):
            node[i] = name
        parent = np.where(parents >= 0, least[parents], 0)
        return pa.table([pa.array(node, pa.binary()), least, b.depth, pa.array(parent, pa.int64(), mask=parents < 0), n, children.astype(np.int64),
                         outs[0], outs[1], pa.array(ends, pa.string())],
                        names=["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"])

    nodes = keep_table(blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(count, NODES), "trie-nodes")
    inside = nodes.where("node IS NULL").drop("node")
    across = (nodes.where("node IS NOT NULL")
              .groupBy("node").agg(*[F.min(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")],
                                   *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")], F.max("ends_sha256").alias("ends_sha256")).drop("node"))
    return inside.unionByName(across).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


def prefix_trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included.

    Turns are ordered by turn, NULL first, then by the digest of role and text; a row repeated exactly is a
    turn of its own.  NULL roles and texts are empty ones.  Rows without a conv_id belong to no conversation
    and are left out; an empty table has no nodes.  Other columns are not looked at, whatever their names.

    Texts are read once and become codes of 16 bytes; a conversation is one row of about 30 bytes a turn.
    """
    return trie(rebuilt(conversations), block_turns)


def op13_prefix_trie(spark, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))
