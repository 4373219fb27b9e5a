"""Operator 7: indivisible groups put into shards by best-fit-decreasing bin packing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.common import gapless_rank, in_arrow, keep_table

SLICES = 256


class FreeSpace:
    """Bins in a balanced (AA) tree by remaining capacity, then number; finds the tightest that fits."""

    def __init__(self):
        self.root = None

    def insert(self, key: tuple[int, int]) -> None:
        self.root = self._insert(self.root, key)

    def _insert(self, node, key):
        if node is None:
            return [1, key, None, None]
        side = 2 if key < node[1] else 3
        node[side] = self._insert(node[side], key)
        return self._split(self._skew(node))

    @staticmethod
    def _skew(node):
        left = node[2]
        if left is not None and left[0] == node[0]:
            node[2], left[3] = left[3], node
            return left
        return node

    @staticmethod
    def _split(node):
        right = node[3]
        if right is not None and right[3] is not None and right[3][0] == node[0]:
            node[3], right[2] = right[2], node
            right[0] += 1
            return right
        return node

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def _remove(self, node, key):
        if key == node[1]:
            if node[2] is None and node[3] is None:
                return None
            side, other = (3, 2) if node[2] is None else (2, 3)
            near = node[side]
            while near[other] is not None:
                near = near[other]
            node[1] = near[1]
            node[side] = self._remove(node[side], near[1])
        else:
            side = 2 if key < node[1] else 3
            node[side] = self._remove(node[side], key)
        level = 1 + min(node[2][0] if node[2] else 0, node[3][0] if node[3] else 0)
        if level < node[0]:
            node[0] = level
            if node[3] is not None and node[3][0] > level:
                node[3][0] = level
        node = self._skew(node)
        if node[3] is not None:
            node[3] = self._skew(node[3])
            if node[3][3] is not None:
                node[3][3] = self._skew(node[3][3])
        node = self._split(node)
        if node[3] is not None:
            node[3] = self._split(node[3])
        return node

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The smallest (remaining, bin) with remaining >= size."""
        node, best = self.root, None
        while node is not None:
            if node[1][0] >= size:
                best, node = node[1], node[2]
            else:
                node = node[3]
        return best


def packed_runs(sizes: Sequence[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int]] | None:
    """Best-fit-decreasing of (size, number of items) in descending order of size, as (bin, number of items) in turn.

    Items of one size are interchangeable.  The tightest bin that takes one stays the tightest for the next of
    that size until it takes no more, so a run of equal items enters a bin at once and the result is that of
    single items.  Bins are opened only when nothing fits; None if more than ``most`` are needed.
    """
    free, runs, opened = FreeSpace(), [], 0
    for size, number in sizes:
        while number:
            spot = free.tightest(size)
            if spot is None:
                if opened == most:
                    return None
                spot, opened = (capacity, opened), opened + 1
            else:
                free.remove(spot)
            entered = min(number, spot[0] // size) if size else number
            runs.append((spot[1], entered))
            free.insert((spot[0] - size * entered, spot[1]))
            number -= entered
    return runs


def best_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[int]:
    """The bin of each of the descending sizes."""
    equal = [(size, len(list(items))) for size, items in groupby(sizes)]
    return [b for b, entered in packed_runs(equal, capacity) for _ in range(entered)]


def pack(sizes: Sequence[tuple[int, int]], shards: int) -> list[tuple[int, int]]:
    """(shard, number of items) in turn over descending (size, number of items), for the smallest capacity
    found by bisection that needs no more than ``shards``.

    An item above the even share of what is left gets a shard of its own, and the others are packed into the rest.
    """
    others, alone = list(sizes), 0
    rest = sum(size * number for size, number in others)
    while others and alone < shards - 1 and others[0][0] * (shards - alone) > rest:
        size, number = others.pop(0)
        rest -= size
        alone += 1
        if number > 1:
            others.insert(0, (size, number - 1))
    own, left = [(k, 1) for k in range(alone)], shards - alone
    if not others:
        return own
    low = max(others[0][0], -(-rest // left))
    high = low + others[0][0]
    while (best := packed_runs(others, high, left)) is None:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        found = packed_runs(others, middle, left)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    return own + [(alone + b, entered) for b, entered in best]


def shard(docs: DataFrame, shards: int, group: Sequence[str], size: Column, order: Sequence[str],
          carried: Sequence[str], slices: int = SLICES) -> DataFrame:
    """The ``carried`` columns with `size`, `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard).

    Rows of equal ``group`` values (NULL equals NULL) stay together, and a group is never divided.  Every group
    takes part in the packing: the driver packs (size, number of groups), and groups, ranked by descending size
    without gathering them, take the places of their rank.  Different sizes add up to at least half their
    number's square, so a table of T bytes sends at most sqrt(2 T) rows to the driver.  A group above the
    even share fills a shard of its own, which then is the largest by necessity.

    Slots are the rows of the shard's earlier slices, plus the position in ``order`` within the slice;
    no task numbers a whole shard.  Only narrow rows are ranked and numbered, the carried columns travel once.
    A NULL or negative size is packed as 0 and given as it is.  Empty input gives no rows; input columns named
    `size`, `shard` or `slot` are replaced.  The ``group`` columns are text.
    """
    # Length before content keeps neighbouring values apart; NULL has no length.
    values = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in group]
    name = F.sha2(F.concat(*values), 256)
    keys = [f"_o{i}" for i in range(len(order))]
    plain = [c for c in carried if c not in ("size", "shard", "slot")]
    # Written with its row numbers, so that a repeated task finds the same ones.
    rows = keep_table(docs.select(*plain, size.cast("long").alias("size"), F.unhex(name).alias("_group"),
                                  *[F.col(c).alias(k) for c, k in zip(order, keys)], F.monotonically_increasing_id().alias("_row"))
                      .withColumn("_slice", F.pmod(F.xxhash64("_group", *keys), F.lit(slices))), "shard-rows")
    weight = F.greatest(F.coalesce("size", F.lit(0)), F.lit(0))
    groups = rows.groupBy("_group").agg(F.sum(weight).alias("_size"))
    ranked = keep_table(gapless_rank(groups, [F.col("_size").desc(), F.col("_group")], "_rank", "shard-groups"), "shard-ranks")
    sizes = ranked.groupBy("_size").agg(F.count(F.lit(1)).alias("n")).toArrow()
    descending = sorted(zip(sizes.column(0).to_pylist(), sizes.column(1).to_pylist()), reverse=True)
    placed = pack(descending, shards)
    own = keep_table(_shards_of_ranks(ranked, placed), "shard-places")
    put = rows.select("_row", "_group", "_slice", *keys).join(own, "_group")
    counts = put.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("shard", "_slice", (F.sum("_n").over(Window.partitionBy("shard").orderBy("_slice"))
                                               - F.col("_n")).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("shard", "_slice").orderBy(*keys, "_row"))
    # At most shards x slices counts.
    numbered = (put.withColumn("_inner", inner).join(F.broadcast(before), ["shard", "_slice"])
                .select("_row", "shard", (F.col("_before") + F.col("_inner") - 1).alias("slot")))
    return rows.select(*plain, "size", "_row").join(numbered, "_row").select(*plain, "size", "shard", "slot")


def _shards_of_ranks(ranked: DataFrame, placed: list[tuple[int, int]]) -> DataFrame:
    """(_group, shard): a rank belongs to the run of the packing it falls into."""
    runs = np.array(placed, np.int64).reshape(-1, 2)
    shared = ranked.sparkSession.sparkContext.broadcast((np.cumsum(runs[:, 1]), runs[:, 0].astype(np.int32)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, shards = shared.value
        for batch in batches:
            ranks = batch.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shards[np.searchsorted(ends, ranks, side="right")])],
                                             names=["_group", "shard"])

    return in_arrow(ranked.select("_group", "_rank"), run, "_group binary, shard int")
