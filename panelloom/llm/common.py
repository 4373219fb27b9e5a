"""Helpers of the corpus operators: tables, word cutting, chunks of Arrow batches, row ranks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.plans.scratch import keep_table

# Fixed value: one word.  bytes.split() without arguments cuts at exactly the complement.
WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 4 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about ``limit`` bytes of text each, NULL texts as empty ones.

    A longer text is a slice of its own, so the memory of a task follows its longest text.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start), [t or b"" for t in texts.slice(start, stop - start).to_pylist()]
            start = stop


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash per run of ``length`` words; none where there are fewer words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = words[:n].copy()
        for i in range(1, length):
            out = mixed(out) * MULTIPLIER + words[i:i + n]
        return mixed(out)


def record(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], names=schema.names)


def in_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    return df.mapInArrow(function, schema)


def bucket_of_id(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def gapless_rank(df: DataFrame, order: list[Column], name: str, step: str) -> DataFrame:
    """Adds the position, from 0, in a global order without gathering all rows in one task.

    Rows are dealt out by range and written once; a rank is the rows of all earlier ranges,
    one count per range, plus the rank within the range.
    """
    ranged = keep_table(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), step)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (ranged.withColumn("_inner", inner).join(before, "_range")
            .withColumn(name, F.col("_before") + F.col("_inner")).drop("_range", "_before", "_inner"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` with the value computed once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]


MEMBER_BITS = 23


def id_bit(key: str) -> Column:
    """The number of the bit of an id."""
    return F.pmod(F.xxhash64(F.lit(3), key), F.lit(1 << MEMBER_BITS))


def digest_bit(key: str) -> Column:
    """The number of the bit of a binary digest: its first bits, so that Python finds it alike."""
    return F.conv(F.hex(F.substring(key, 1, 3)), 16, 10).cast("long") % (1 << MEMBER_BITS)


def bit_of_digest(digest: bytes) -> int:
    return int.from_bytes(digest[:3], "big") % (1 << MEMBER_BITS)


def member_bits(df: DataFrame, bit: Column) -> np.ndarray:
    """A bit set of fixed size (1 MB) with the bits of all rows.

    Only a filter in front of an exact join: a value outside can share a bit, no value loses its own.
    """
    words = (df.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("v")).collect())
    out = np.zeros(1 << (MEMBER_BITS - 6), np.int64)
    for w, v in words:
        out[w] = v
    return out


def is_member(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    return (bits[numbers >> 6] >> (numbers & 63)) & 1 == 1


def marked(rows: DataFrame, names: DataFrame, key: str, **marks: Column) -> DataFrame:
    """``rows`` with a boolean for each of ``marks``, conditions on ``names``: False where no such name is the row's binary digest ``key``.

    True can be wrong, so an exact join must follow, but only of the rows marked: an exact join of all would shuffle
    wide rows that it has nothing to say about.  What is broadcast is a bit set of fixed size per mark (1 MB).
    """
    told = names.select(digest_bit(key).alias("_bit"), *[c.alias(name) for name, c in marks.items()])
    own = F.expr("shiftleft(1L, cast(_bit % 64 as int))")
    words = told.groupBy(F.shiftright("_bit", 6).alias("_word")).agg(*[F.bit_or(F.when(F.col(name), own)).alias(name) for name in marks])
    found = rows.withColumn("_bit", digest_bit(key)).withColumn("_word", F.shiftright("_bit", 6)).join(F.broadcast(words), "_word", "left")
    is_set = {name: F.coalesce(F.col(name).bitwiseAND(own) != 0, F.lit(False)) for name in marks}
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], *[c.alias(name) for name, c in is_set.items()])


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of undirected ``edges`` (a, b); a component is named by its smallest node.

    Alternates the two star steps until nothing changes.  Each is a minimum per node and a join, so a
    node with very many links is pre-aggregated and its rows stay spread; every round is a written table.
    """
    now = keep_table(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    before, turn = None, 0
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small_least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        turn += 1
        now = keep_table(small, f"{name}-{turn}")
        state = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
