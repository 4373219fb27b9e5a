"""The corpus pipeline: quality, near-duplicates, benchmark passages, source mix, shards - in this order.

Every stage takes (spark, docs, sf_dir) with the columns of `documents` and works on all rows its
predecessor kept.  Rows without a doc_id are judged by their text alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm import classifier, decontaminate, mixing, near_dedup, sharding
from panelloom.llm.common import keep_table, marked, table

SHARDS = 40
ROW = "_row_content"


def _held(docs: DataFrame, *named: str) -> tuple[DataFrame, list[str]]:
    """The ``named`` columns as they are, and all columns of ``docs`` once more under names no operator uses."""
    held = {c: f"_held{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*named, *[F.col(f"`{c}`").alias(name) for c, name in held.items()]), list(held.values())


def _given(rows: DataFrame, docs: DataFrame, *more: Column) -> DataFrame:
    return rows.select(*[F.col(f"_held{i}").alias(c) for i, c in enumerate(docs.columns)], *more)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts.

    A NULL or empty text is judged by the model's constant part.  Repeated rows are judged alike; of an id with
    several texts each is judged by itself.  No column name is reserved; an empty table stays empty.
    """
    held, names = _held(docs, "doc_id", "text")
    return _given(classifier.classify(held, table(spark, sf_dir, "labels"), carried=tuple(names)).where("predicted = 1"), docs)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id; no text is lost with another's id.

    Of rows with one id and text one stays; a row without an id stays where no row with one is like it.  Texts
    without words, empty and NULL ones are nobody's duplicates.  No column name is reserved; an empty table stays empty.
    """
    return near_dedup.distinct_documents(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    A row is found by its id and text, so an id with several texts loses only those that are hit.  NULL and empty
    texts stay, rows repeated stay or go together.  No column name is reserved; an empty table stays empty.
    """
    held, _ = _held(docs, "doc_id", "text")
    row = F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit(""))), 256))
    named = held.withColumn(ROW, row)
    found = decontaminate.search(named.select(F.col(ROW).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    hit = keep_table(found.where(F.size("items") > 0).select(F.col("doc_id").alias(ROW)).distinct(), "pipeline-hit")
    seen = marked(named, hit, ROW, _hit=F.lit(True))
    return _given(seen.where("NOT _hit"), docs).unionAll(_given(seen.where("_hit").join(hit, ROW, "left_anti"), docs))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, in whole copies that keep each source's words.

    A document without words stays once.  NULL is a source of its own; repeated rows and rows of one id are
    separate documents.  No column name is reserved; an empty table stays empty.
    """
    held, names = _held(docs, "doc_id", "text", "source")
    mixed = mixing.whole_copies(held, carried=names).where("copies > 0")
    return _given(mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with `size`, `shard` and `slot`; equal texts, NULL ones too, share a shard.

    A column of ``docs`` with one of these names is given as `input_` and its name.  An empty table stays empty.
    """
    held, names = _held(docs, "doc_id", "text")
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 16
    placed = sharding.shard(held, SHARDS, ["text"], size, ["doc_id"], carried=names)
    made = ("size", "shard", "slot")
    named = [f"input_{c}" if c.lower() in made else c for c in docs.columns]
    return placed.select(*[F.col(h).alias(c) for h, c in zip(names, named)], *made)


STAGES = [("quality", good_quality), ("near_dedup", distinct_texts), ("decontaminate", without_benchmark),
          ("mix", target_mix), ("shard", into_shards)]
# The stages' models and searches are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
