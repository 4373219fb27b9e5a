"""Bounded samples of labelled rows for the two fitted classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import bucket_of_id

PER_CLASS = 4000
HELD_OUT = (3, 1)


def label_sample(labels: DataFrame, per_class: int = PER_CLASS, label: str = "quality") -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` ids of each label, the first by a hash of the id, and the label counts.

    Held-out ids (crc32 of the id as text, modulo 3, is 1), NULL ids or labels, and ids with two
    different labels take no part.
    """
    modulus, held = HELD_OUT
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (bucket_of_id(modulus) != held))
            .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_high")).where("label = _high").drop("_high"))
    counts = {int(r[0]): int(r[1]) for r in rows.groupBy("label").agg(F.count(F.lit(1))).collect()}
    parts = [rows.where(F.col("label") == c).orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return parts[0].unionByName(parts[1]), counts
