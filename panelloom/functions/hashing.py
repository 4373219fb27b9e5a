"""Content ids, row signatures and order-free table fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control characters whose JSON escape has a hexadecimal letter.
LETTERED_ESCAPES = ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F")


def lower_escapes(json: Column) -> Column:
    """JSON text with its control-character escapes in lower case.

    An escape counts only after an even number of backslashes.  Such characters hardly ever
    occur, so everything but one substring test is skipped for nearly every row.
    """
    def lowered(text: Column, digits: Column) -> Column:
        escape = F.concat(F.lit(r"(?<!\\)((?:\\\\)*)\\u00"), digits)
        return F.regexp_replace(text, escape, F.concat(F.lit(r"$1\\u00"), F.lower(digits)))

    every = F.array(*[F.lit(d) for d in LETTERED_ESCAPES])
    return F.when(json.contains("\\u00"), F.aggregate(every, json, lowered)).otherwise(json)


def with_content_id(rows: DataFrame, attributes: Sequence[str], name: str) -> DataFrame:
    """Adds the SHA-256 of the attributes as a compact JSON array with NULL as ``null``.

    The id is NULL where the first attribute, the code, is NULL.  The JSON text is a column of
    its own first, as it is used more than once.
    """
    json = rows.withColumn("_json", F.to_json(F.array(*attributes)))
    identity = F.sha2(lower_escapes(F.col("_json")), 256)
    return json.withColumn(name, F.when(F.col(attributes[0]).isNotNull(), identity)).drop("_json")


def row_signature(columns: Sequence[str]) -> Column:
    """Binary SHA-256 over the given columns; equal exactly for equal content.

    Values are written with their names, so that NULLs, most of a wide row, can be left out.
    """
    content = F.to_json(F.struct(*columns), {"ignoreNullFields": "true"})
    return F.unhex(F.sha2(content, 256))


def row_hashes(columns: Sequence[str], salt: str = "") -> tuple[Column, Column]:
    """Two 64-bit hashes over the columns, equal for equal rows.

    The NULL flags take part because a hash skips NULLs and would let values change columns.
    """
    values = [F.col(c) for c in columns]
    first = F.xxhash64(*values, *[v.isNull() for v in values])
    return first, F.xxhash64(F.lit(salt), first, *values)


def fingerprint(df: DataFrame, table: str) -> DataFrame:
    """One row that is the same for equal multisets of rows, in any order or partitioning."""
    first, second = row_hashes(sorted(df.columns), table)
    return (df.select(first.alias("h1"), second.alias("h2"))
            .agg(F.count(F.lit(1)).alias("linhas"),
                 F.coalesce(F.bit_xor("h1"), F.lit(0)).alias("paridade"),
                 F.coalesce(F.sum(F.col("h1").cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("soma"),
                 F.coalesce(F.sum(F.col("h2").cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("soma_reforco"))
            .withColumn("tabela", F.lit(table)))
