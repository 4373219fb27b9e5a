"""Intermediate tables on storage every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelloom.sources import fs


def shared_folder(spark: SparkSession, fallback: str = "") -> str:
    """The folder the cluster names for checkpoints, else the given one beside the output.

    With neither, a folder beside the session's tables: the warehouse is shared by definition.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return configured or fallback or fs.join(spark.conf.get("spark.sql.warehouse.dir"), "_panelloom")


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder, for plans that read it several times."""
    spark = df.sparkSession
    path = fs.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one run.  Writing one cuts the lineage: a lost executor costs a re-read only,
    and the optimizer knows the real size of what it joins."""

    def __init__(self, spark: SparkSession, fallback: str):
        self.spark = spark
        self.path = fs.join(shared_folder(spark, fallback), f"_run-{uuid.uuid4().hex}")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = fs.join(self.path, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        fs.delete(self.spark, self.path)
