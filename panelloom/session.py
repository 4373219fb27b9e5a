"""Runtime SQL settings the engine's wide projections profit from."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# HotSpot does not compile methods above 8000 bytes of bytecode.  A projection of dozens of
# rate columns fused into one method passes that and would run interpreted; with this limit
# Spark generates it as several smaller methods instead.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}
# For the plans: a row has up to hundreds of columns in few bytes, so a split of the usual size would be minutes of work for one task.
SPLITS = {"spark__sql__files__maxPartitionBytes": "16m"}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def settings(spark: SparkSession, **changes: str) -> Iterator[None]:
    """The engine's settings, and the given ones, for the time of a plan."""
    wanted = {**SETTINGS, **{name.replace("__", "."): value for name, value in changes.items()}}
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
