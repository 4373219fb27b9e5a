"""Cell grids: the rows of sheets as arrays of text cells."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID_SCHEMA = "file string, sheet string, sheet_idx int, row_idx int, cells array<string>"


def read_cell_grid(spark: SparkSession, path: str, data_format: str = "parquet") -> DataFrame:
    """A stored grid.  In CSV the cells of a row are one JSON array of texts."""
    if data_format == "csv":
        rows = spark.read.csv(path, header=True, escape='"', multiLine=True,
                              schema="file string, sheet string, sheet_idx int, row_idx int, cells string")
        return rows.withColumn("cells", F.from_json("cells", "array<string>"))
    return spark.read.format(data_format).schema(GRID_SCHEMA).load(path)


def _read_workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["caminho"]:
            with pd.ExcelFile(path) as workbook:
                for index, sheet in enumerate(workbook.sheet_names):
                    rows = workbook.parse(sheet, header=None, dtype=str)
                    cells = [[None if pd.isna(c) else c for c in row] for row in rows.itertuples(index=False)]
                    yield pd.DataFrame({"file": path, "sheet": sheet, "sheet_idx": index,
                                        "row_idx": range(len(cells)), "cells": cells})


def read_workbooks(inventory: DataFrame) -> DataFrame:
    """Grid of the inventory's workbooks, one file per task; needs an Excel reader for pandas."""
    try:
        import openpyxl  # noqa: F401
    except ImportError as error:
        raise RuntimeError("Leitura de Excel requer openpyxl (ou xlrd); forneça a grade de células.") from error
    files = inventory.where(F.col("status") == "ok").select("caminho")
    return files.repartition("caminho").mapInPandas(_read_workbooks, GRID_SCHEMA)
