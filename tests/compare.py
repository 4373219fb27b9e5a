"""Runs queries beside their SQL counterparts: python tests/compare.py [folder] [query ...]"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    values = frame.astype(object).where(frame.notna(), None).values.tolist()
    def plain(v):
        if v is None or isinstance(v, (str, bool)):
            return repr(v)
        return repr(float(v)) if isinstance(v, (int, float)) else str(v)
    return sorted([tuple(plain(v) for v in row) for row in values])


def difference(spark_frame, sql_frame):
    """None when equal, else what differs first."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    left, right = _rows(spark_frame), _rows(sql_frame)
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            cells = [(c, x, y) for c, x, y in zip(sorted(spark_frame.columns), a, b) if x != y]
            return f"values {cells[:4]}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name in wanted:
        start = time.time()
        try:
            frame = entry.queries()[name](spark, folder)
            types = dict(frame.dtypes)
            found = frame.toPandas()
            took = time.time() - start
            if name not in entry.oracle_sql():
                print(f"{name:22s} {took:6.2f}s rows={len(found)} (rows only)", flush=True)
                continue
            relation = connection.execute(entry.oracle_sql()[name])
            expected = relation.df()
            problem = difference(found, expected)
            print(f"{name:22s} {took:6.2f}s rows={len(found)} {'OK' if problem is None else 'DIFF ' + problem}", flush=True)
        except Exception as error:
            print(f"{name:22s} FAILED {str(error)[:1500]}", flush=True)


if __name__ == "__main__":
    main()
