"""Compare registered queries with their oracles: python tests/oracle_check.py SF_DIR [query ...]."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def frame(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object)
    df = df.where(df.notna(), None).map(lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v)
    return df.sort_values(by=list(df.columns), key=lambda c: c.map(repr)).reset_index(drop=True)


def compare(spark, sf_dir, name, query, sql):
    """None if both give the same rows, else a description of the difference."""
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    expected = frame(connection.sql(sql).df())
    actual = frame(query(spark, sf_dir).toPandas())
    if list(actual.columns) != list(expected.columns):
        return f"columns {list(actual.columns)} instead of {list(expected.columns)}"
    if len(actual) != len(expected):
        left = {tuple(row) for row in actual.itertuples(index=False)}
        right = {tuple(row) for row in expected.itertuples(index=False)}
        return f"{len(actual)} rows instead of {len(expected)}\n{sorted(left - right, key=repr)[:3]}\n{sorted(right - left, key=repr)[:3]}"
    unequal = actual.map(repr) != expected.map(repr)
    if unequal.any(axis=None):
        first = unequal.any(axis=1).idxmax()
        columns = list(unequal.columns[unequal.any(axis=0)])
        return f"{int(unequal.any(axis=1).sum())} rows differ in {columns}\n{actual.loc[first].to_dict()}\n{expected.loc[first].to_dict()}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            difference = compare(session, sys.argv[1], name, queries[name], oracles[name])
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += difference is not None
        print(f"{name}: {'ok' if difference is None else difference} ({time.time() - start:.1f}s)", flush=True)
    print(f"{failures} failures")
