import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def run(sql, folder=SMALL):
        con = duckdb.connect()
        for t in TABLES:
            path = f"{folder}/{t}.parquet"
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
        return con.execute(sql).df()

    return run


def same(got, expected):
    """Equal rows in any order; columns by name."""
    import math

    import pandas as pd

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, (bool, str)) or type(v).__name__ == "bool_":
            return str(bool(v)) if not isinstance(v, str) else v
        x = float(v)
        return str(int(x)) if x.is_integer() else f"{x:.9g}"

    rows = lambda df: sorted([tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False)])
    assert sorted(got.columns) == sorted(expected.columns)
    a, b = rows(got), rows(expected)
    assert len(a) == len(b)
    assert a == b


@pytest.fixture(scope="session")
def check_same():
    return same
