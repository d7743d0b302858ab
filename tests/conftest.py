from __future__ import annotations

import datetime
import decimal
import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.default.parallelism", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _plain(x):
    if isinstance(x, float):
        return "nan" if x != x else round(x, 6)
    if isinstance(x, decimal.Decimal):
        return round(float(x), 6)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return x


def rows_of(names: list[str], rows) -> list[tuple]:
    """Rows with columns by name, in an order of their own."""
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(_plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def same_as_sql(duck):
    def check(df, sql):
        result = duck.execute(sql)
        names = [c[0] for c in result.description]
        assert sorted(df.columns) == sorted(names)
        assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())

    return check
