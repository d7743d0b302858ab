"""Changelogs over the driver's tables; each is one list of expressions that Spark and other SQL engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.snapshot import read_table

ORDERS = [
    "o_orderkey AS seq",
    "o_custkey AS pk",
    "o_totalprice AS v",
    "CAST(floor(o_orderkey / 500) AS BIGINT) AS batch_id",
    "CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'I' ELSE 'U' END AS op",
]
EVENTS = [
    "event_id AS seq",
    "user_id * 10 + event_id % 10 AS pk",
    "value AS v",
    "CAST(floor(event_id / 100) AS BIGINT) AS batch_id",
    "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op",
]
#: Texts of all kinds that coercions meet.
TEXTS = [
    "event_id",
    """CASE event_id % 16 WHEN 0 THEN CAST(event_id AS STRING) WHEN 1 THEN concat(' ', CAST(event_id AS STRING), ' ') WHEN 2 THEN '1.5'
       WHEN 3 THEN 'abc' WHEN 4 THEN '18446744073709551615' WHEN 5 THEN '18446744073709551616' WHEN 6 THEN concat('-', CAST(user_id AS STRING))
       WHEN 7 THEN '1e5' WHEN 8 THEN '1d' WHEN 9 THEN ' 2.0' WHEN 10 THEN 'true' WHEN 11 THEN 'T' WHEN 12 THEN 'yes' WHEN 13 THEN '1'
       WHEN 14 THEN '' ELSE NULL END AS x""",
]


def frame(spark: SparkSession, sf_dir: str, table: str, expressions: list[str]) -> DataFrame:
    return read_table(spark, sf_dir, table).selectExpr(*expressions)


def sql(table: str, expressions: list[str]) -> str:
    return f"SELECT {', '.join(expressions)} FROM {table}"
