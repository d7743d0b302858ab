"""Changelogs: rows (seq, batch_id, relation or table, op, key and value columns) in log order.

seq is a total order. op: I, U, D or T (truncate, of the whole table, without a key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A table of relations or collections is a setting; up to this many rows it is broadcast.
BROADCAST_RELATIONS = 100_000


def classify(op: Column) -> Column:
    """Which queue a change goes to; NULL for what changes no row."""
    return F.when(op.isin("I", "U"), "upsert").when(op == "D", "delete").when(op == "T", "truncate")


def route(changes: DataFrame, relations: DataFrame, key: str = "relation_id") -> tuple[DataFrame, DataFrame]:
    """(changes with the columns of their relation, changes of unknown relations)."""
    known = F.broadcast(relations) if relations.limit(BROADCAST_RELATIONS + 1).count() <= BROADCAST_RELATIONS else relations
    return changes.join(known, key), changes.join(known.select(key), key, "left_anti")


def of_collections(changes: DataFrame, names: list[str], column: str = "collection") -> DataFrame:
    return changes.filter(F.col(column).isin(*names))


def keep_last(changes: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """The last row of each key. Without keys: the last row of all."""
    last = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(F.col(seq).desc()) if keys else None
    if last is None:
        return changes.orderBy(F.col(seq).desc()).limit(1)
    return changes.withColumn("__place", F.row_number().over(last)).filter("__place = 1").drop("__place")


def counters(changes: DataFrame, table: str = "table_name", op: str = "op") -> DataFrame:
    """Inserts, updates and deletes of each table, before deduplication."""
    n = lambda x: F.count_if(F.col(op) == x)
    return changes.groupBy(table).agg(n("I").alias("inserts"), n("U").alias("updates"), n("D").alias("deletes"))


def key_of(cells: Column, positions: list[int]) -> Column:
    """The key of a decoded row: the texts of its key cells (from 1), NULL spelled out; no key column gives ''."""
    return F.concat_ws("|", *[F.coalesce(F.get(cells, F.lit(p - 1))["text"], F.lit("NULL")) for p in positions]) if positions else F.lit("")


def snapshot_as_changes(rows: DataFrame) -> DataFrame:
    """Snapshot rows come before all changes, in a batch of their own."""
    return rows.withColumns({"seq": F.lit(-1).cast("long"), "batch_id": F.lit(-1).cast("long"), "op": F.lit("I")})
