"""The state of a replica after a changelog, in closed form: one shuffle by key, no loop over batches.

ordered   the state after all changes in log order
batchwise what a loop reaches that, batch by batch, truncates first, then upserts the last row of each
          key, then deletes; the result depends on where batches end
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changelog import keep_last


def ordered(changes: DataFrame, keys: list[str], truncates: bool = True) -> DataFrame:
    """The surviving rows, as their last change. keys: none appends all upserts (deletes have no meaning).

    truncates: whether the log may hold any; without, its one-row aggregate is saved.
    """
    if truncates:
        start = changes.filter("op = 'T'").agg(F.max("seq").alias("__truncated"))
        rows = changes.filter("op <> 'T'").join(F.broadcast(start), F.col("__truncated").isNull() | (F.col("seq") > F.col("__truncated"))).drop("__truncated")
    else:
        rows = changes
    if not keys:
        return rows.filter("op IN ('I', 'U')")
    return keep_last(rows, keys).filter("op <> 'D'")


def batchwise(changes: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, seq, values) of the rows alive after the last batch."""
    truncated = changes.filter("op = 'T'").agg(F.max("batch_id").alias("b_t"))
    upsert = F.col("op").isin("I", "U")
    summary = (
        changes.filter("op <> 'T'")
        .groupBy(*keys)
        .agg(
            F.max(F.when(upsert, F.col("batch_id"))).alias("b_i"),
            F.max(F.when(F.col("op") == "D", F.col("batch_id"))).alias("b_d"),
            F.max(F.when(upsert, F.struct("seq", *values))).alias("last"),
        )
    )
    alive = F.col("b_i").isNotNull() & (F.col("b_i") > F.coalesce("b_d", F.lit(-2))) & (F.col("b_i") >= F.coalesce("b_t", F.lit(-2)))
    return summary.join(F.broadcast(truncated), F.lit(True)).filter(alive).select(*keys, "last.seq", *[f"last.{v}" for v in values])


def _without(state: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of state whose key is none of gone's. NULL is a key like any other."""
    other = gone.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return state.join(other, same, "left_anti")


def upsert(state: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """state with rows in place of those of their keys. rows: one of each key, the columns of state."""
    return _without(state, rows, keys).unionByName(rows, allowMissingColumns=True)


def delete(state: DataFrame, keys_gone: DataFrame, keys: list[str]) -> DataFrame:
    return _without(state, keys_gone.select(*keys).distinct(), keys)


def tombstones_for_moved_keys(changes: DataFrame, keys: list[str]) -> DataFrame:
    """For updates that change the key (columns old_<key>), a delete of the old key just before.

    seq doubles, so that there is room before each change.
    """
    doubled = changes.withColumn("seq", F.col("seq") * 2 + 1)
    moved = F.lit(False)
    for k in keys:
        moved = moved | (F.col(f"old_{k}").isNotNull() & (F.col(f"old_{k}") != F.col(k)))
    gone = doubled.filter((F.col("op") == "U") & moved)
    gone = gone.withColumns({"op": F.lit("D"), "seq": F.col("seq") - 1} | {k: F.coalesce(f"old_{k}", k) for k in keys})
    return doubled.unionByName(gone)
