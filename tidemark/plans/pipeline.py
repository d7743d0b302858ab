"""Snapshot, then follow the changelog: the plan of one table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import apply
from tidemark.operators.changelog import snapshot_as_changes
from tidemark.plans.config import Configuration, SourceTable
from tidemark.sources.snapshot import initial_copy


def replica_of(snapshot: DataFrame, existing: DataFrame, changes: DataFrame, keys: list[str], table: SourceTable, config: Configuration, mode: str = "ordered") -> DataFrame:
    """The replica's rows after the initial copy and, unless syncing is disabled, all changes.

    changes: seq, batch_id, op and the columns of the snapshot.
    """
    names = snapshot.columns
    copied = initial_copy(snapshot, existing, table.skip_copy)
    if config.target.disable_sync_loop:
        return copied
    log = snapshot_as_changes(copied.select(*names)).unionByName(changes.select(*names, "seq", "batch_id", "op"))
    if mode == "ordered":
        return apply.ordered(log, keys).select(*names)
    return apply.batchwise(log, keys, [n for n in names if n not in keys]).select(*names)
