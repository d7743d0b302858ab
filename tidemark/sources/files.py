"""Sources as files in the wire formats: COPY TEXT snapshots, change messages, Extended JSON documents.

A relational folder holds <schema>.<table>.columns.json (name, udt, nullable, is_key, comment of each
column, relation_id and the table's comment), <schema>.<table>.copy and changes.jsonl (seq, lsn, xid, data in base64). A
document folder holds <collection>.jsonl and changes/ (JSON lines: seq, operation_type, collection,
document_key, full_document), to which files are added.
"""

from __future__ import annotations

import json
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import copytext
from tidemark.operators.projection import SourceColumn
from tidemark.plans.config import SourceTable
from tidemark.sources.snapshot import estimated_rows, named_fields, read_copy_lines, read_documents
from tidemark.streaming.changes import read_changes, read_document_changes


class Source(Protocol):
    """What the pipe of a relational source needs."""

    def columns(self, table: SourceTable) -> list[SourceColumn]: ...

    def relations(self, tables: tuple[SourceTable, ...]) -> DataFrame:
        """(relation_id, schema_name, table_name)."""

    def snapshot(self, table: SourceTable) -> DataFrame:
        """The table's columns as text."""

    def changes(self, limit: int, **options) -> DataFrame:
        """A stream of (seq, lsn, xid, data). options: timeout_millis, idle_millis."""

    def estimate(self, table: SourceTable) -> int:
        """About how many rows the table has."""


class RelationalFiles:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _described(self, table: SourceTable) -> dict:
        rows = self.spark.read.option("wholetext", True).text(f"{self.folder}/{table.schema_name}.{table.table_name}.columns.json")
        return json.loads(rows.first()["value"])

    def columns(self, table: SourceTable) -> list[SourceColumn]:
        return [SourceColumn(**c) for c in self._described(table)["columns"]]

    def relations(self, tables: tuple[SourceTable, ...]) -> DataFrame:
        rows = [(self._described(t)["relation_id"], t.schema_name, t.table_name) for t in tables]
        return self.spark.createDataFrame(rows, "relation_id long, schema_name string, table_name string")

    def snapshot(self, table: SourceTable) -> DataFrame:
        lines = read_copy_lines(self.spark, f"{self.folder}/{table.schema_name}.{table.table_name}.copy")
        return named_fields(copytext.decode_lines(lines, canonical=None), [c.name for c in self.columns(table)])

    def changes(self, limit: int, **options) -> DataFrame:
        return read_changes(self.spark, f"{self.folder}/changes.jsonl", limit, **options)

    def comment(self, table: SourceTable) -> str:
        return self._described(table).get("comment", "")

    def estimate(self, table: SourceTable) -> int:
        return estimated_rows(self.spark, f"{self.folder}/{table.schema_name}.{table.table_name}.copy")


class DocumentFiles:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def snapshot(self, collection: str) -> DataFrame:
        """doc (VARIANT); empty where there is no file, and without the lines that are no JSON."""
        try:
            lines = self.spark.read.text(f"{self.folder}/{collection}.jsonl")
        except AnalysisException:
            lines = self.spark.createDataFrame([], "value string")
        return read_documents(lines)

    def changes(self, limit: int = 65536, **options) -> DataFrame:
        return read_document_changes(self.spark, f"{self.folder}/changes", limit, **options)
