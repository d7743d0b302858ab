"""Schemas: catalogs, table creation, evolution, options, publications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import spark_type
from tidemark.operators.projection import SourceColumn

GRANULARITY = 8192
MIN_AGE_TO_FORCE_MERGE_SECONDS = 60


@dataclass(frozen=True)
class TableOptions:
    storage_policy: str | None = None
    granularity: int | None = None
    min_age_to_force_merge_seconds: int | None = None

    def inherit(self, parent: TableOptions) -> TableOptions:
        """Policy and granularity come from the parent where unset; the merge age does not."""
        own = lambda mine, theirs: theirs if mine is None else mine
        return TableOptions(own(self.storage_policy, parent.storage_policy), own(self.granularity, parent.granularity), self.min_age_to_force_merge_seconds)


def _definition(c: SourceColumn) -> str:
    comment = c.comment.replace("'", '"')
    return f"`{c.name}` {c.type.text()} COMMENT '{comment}'"


def create_table_text(database: str, table: str, columns: list[SourceColumn], options: TableOptions = TableOptions(), comment: str = "") -> str:
    """The statement that creates the replica table in a merge-tree store."""
    keys = ", ".join(c.name for c in columns if c.is_key)
    granularity = GRANULARITY if options.granularity is None else options.granularity
    age = MIN_AGE_TO_FORCE_MERGE_SECONDS if options.min_age_to_force_merge_seconds is None else options.min_age_to_force_merge_seconds
    policy = "" if options.storage_policy is None else ", storage_policy = '{}'\n".format(options.storage_policy.replace("'", "''"))
    return (
        f"CREATE TABLE {database}.{table}(" + ", \n".join(map(_definition, columns)) + ") ENGINE = ReplacingMergeTree()\n"
        + (f"ORDER BY ({keys})\n" if keys else "")
        + f"SETTINGS\nindex_granularity = {granularity}\n, min_age_to_force_merge_seconds = {age}\n{policy}"
        + "COMMENT '{}'\n;".format(comment.replace("'", "''"))
    )


def add_column_text(database: str, table: str, column: SourceColumn) -> str:
    return f"ALTER TABLE {database}.{table} ADD COLUMN {_definition(column)};"


def columns_of(df: DataFrame) -> DataFrame:
    """The catalog of a table: position from 1, name, type, nullable, key flag, comment."""
    rows = [(k + 1, f.name, f.dataType.simpleString(), bool(f.metadata.get("nullable", f.nullable)), bool(f.metadata.get("is_key", False)), str(f.metadata.get("comment", ""))) for k, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "column_index int, column_name string, data_type string, nullable boolean, is_primary_key boolean, comment string")


def missing_columns(source: list[SourceColumn], have: list[str]) -> list[SourceColumn]:
    """What the replica lacks by name. Nothing is ever dropped or retyped."""
    return [c for c in source if c.name not in have]


def evolved(df: DataFrame, source: list[SourceColumn]) -> DataFrame:
    """df with the columns that it lacks, as NULL."""
    return df.select("*", *[F.lit(None).cast(spark_type(c.type)).alias(c.name) for c in missing_columns(source, df.columns)])


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of either schema; a column that one lacks is NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def table_not_empty(df: DataFrame) -> bool:
    return not df.isEmpty()


def row_count(spark: SparkSession, df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def publication_difference(configured: DataFrame, published: DataFrame) -> DataFrame:
    """The configured (schema_name, table_name) that the publication lacks."""
    return configured.join(published, ["schema_name", "table_name"], "left_anti")


def create_replica(spark: SparkSession, name: str, schema: T.StructType, path: str, comment: str = "") -> None:
    """A Parquet table in the catalog, with the replica's schema and its comment as a property."""
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema, description=comment)


def columns_of_table(spark: SparkSession, name: str) -> DataFrame:
    """The catalog of a table by name; empty for one that is not there."""
    if not spark.catalog.tableExists(name):
        return columns_of(spark.range(0).select())
    return columns_of(spark.table(name))


def comment_of_table(spark: SparkSession, name: str) -> str:
    """Its comment; empty for a table without one, or that is not there."""
    return (spark.catalog.getTable(name).description or "") if spark.catalog.tableExists(name) else ""
