"""From source rows to rows of the replica: project by name, mask, coerce."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import coerce
from tidemark.functions.types import ReplicaType, from_udt, spark_type


@dataclass(frozen=True)
class SourceColumn:
    """A column of a relational source. udt: the name of its type."""

    name: str
    udt: str
    nullable: bool = True
    is_key: bool = False
    comment: str = ""

    @property
    def type(self) -> ReplicaType:
        return from_udt(self.udt, self.nullable)


def by_name(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns in order: NULL for those that df has not; others are left out and not read."""
    return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names])


def cells_by_name(cells: Column, source: list[SourceColumn], names: list[str]) -> list[Column]:
    """The texts of decoded cells, for columns of the replica in its order; NULL for what the source has not."""
    place = {c.name: k for k, c in enumerate(source)}
    return [(F.get(cells, F.lit(place[n]))["text"] if n in place else F.lit(None).cast("string")).alias(n) for n in names]


def to_replica(df: DataFrame, columns: list[SourceColumn], masked: tuple[str, ...] = (), carry: tuple[str, ...] = ()) -> DataFrame:
    """df's text columns as typed columns of the replica.

    masked columns are NULL before they are coerced: NULL where the replica allows it, else the
    type's default. They are not read.
    """
    text = lambda c: F.lit(None).cast("string") if c.name in masked or c.name not in df.columns else F.col(c.name)
    return df.select(*carry, *[coerce(text(c), c.type).alias(c.name) for c in columns])


def schema_of(columns: list[SourceColumn]) -> T.StructType:
    """The replica's schema; keys, comments, source types and what may be NULL (which catalogs forget) are metadata."""
    return T.StructType([T.StructField(c.name, spark_type(c.type), c.type.nullable, {"is_key": c.is_key, "nullable": c.type.nullable, "comment": c.comment, "udt": c.udt, "position": k + 1}) for k, c in enumerate(columns)])
