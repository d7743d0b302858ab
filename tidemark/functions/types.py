"""Type maps: source column types to replica types, and these to Spark types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ReplicaType:
    """A type of the replica. name: its text without wrappers; element: of an Array; nullable: wrapped."""

    name: str
    nullable: bool = False
    element: ReplicaType | None = None

    def text(self) -> str:
        inner = f"Array({self.element.text()})" if self.element else self.name
        return f"Nullable({inner})" if self.nullable else inner

    def as_nullable(self) -> ReplicaType:
        return ReplicaType(self.name, True, self.element)


def array_of(element: ReplicaType) -> ReplicaType:
    return ReplicaType("Array", element=element)


#: Relational type names and the replica types they become.
UDT_TYPES = {
    "int2": "Int16",
    "int4": "Int32",
    "int": "Int32",
    "int8": "Int64",
    "float4": "Float32",
    "float8": "Float64",
    "numeric": "Decimal",
    "varchar": "String",
    "text": "String",
    "json": "String",
    "jsonb": "String",
    "bool": "Bool",
    "timestamp": "DateTime",
    "timestamptz": "DateTime",
    "date": "Date",
}
#: Relational types that also have an array form, named with a leading underscore.
ARRAY_UDTS = ("int2", "int4", "int8", "float4", "float8", "numeric", "varchar", "text", "bool")


def from_udt(udt: str, nullable: bool) -> ReplicaType:
    """Unknown types are kept as text. Arrays are never nullable: NULL becomes the empty array."""
    if udt.startswith("_") and udt[1:] in ARRAY_UDTS:
        return array_of(ReplicaType(UDT_TYPES[udt[1:]]))
    return ReplicaType(UDT_TYPES.get(udt, "String"), nullable)


#: Document value types (as in Extended JSON) and the replica types they become.
DOCUMENT_TYPES = {
    "string": "String",
    "document": "String",
    "binary": "String",
    "regex": "String",
    "code": "String",
    "symbol": "String",
    "minKey": "String",
    "maxKey": "String",
    "dbPointer": "String",
    "objectId": "String",
    "bool": "Bool",
    "int": "Int32",
    "long": "Int64",
    "double": "Float64",
    "decimal": "Decimal",
    "date": "DateTime",
    "timestamp": "DateTime",
}


def from_document(kind: str, column: str = "", element: str | None = None) -> ReplicaType | None:
    """None defers the column: null and undefined values, and arrays without a typed first element."""
    if kind == "array":
        inner = DOCUMENT_TYPES.get(element or "")
        return array_of(ReplicaType(inner)) if inner else None
    if kind not in DOCUMENT_TYPES:
        return None
    return ReplicaType(DOCUMENT_TYPES[kind], nullable=not (kind == "objectId" and column == "_id"))


#: Replica types and the Spark types that hold all their values.
SPARK_TYPES: dict[str, T.DataType] = {
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "Int128": T.DecimalType(38, 0),
    "Int256": T.StringType(),
    "UInt8": T.ShortType(),
    "UInt16": T.IntegerType(),
    "UInt32": T.LongType(),
    "UInt64": T.DecimalType(20, 0),
    "UInt128": T.DecimalType(38, 0),
    "UInt256": T.StringType(),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "Bool": T.BooleanType(),
    "String": T.StringType(),
    "UUID": T.StringType(),
    "Decimal": T.DecimalType(38, 18),
    "Date": T.DateType(),
    "Date32": T.DateType(),
    "DateTime": T.TimestampNTZType(),
    "Time": T.StringType(),
}


def spark_type(t: ReplicaType) -> T.DataType:
    if t.element:
        return T.ArrayType(spark_type(t.element), True)
    name = t.name.split("(")[0]
    return SPARK_TYPES.get({"FixedString": "String", "DateTime64": "DateTime", "Time64": "Time"}.get(name, name), T.StringType())
