"""Documents as canonical Extended JSON: VARIANT values with explicit types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.coerce import sql_escaped
from tidemark.functions.types import ReplicaType, spark_type

#: Extended JSON keys that wrap a typed value.
WRAPPERS = {
    "$oid": "objectId",
    "$numberInt": "int",
    "$numberLong": "long",
    "$numberDouble": "double",
    "$numberDecimal": "decimal",
    "$date": "date",
    "$timestamp": "timestamp",
    "$binary": "binary",
    "$regularExpression": "regex",
    "$code": "code",
    "$symbol": "symbol",
    "$minKey": "minKey",
    "$maxKey": "maxKey",
    "$dbPointer": "dbPointer",
    "$undefined": "undefined",
}


def parse(text: Column) -> Column:
    """A VARIANT; NULL for what isn't JSON."""
    return F.try_parse_json(text)


def field(doc: Column, name: str, kind: str = "variant") -> Column:
    """A top-level field; any name."""
    if "'" in name and '"' in name:  # no path can quote it
        value = F.element_at(F.try_variant_get(doc, "$", "map<string,variant>"), name)
        return value if kind == "variant" else F.try_variant_get(value, "$", kind)
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(doc, f"$[{quote}{name}{quote}]", kind)


def kind_of(value: Column) -> Column:
    """The type of a document value: a wrapper's, or string, bool, array, document, null, and for bare numbers long or double.

    Read once: the value's shape, which names an object's first key.
    """
    shape = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    kinds = F.create_map(*[F.lit(x) for pair in WRAPPERS.items() for x in pair], *[F.lit(x) for pair in _PLAIN.items() for x in pair])
    key = F.regexp_extract(shape, r"^(?:OBJECT<`?(?=\$))?(\$?[A-Za-z]+)", 1)
    return F.coalesce(F.element_at(kinds, key), F.lit("document"))


#: The first word of a shape, of values that no wrapper types.
_PLAIN = {"VOID": "null", "STRING": "string", "BOOLEAN": "bool", "BIGINT": "long", "DECIMAL": "double", "DOUBLE": "double", "FLOAT": "double", "ARRAY": "array"}


def change_to_document(op: Column, key: Column, full: Column, replace_is_update: bool = True) -> Column:
    """Deletes carry their key, inserts and updates the full document; other operations nothing."""
    updates = ["insert", "update", "replace"] if replace_is_update else ["insert", "update"]
    return F.when(op == "delete", key).when(op.isin(*updates), full)


def _utc(seconds: Column) -> Column:
    """The text of a time in UTC, whatever the session's zone. Years after 9999 have no sign; what a timestamp can't hold is the epoch."""
    held = F.when(F.abs(seconds) >= 86400 * _DAYS, 0).otherwise(seconds)
    days = F.floor(held / 86400)
    of_day = (held - days * 86400).cast("decimal(18,6)")
    at = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), of_day)
    return F.ltrim(at.cast("string"), F.lit("+"))


#: Days that a timestamp holds on either side of the epoch.
_DAYS = 106_751_991


def to_string(value: Column, kind: Column | None = None) -> Column:
    """Text of a document value: ObjectId as hex, dates in UTC to the second, binary as base64, strings; one space for the rest."""
    seconds = lambda millis: _utc(F.floor(millis / 1000))
    kind = kind_of(value) if kind is None else kind
    return (
        F.when(kind == "string", F.try_variant_get(value, "$", "string"))
        .when(kind == "objectId", F.try_variant_get(value, "$['$oid']", "string"))
        .when(kind == "date", seconds(F.coalesce(F.try_variant_get(value, "$['$date']['$numberLong']", "long"), F.try_variant_get(value, "$['$date']", "long"))))
        .when(kind == "timestamp", seconds(F.try_variant_get(value, "$['$timestamp'].t", "long") * 1000))
        .when(kind == "binary", F.try_variant_get(value, "$['$binary'].base64", "string"))
        .otherwise(" ")
    )


def escaped(value: Column) -> Column:
    """The text of a document value for a quoted SQL literal: backslashes and quotes only."""
    return sql_escaped(to_string(value), lines=False)


def unknown(value: Column) -> Column:
    """A value for a column of no known type."""
    return F.when(value.isNull(), F.lit(None).cast("string"))


def coerce(value: Column, kind: Column, to: ReplicaType) -> Column:
    """A document value of a known kind as a column of the replica's type; absent and null give NULL or the default."""
    if to.element:
        items = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))
        if to.element.name == "String":
            return F.transform(F.filter(items, lambda v: F.schema_of_variant(v) == "STRING"), lambda v: F.try_variant_get(v, "$", "string"))
        keys = ("$numberInt", "$numberLong") if to.element.name.startswith("Int") else ("$numberDouble", "$numberDecimal")
        cast = "long" if to.element.name.startswith("Int") else "double"
        return F.transform(items, lambda v: F.coalesce(*[F.try_variant_get(v, f"$['{k}']", "string").try_cast(cast) for k in keys], F.try_variant_get(v, "$", "string").try_cast(cast), F.lit(0).cast(cast)))
    number = lambda kinds, cast: F.coalesce(*[F.try_variant_get(value, f"$['{k}']", "string").try_cast(cast) for k in kinds], F.try_variant_get(value, "$", "string").try_cast(cast))
    if to.name.startswith("Int"):
        own = F.coalesce(F.when(kind.isin("int", "long", "decimal"), number(("$numberInt", "$numberLong", "$numberDecimal"), "long")), F.lit(0).cast("long"))
    elif to.name in ("Float64", "Decimal"):
        own = F.coalesce(F.when(kind.isin("double", "decimal"), number(("$numberDouble", "$numberDecimal"), "double")), F.lit(0.0))
    elif to.name == "Bool":
        own = F.coalesce(F.when(kind == "bool", F.try_variant_get(value, "$", "boolean")), F.lit(False))
    elif to.name == "DateTime":
        own = F.coalesce(F.when(kind == "date", to_string(value, kind)).try_cast("timestamp_ntz"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    else:
        own = to_string(value, kind)
    return F.when(~kind.isin("null", "undefined"), own) if to.nullable else own


def typed(docs: DataFrame, names: list[str], doc: str = "doc") -> DataFrame:
    """docs with columns __v0, __k0, ... : the value and the kind of each named field, each worked out once."""
    values = docs.select("*", *[field(F.col(doc), n).alias(f"__v{k}") for k, n in enumerate(names)])
    return values.select("*", *[kind_of(F.col(f"__v{k}")).alias(f"__k{k}") for k in range(len(names))])


def projected(docs: DataFrame, columns: dict[str, ReplicaType], masked: tuple[str, ...] = (), carry: tuple[str, ...] = (), doc: str = "doc") -> DataFrame:
    """The named fields as columns of the replica's types, after those to carry. Masked ones are NULL or the default, and not read."""
    names = [n for n in columns if n not in masked]
    rows, place = typed(docs, names, doc), {n: k for k, n in enumerate(names)}
    none = F.lit(None).cast("variant"), F.lit("null")
    cell = lambda n, t: coerce(*((F.col(f"__v{place[n]}"), F.col(f"__k{place[n]}")) if n in place else none), t)
    return rows.select(*carry, *[cell(n, t).cast(spark_type(t)).alias(n) for n, t in columns.items()])


def infer_columns(docs: DataFrame, doc: str = "doc", order: str = "seq") -> DataFrame:
    """(name, kind, seq): for each top-level field the type of its first value that has one, and where that is.

    One aggregate over the exploded fields, combined before its shuffle.
    """
    fields = docs.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col(doc).outer()))
    typed = fields.select(F.col("key").alias("name"), F.col(order).alias("seq"), kind_of(F.col("value")).alias("kind")).filter(~F.col("kind").isin("null", "undefined"))
    return typed.groupBy("name").agg(F.min_by("kind", "seq").alias("kind"), F.min("seq").alias("seq"))
