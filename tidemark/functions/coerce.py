"""Coercions of source values to replica types, as column expressions.

A relational cell is text or NULL. Each function returns a typed column without NULLs (the type's
default stands for what can't be read); `null_or_default` brings NULL back where the replica's
column allows it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.types import ReplicaType, spark_type

_INTEGER = r"^\s*[+-]?\d+\s*$"
_REAL = r"(?i)^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)$"
EPOCH = "1970-01-01 00:00:00"


def integer(x: Column) -> Column:
    """A signed or unsigned 64-bit number as decimal(20,0), else 0."""
    value = F.when(x.rlike(_INTEGER), F.regexp_replace(x, r"\s", "").try_cast("decimal(38,0)"))
    inside = value.between(F.lit("-9223372036854775808").cast("decimal(38,0)"), F.lit("18446744073709551615").cast("decimal(38,0)"))
    return F.coalesce(F.when(inside, value), F.lit(0)).cast("decimal(20,0)")


def real(x: Column) -> Column:
    """A double, else 0.0. What only Spark reads (1d, surrounding spaces) is no number."""
    return F.coalesce(F.when(x.rlike(_REAL), x.try_cast("double")), F.lit(0.0))


def boolean(x: Column) -> Column:
    """True for t, 1 and true in any case; else false."""
    return F.coalesce(F.lower(x).isin("t", "1", "true"), F.lit(False))


def string(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def without_fraction(x: Column) -> Column:
    """A timestamp's text up to its fraction and its offset. The offset is dropped, not applied."""
    cut = F.substring_index(F.substring_index(x, ".", 1), "+", 1)
    return F.regexp_replace(cut, r"(\d{2}:\d{2}:\d{2})-\d{2}(:?\d{2})?$", "$1")


def timestamp(x: Column) -> Column:
    """To whole seconds; the epoch for NULL and what can't be read."""
    return F.coalesce(without_fraction(x).try_cast("timestamp_ntz"), F.lit(EPOCH).cast("timestamp_ntz"))


def date(x: Column) -> Column:
    return F.coalesce(F.substring(without_fraction(x), 1, 10).try_cast("date"), F.lit(EPOCH[:10]).cast("date"))


def time(x: Column) -> Column:
    """The time of day as HH:mm:ss; midnight for what can't be read."""
    bare = F.regexp_extract(without_fraction(x), r"(\d{2}:\d{2}:\d{2})$", 1)
    return F.when(F.coalesce(bare, F.lit("")) == "", "00:00:00").otherwise(bare)


def array(x: Column, element: Callable[[Column], Column]) -> Column:
    """{a,b} by commas, each element coerced; NULL and {} are empty."""
    inner = F.regexp_replace(F.coalesce(x, F.lit("")), r"^\{|\}$", "")
    return F.transform(F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, ",", -1)), element)


def string_array(x: Column) -> Column:
    """Elements between quotes: the text is cut at '","'. Without quotes it is one element; NULL and {} give one empty one."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"^[{}]+|[{}]+$", ""), r'^"+|"+$', "")
    return F.split(bare, '","', -1)


def unknown(x: Column) -> Column:
    return string(x)


def sql_escaped(x: Column, lines: bool = True) -> Column:
    """Text for a quoted SQL literal: backslashes and quotes, and where lines are, line ends and NUL."""
    for raw, escaped in (("\\", "\\\\"), ("'", "''"), *((("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0")) if lines else ())):
        x = F.replace(x, F.lit(raw), F.lit(escaped))
    return x


def null_or_default(x: Column, coerced: Column, nullable: bool) -> Column:
    return F.when(x.isNotNull(), coerced) if nullable else coerced


def _scalar(name: str) -> Callable[[Column], Column]:
    if name.startswith(("Int", "UInt")):
        return integer
    if name in ("Float32", "Float64", "Decimal"):
        return real
    if name.startswith("DateTime"):
        return timestamp
    if name.startswith("Date"):
        return date
    if name.startswith("Time"):
        return time
    return {"Bool": boolean}.get(name, string)


def coerce(x: Column, to: ReplicaType) -> Column:
    """A relational cell as a column of the replica's type."""
    if to.element:
        own = string_array(x) if to.element.name == "String" else array(x, lambda e: coerce(e, to.element))
        return own.cast(spark_type(to))
    kind = spark_type(to)
    if to.name == "Decimal":
        coerced = F.coalesce(F.when(x.rlike(_REAL), x.try_cast(kind)), F.lit(0).cast(kind))
    else:
        coerced = F.coalesce(_scalar(to.name)(x).try_cast(kind), F.lit(0).try_cast(kind) if _scalar(to.name) is integer else F.lit(None).cast(kind))
    return null_or_default(x, coerced, to.nullable)
