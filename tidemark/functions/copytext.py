"""COPY TEXT: rows end with a raw line feed, fields with a raw tab, a backslash escapes the next byte."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The letters that stand for control characters after a backslash.
ESCAPES = {"b": 0x08, "f": 0x0C, "n": 0x0A, "r": 0x0D, "t": 0x09, "v": 0x0B}
NULL = b"\\N"


_ESCAPED = re.compile(rb"\\(?:x([0-9A-Fa-f]{1,2})|([0-7]{1,3})|(.))", re.DOTALL)
_LETTERS = {k.encode(): bytes([v]) for k, v in ESCAPES.items()}
#: What `_unescaped` can't do: an escape other than a control letter, a backslash or the NULL mark, or a NUL.
_ODD = r"\\(?:[^bfnrtvN\\]|$)|\x00"


def split_rows(data: bytes) -> list[list[bytes]]:
    """The raw fields of all complete rows; what follows the last line feed is no row."""
    rows, held = [], b""
    for line in data.split(b"\n")[:-1]:
        held += line
        if is_open(held):
            held += b"\n"
            continue
        rows.append(split_fields(held))
        held = b""
    return rows


def is_open(line: bytes) -> bool:
    """Whether a line ends in an odd number of backslashes, so that its line feed is escaped."""
    return (len(line) - len(line.rstrip(b"\\"))) % 2 == 1


def split_fields(row: bytes) -> list[bytes]:
    """The raw fields of a row, cut at tabs that aren't escaped."""
    out: list[bytes] = []
    for part in row.split(b"\t"):
        if out and is_open(out[-1]):
            out[-1] += b"\t" + part
        else:
            out.append(part)
    return out


def _byte(m: re.Match) -> bytes:
    if m[1]:
        return bytes([int(m[1], 16)])
    if m[2]:
        value = int(m[2], 8)
        return bytes([value]) if value <= 255 else m[2]
    return _LETTERS.get(m[3], m[3])


def decode_field(raw: bytes) -> str | None:
    """The text of a raw field; None for the NULL mark. Bytes that aren't UTF-8 become U+FFFD."""
    if raw == NULL:
        return None
    return (_ESCAPED.sub(_byte, raw) if b"\\" in raw else raw).decode("utf-8", "replace")


def _decode_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fields = [[decode_field(f) for f in split_fields(x or b"")] for x in batch.column(0).to_pylist()]
        yield pa.record_batch([pa.array(fields, pa.list_(pa.string())), *batch.columns[1:]], names=["fields", *batch.schema.names[1:]])


def _unescaped(field: Column) -> Column:
    """Control letters, the backslash itself, and an N that isn't alone."""
    out = F.replace(F.replace(field, F.lit("\\\\"), F.lit("\x00")), F.lit("\\N"), F.lit("N"))
    for letter, code in ESCAPES.items():
        out = F.replace(out, F.lit("\\" + letter), F.lit(chr(code)))
    return F.when(field == NULL.decode(), None).otherwise(F.replace(out, F.lit("\x00"), F.lit("\\")))


def decode_lines(lines: DataFrame, line: str = "value", canonical: bool | None = True) -> DataFrame:
    """lines with `fields` (array of strings, NULL for the NULL mark) in place of the raw line, one row each.

    canonical: as servers write it (control characters inside a field always as letters): then built-in
    functions do all. False: bytes are decoded in Arrow batches. None: each line as it needs.
    """
    rest = [c for c in lines.columns if c != line]
    if canonical is None:
        odd = F.coalesce(F.col(line).cast("string").rlike(_ODD), F.lit(False))
        return decode_lines(lines.filter(~odd), line, True).unionByName(decode_lines(lines.filter(odd), line, False))
    if canonical:
        text = F.col(line).cast("string")
        return lines.select(F.transform(F.split(text, "\t", -1), _unescaped).alias("fields"), *rest)
    rows = lines.select(F.col(line).cast("binary").alias(line), *rest)
    others = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(_decode_bytes, "fields array<string>" + others)


#: Parts of a file: a whole row, the first row of a part, a last row that goes on in the next part, both.
_WHOLE, _HEAD, _TAIL = 0, 1, 2


def _rejoin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, file, start, role) of the lines (value, file, start) of parts of files, in their order."""
    held, part, first = b"", None, True
    for batch in batches:
        out = []
        for value, file, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part != (file, start):
                if held:
                    out.append((held, *part, _TAIL | (_HEAD if first else 0)))
                held, part, first = b"", (file, start), True
            held += value
            if is_open(held):
                held += b"\n"
                continue
            out.append((held, file, start, _HEAD if first else _WHOLE))
            held, first = b"", False
        yield _parts(out)
    if held:
        yield _parts([(held, *part, _TAIL | (_HEAD if first else 0))])


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string(), pa.int64(), pa.int32()), strict=True)], names=["value", "file", "start", "role"])


def _ends(table: pa.Table) -> pa.Table:
    """The rows (value) of a file's first and last rows of parts: a last one that goes on takes the next part's first."""
    rows = sorted(table.select(["start", "role", "value"]).to_pylist(), key=lambda r: (r["start"], r["role"] & _TAIL))
    out, held = [], b""
    for r in rows:
        if r["role"] & _HEAD:
            r["value"], held = held + r["value"], b""
        if r["role"] & _TAIL:
            held = r["value"]
        else:
            out.append(r["value"])
    if held:  # a file that ends in a backslash: no line feed is escaped
        out.append(held.removesuffix(b"\n"))
    return pa.table({"value": pa.array(out, pa.binary())})


def whole_rows(lines: DataFrame, line: str = "value") -> DataFrame:
    """Rows (binary value) of the lines of files, where an escaped line feed is part of its row.

    Files without any (as servers write them) take no further step. Otherwise lines are rejoined
    within the parts of files that tasks read, and then, a row or two a part, across them.
    """
    text = F.col(line).cast("string")
    if lines.filter(text.rlike(r"(?<!\\)(?:\\\\)*\\$")).isEmpty():
        return lines.select(F.col(line).alias("value"))
    own = lines.select(F.col(line).cast("binary").alias("value"), F.input_file_name().alias("file"), F.input_file_block_start().alias("start"))
    parts = own.mapInArrow(_rejoin, "value binary, file string, start long, role int")
    return parts.filter(F.col("role") == _WHOLE).select("value").union(parts.filter(F.col("role") != _WHOLE).groupBy("file").applyInArrow(_ends, "value binary"))


def encode_line(columns: list[Column]) -> Column:
    """The canonical line of text columns."""

    def escaped(x: Column) -> Column:
        x = F.replace(x, F.lit("\\"), F.lit("\\\\"))
        for letter, code in ESCAPES.items():
            x = F.replace(x, F.lit(chr(code)), F.lit("\\" + letter))
        return F.coalesce(x, F.lit(NULL.decode()))

    return F.concat_ws("\t", *[escaped(c) for c in columns])
