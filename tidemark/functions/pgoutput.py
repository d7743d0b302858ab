"""Logical replication messages (big-endian binary), decoded in Arrow batches.

message  I relid 'N' tuple | U relid [('K'|'O') tuple] 'N' tuple | D relid ('K'|'O') tuple
         T count flags relid... | B C O R Y (no change)
tuple    n:u16 then per column 'n' (NULL), 'u' (unchanged), or 't'/'b' with u32 length and bytes

A tuple has no fixed places: each cell starts where the last one ends. Column expressions can only
follow that with a fold that copies what it has for every cell, some 200 microseconds for a message
of four columns and by the square of their number; a loop over the bytes takes a few.
"""

from __future__ import annotations

from collections.abc import Iterator
from struct import unpack_from

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = "array<struct<kind:string,text:string>>"
_WITHOUT_CHANGE = frozenset(b"BCORY")
_CELL = {k: chr(k) for k in b"nutb"}


class _Tuples:
    """A column of tuples, filled cell by cell."""

    def __init__(self):
        self.kinds, self.texts, self.ends, self.missing = [], [], [0], []

    def add(self, data: bytes | None, at: int = 0) -> int:
        """Reads the tuple at a place; returns where it ends. None: there is no tuple."""
        self.missing.append(data is None)
        if data is not None:
            n = unpack_from(">H", data, at)[0]
            at += 2
            for _ in range(n):
                kind = data[at]
                if kind not in _CELL:
                    raise ValueError(f"unknown cell kind {chr(kind)}")
                self.kinds.append(_CELL[kind])
                at += 1
                text = None
                if kind in b"tb":
                    size = unpack_from(">I", data, at)[0]
                    at += 4 + size
                    if at > len(data):
                        raise ValueError("a message ends within a cell")
                    if kind == 0x74:
                        text = data[at - size : at].decode("utf-8", "replace")
                self.texts.append(text)
        self.ends.append(len(self.kinds))
        return at

    def array(self) -> pa.ListArray:
        cells = pa.StructArray.from_arrays([pa.array(self.kinds, pa.string()), pa.array(self.texts, pa.string())], names=["kind", "text"])
        return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), cells, mask=pa.array(self.missing, pa.bool_()))


def _message(data: bytes | None, payload: _Tuples, old: _Tuples) -> tuple[str | None, int | None]:
    """(op, relation) of a message; its tuples go to their columns."""
    if data is None:
        payload.add(None)
        old.add(None)
        return None, None
    if not data:
        raise ValueError("empty message")
    kind = data[0]
    if kind in b"IUD":
        relation, at = unpack_from(">I", data, 1)[0], 6
        if kind == 0x55 and data[5] in b"KO":
            at = old.add(data, at)
            if data[at : at + 1] != b"N":
                raise ValueError("update without a new tuple")
            payload.add(data, at + 1)
        else:
            payload.add(data, at)
            old.add(None)
        return chr(kind), relation
    payload.add(None)
    old.add(None)
    if kind == 0x54:
        if not unpack_from(">I", data, 1)[0]:
            raise ValueError("truncate of no relation")
        return "T", unpack_from(">I", data, 6)[0]
    if kind not in _WITHOUT_CHANGE:
        raise ValueError(f"unknown message type {chr(kind)}")
    return None, None


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payload, old, ops = _Tuples(), _Tuples(), []
        for x in batch.column(0):
            ops.append(_message(x.as_py(), payload, old))
        own = [pa.array([o for o, _ in ops], pa.string()), pa.array([r for _, r in ops], pa.int64()), payload.array(), old.array()]
        yield pa.record_batch([*batch.columns, *own], names=[*batch.schema.names, "op", "relation_id", "payload", "old_values"])


def decode(changes: DataFrame, data: str = "data") -> DataFrame:
    """changes with op (I U D T; NULL for messages without a change), relation_id, payload and old_values.

    An empty message, an unknown type or cell, a truncate of no relation (of several, the first
    counts), a missing tuple or a message that ends too early fails the job.
    """
    rows = changes.select(data, *[c for c in changes.columns if c != data])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    out = rows.mapInArrow(_decode, f"{fields}, op string, relation_id long, payload {CELLS}, old_values {CELLS}")
    return out.select(*changes.columns, "op", "relation_id", "payload", "old_values")


def backfill(payload: Column, old_values: Column) -> Column:
    """Unchanged cells take the old tuple's; NULL where there is none."""
    null = F.struct(F.lit("n").alias("kind"), F.lit(None).cast("string").alias("text"))
    return F.transform(payload, lambda cell, k: F.when(cell["kind"] == "u", F.coalesce(F.get(old_values, k), null)).otherwise(cell))


def u16(x: Column) -> Column:
    return F.unhex(F.lpad(F.hex(x.cast("long")), 4, "0"))


def u32(x: Column) -> Column:
    return F.unhex(F.lpad(F.hex(x.cast("long")), 8, "0"))


def encode_tuple(cells: list[Column], unchanged: dict[int, Column] | None = None) -> Column:
    """The bytes of a tuple of text columns; unchanged: by position, where to send 'u' instead."""
    parts = [u16(F.lit(len(cells)))]
    for k, c in enumerate(cells):
        raw = F.encode(c, "UTF-8")
        sent = F.when(c.isNull(), F.encode(F.lit("n"), "UTF-8")).otherwise(F.concat(F.encode(F.lit("t"), "UTF-8"), u32(F.length(raw)), raw))
        parts.append(F.when((unchanged or {}).get(k, F.lit(False)), F.encode(F.lit("u"), "UTF-8")).otherwise(sent))
    return F.concat(*parts)


def encode_change(op: Column, relation_id: Column, new: Column, old: Column | None = None) -> Column:
    """The bytes of a message: I and U with the new tuple (U with an old one before it if given), D with the old or new one as key, T."""
    char = lambda x: F.encode(F.lit(x), "UTF-8")
    head = F.concat(F.encode(op, "UTF-8"), u32(relation_id))
    update = F.concat(head, char("N"), new) if old is None else F.concat(head, char("O"), old, char("N"), new)
    return (
        F.when(op == "I", F.concat(head, char("N"), new))
        .when(op == "U", update)
        .when(op == "D", F.concat(head, char("K"), new if old is None else old))
        .when(op == "T", F.concat(char("T"), u32(F.lit(1)), F.unhex(F.lit("00")), u32(relation_id)))
        .otherwise(F.encode(op, "UTF-8"))
    )
