"""Configuration: JSON to dataclasses, with every default."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from typing import Any

from tidemark.operators.schema import TableOptions

SSL_MODES = ("disable", "prefer", "require", "verify-ca", "verify-full")


class ConfigError(ValueError):
    """A configuration that can't be used."""


def _build(cls: type, given: dict[str, Any], where: str):
    known = {f.name: f for f in fields(cls)}
    try:
        return cls(**{k: v for k, v in given.items() if k in known})
    except TypeError as e:
        raise ConfigError(f"{where}: {e}") from None


@dataclass(frozen=True)
class Connection:
    host: str
    username: str
    password: str
    database: str
    port: int = 0
    ssl_mode: str = "disable"
    ssl_root_cert: str | None = None
    app_name: str = "tidemark"

    def __post_init__(self):
        if self.ssl_mode not in SSL_MODES:
            raise ConfigError(f"ssl_mode {self.ssl_mode!r} is none of {SSL_MODES}")


@dataclass(frozen=True)
class SourceTable:
    """A relational table (schema and name) or a document collection (name only)."""

    table_name: str
    schema_name: str = ""
    skip_copy: bool = False
    mask_columns: tuple[str, ...] = ()
    table_options: TableOptions = field(default_factory=TableOptions)


@dataclass(frozen=True)
class Source:
    source_type: str
    connection: Connection
    tables: tuple[SourceTable, ...]
    publication_name: str = "tidemark_publication"
    replication_slot_name: str = "tidemark_slot"
    resume_token_path: str = "resume_token.json"
    resume_token_storage: str = "file"
    copy_batch_size: int = 1000
    peek_timeout_millis: int = 5000


@dataclass(frozen=True)
class Target:
    connection: Connection
    disable_sync_loop: bool = False
    table_options: TableOptions = field(default_factory=TableOptions)


@dataclass(frozen=True)
class Configuration:
    source: Source
    target: Target
    sleep_millis_when_peek_failed: int = 5000
    sleep_millis_when_peek_is_empty: int = 5000
    sleep_millis_when_write_failed: int = 5000
    sleep_millis_after_sync_iteration: int = 100
    sleep_millis_after_sync_write: int = 100
    peek_changes_limit: int = 65536
    peek_changes_timeout_millis: int = 5000
    copy_batch_size: int = 100000

    def options_of(self, table: SourceTable) -> TableOptions:
        return table.table_options.inherit(self.target.table_options)


def _options(given: dict | None) -> TableOptions:
    return _build(TableOptions, given or {}, "table_options")


def _table(given: dict, kind: str) -> SourceTable:
    own = dict(given)
    if kind == "mongodb":
        own["table_name"] = own.pop("collection_name", None)
    if not own.get("table_name") or kind == "postgres" and not own.get("schema_name"):
        raise ConfigError("a table needs its name")
    return _build(SourceTable, own | {"mask_columns": tuple(own.get("mask_columns", ())), "table_options": _options(own.get("table_options"))}, "table")


def from_dict(given: dict[str, Any]) -> Configuration:
    try:
        source, target = given["source"], given["target"]
        kind = source["source_type"]
        if kind not in ("postgres", "mongodb"):
            raise ConfigError(f"unknown source_type {kind!r}")
        own = source[kind]
        tables = tuple(_table(t, kind) for t in own["tables" if kind == "postgres" else "collections"])
        store = target[target.get("target_type", "clickhouse")]
        return _build(
            Configuration,
            {k: v for k, v in given.items() if k not in ("source", "target")}
            | {
                "source": _build(Source, own | {"source_type": kind, "connection": _build(Connection, own["connection"], "source connection"), "tables": tables}, "source"),
                "target": _build(Target, store | {"connection": _build(Connection, store["connection"], "target connection"), "table_options": _options(store.get("table_options"))}, "target"),
            },
            "configuration",
        )
    except KeyError as e:
        raise ConfigError(f"missing {e.args[0]!r}") from None


def from_json(text: str) -> Configuration:
    try:
        return from_dict(json.loads(text))
    except json.JSONDecodeError as e:
        raise ConfigError(f"no JSON: {e}") from None
