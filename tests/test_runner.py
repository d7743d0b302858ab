import base64
import json

import pytest

from tidemark import __main__ as command
from tidemark.plans.config import ConfigError, from_dict
from tidemark.plans.runner import DocumentPipe, RelationalPipe, retried
from tidemark.sources.files import DocumentFiles, RelationalFiles

CONNECTION = {"host": "h", "port": 1, "username": "u", "password": "p", "database": "d"}


def config(kind, tables, **target):
    own = {"connection": CONNECTION, ("tables" if kind == "postgres" else "collections"): tables}
    return {"source": {"source_type": kind, kind: own}, "target": {"target_type": "clickhouse", "clickhouse": {"connection": CONNECTION, **target}}}


def cells(*texts):
    return len(texts).to_bytes(2, "big") + b"".join(b"n" if t is None else b"u" if t == "?" else b"t" + len(t.encode()).to_bytes(4, "big") + t.encode() for t in texts)


def head(op, relation):
    return op + relation.to_bytes(4, "big")


@pytest.fixture
def folder(tmp_path):
    own = tmp_path / "source"
    own.mkdir()
    columns = [{"name": "id", "udt": "int8", "nullable": False, "is_key": True}, {"name": "name", "udt": "text"}, {"name": "secret", "udt": "varchar", "nullable": False}]
    (own / "public.users.columns.json").write_text(json.dumps({"relation_id": 7, "columns": columns}))
    (own / "public.users.copy").write_text("1\tann\\tx\ts1\n2\t\\N\ts2\n3\tcy\ts3\n")
    (own / "audit.log.columns.json").write_text(json.dumps({"relation_id": 8, "columns": [{"name": "line", "udt": "text"}]}))
    (own / "audit.log.copy").write_text("first\n")
    changes = [
        b"B" + bytes(20),
        head(b"U", 7) + b"O" + cells("1", "ann", "s1") + b"N" + cells("1", "?", "s9"),
        head(b"D", 7) + b"K" + cells("2", None, None),
        head(b"I", 7) + b"N" + cells("4", "dé", "s4"),
        head(b"I", 99) + b"N" + cells("nowhere"),
        head(b"I", 8) + b"N" + cells("second"),
        head(b"D", 7) + b"K" + cells("4", None, None),
        head(b"I", 7) + b"N" + cells("4", "again", "s5"),
    ]
    with (own / "changes.jsonl").open("w") as f:
        for k, m in enumerate(changes):
            f.write(json.dumps({"seq": k, "lsn": f"0/{k}", "xid": "1", "data": base64.b64encode(m).decode()}) + "\n")
    return own


TABLES = [{"schema_name": "public", "table_name": "users", "mask_columns": ["secret"]}, {"schema_name": "audit", "table_name": "log"}]


def test_relational(spark, folder, tmp_path):
    setup = config("postgres", TABLES) | {"peek_changes_limit": 3}
    pipe = RelationalPipe(spark, from_dict(setup), RelationalFiles(spark, str(folder)), str(tmp_path / "replica"))
    pipe.run()
    users = {tuple(r) for r in pipe.replicas["public.users"].view().collect()}
    assert users == {(1, "ann", ""), (3, "cy", ""), (4, "again", "")}
    assert sorted(r["line"] for r in pipe.replicas["audit.log"].view().collect()) == ["first", "second"]
    assert sum(w["inserts"] for w in pipe.written) == 3 and sum(w["deletes"] for w in pipe.written) == 2
    RelationalPipe(spark, from_dict(setup), RelationalFiles(spark, str(folder)), str(tmp_path / "replica")).run()  # nothing is copied or applied twice
    assert {tuple(r) for r in pipe.replicas["public.users"].view().collect()} == users


def test_disabled_and_skipped(spark, folder, tmp_path):
    tables = [TABLES[0] | {"skip_copy": True}, TABLES[1]]
    pipe = RelationalPipe(spark, from_dict(config("postgres", tables, disable_sync_loop=True)), RelationalFiles(spark, str(folder)), str(tmp_path / "replica"))
    pipe.run()
    assert pipe.replicas["public.users"].view().count() == 0 and pipe.replicas["audit.log"].view().count() == 1


def test_masked_key(spark, folder, tmp_path):
    pipe = RelationalPipe(spark, from_dict(config("postgres", [TABLES[0] | {"mask_columns": ["id"]}])), RelationalFiles(spark, str(folder)), str(tmp_path / "replica"))
    with pytest.raises(ConfigError):
        pipe.run()


def test_documents(spark, tmp_path):
    own = tmp_path / "source"
    (own / "changes").mkdir(parents=True)
    oid = lambda k: {"$oid": f"{k:024x}"}
    (own / "users.jsonl").write_text("\n".join([json.dumps({"_id": oid(1), "name": "ann", "n": {"$numberInt": "1"}, "later": None}), "{broken", json.dumps({"_id": oid(2), "name": {"$numberInt": "3"}, "tags": ["a", "b"], "secret": "x"})]))

    def change(seq, op, collection, key, doc=None):
        return json.dumps({"seq": seq, "operation_type": op, "collection": collection, "document_key": json.dumps({"_id": oid(key)}), "full_document": doc and json.dumps({"_id": oid(key)} | doc)})

    (own / "changes" / "0.json").write_text("\n".join([change(0, "update", "users", 1, {"name": "bea", "later": True}), change(1, "insert", "orders", 1, {"total": {"$numberDouble": "1.5"}}), change(2, "insert", "users", 3, {"name": "cy"})]))
    (own / "changes" / "1.json").write_text("\n".join([change(3, "delete", "users", 2), change(4, "replace", "users", 3, {"n": {"$numberInt": "5"}}), change(5, "insert", "other", 9, {}), change(6, "drop", "users", 1)]))
    setup = from_dict(config("mongodb", [{"collection_name": "users", "mask_columns": ["secret"]}, {"collection_name": "orders"}]))
    pipe = DocumentPipe(spark, setup, DocumentFiles(spark, str(own)), str(tmp_path / "replica"))
    pipe.run()
    rows = {r["_id"][-1]: r for r in pipe.replica("users").view().collect()}
    assert set(rows) == {"1", "3"}
    assert (rows["1"]["name"], rows["1"]["later"], rows["3"]["n"], rows["3"]["name"]) == ("bea", True, 5, None)
    assert pipe.types["users"]["tags"].text() == "Array(String)" and rows["1"]["secret"] is None
    assert [r["total"] for r in pipe.replica("orders").view().collect()] == [1.5]
    again = DocumentPipe(spark, setup, DocumentFiles(spark, str(own)), str(tmp_path / "replica"))
    again.run()
    assert again.types == pipe.types and again.replica("users").view().count() == 2


def test_retried():
    calls = []

    def fails_once():
        calls.append(1)
        if len(calls) == 1:
            raise OSError
        return "done"

    assert retried(fails_once, 1) == "done"
    with pytest.raises(ZeroDivisionError):
        retried(lambda: 1 / 0, 1, times=2)


def test_command(spark, folder, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(config("postgres", TABLES)))
    command.main(["run", "--config-file", str(tmp_path / "c.json"), "--source-dir", str(folder), "--replica-dir", str(tmp_path / "out")])
    assert (tmp_path / "out" / "public.users" / "log").exists()
