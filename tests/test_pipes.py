"""What pipes promise beyond one run: moved keys, compaction, retries, following; JDBC against an embedded database."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_runner import TABLES, cells, config, head

from tidemark.operators import apply
from tidemark.operators.projection import SourceColumn
from tidemark.plans.config import Connection, from_dict
from tidemark.plans.runner import DocumentPipe, RelationalPipe, retried
from tidemark.sources import snapshot
from tidemark.sources.files import DocumentFiles, RelationalFiles
from tidemark.streaming.changes import Log
from tidemark.streaming.replica import Replica

import base64


def write(path, first, messages, mode="a"):
    with path.open(mode) as f:
        for k, m in enumerate(messages):
            f.write(json.dumps({"seq": first + k, "lsn": "0/1", "xid": "1", "data": base64.b64encode(m).decode()}) + "\n")


@pytest.fixture
def folder(tmp_path):
    own = tmp_path / "source"
    own.mkdir()
    columns = [{"name": "id", "udt": "int8", "nullable": False, "is_key": True}, {"name": "name", "udt": "text"}, {"name": "secret", "udt": "varchar", "nullable": False}]
    (own / "public.users.columns.json").write_text(json.dumps({"relation_id": 7, "columns": columns, "comment": "people"}))
    (own / "public.users.copy").write_text("1\tann\ts\n2\tbo\ts\n")
    (own / "audit.log.columns.json").write_text(json.dumps({"relation_id": 8, "columns": [{"name": "line", "udt": "text"}]}))
    (own / "audit.log.copy").write_text("first\\\nline\n")
    (own / "changes.jsonl").write_text("")
    return own


def pipe_of(spark, folder, path, **more):
    compact = more.pop("compact_every", 100)
    return RelationalPipe(spark, from_dict(config("postgres", TABLES) | more), RelationalFiles(spark, str(folder)), str(path), compact_every=compact)


def names(pipe):
    return {(r["id"], r["name"]) for r in pipe.replicas["public.users"].view().collect()}


def test_moved_keys_truncate_and_compaction(spark, folder, tmp_path):
    insert = lambda k, n: head(b"I", 7) + b"N" + cells(str(k), n, "s")
    move = lambda a, b, n: head(b"U", 7) + b"K" + cells(str(a), None, None) + b"N" + cells(str(b), n, "s")
    write(folder / "changes.jsonl", 0, [insert(5, "eve"), move(5, 6, "eve"), move(6, 6, "Eve"), move(1, 9, "ann")])
    pipe = pipe_of(spark, folder, tmp_path / "out", peek_changes_limit=1, compact_every=2)
    pipe.run()
    assert names(pipe) == {(2, "bo"), (6, "Eve"), (9, "ann")}
    assert [r["line"] for r in pipe.replicas["audit.log"].view().collect()] == ["first\nline"]
    assert pipe.replicas["public.users"].last_compacted() == 3
    logs = {x.name for x in (tmp_path / "out" / "public.users" / "log").iterdir() if x.name.startswith("batch")}
    assert logs == {"batch_id=2", "batch_id=3"}  # what only older versions read is gone
    assert not (tmp_path / "out" / "audit.log" / "log").exists()  # no rows, no files
    truncate = b"T" + (1).to_bytes(4, "big") + b"\0" + (7).to_bytes(4, "big")
    write(folder / "changes.jsonl", 4, [truncate, insert(1, "new")])
    again = pipe_of(spark, folder, tmp_path / "out", peek_changes_limit=5)
    again.run()
    assert names(again) == {(1, "new")}


def test_a_batch_that_is_tried_again_counts_once(spark, folder, tmp_path, monkeypatch):
    write(folder / "changes.jsonl", 0, [head(b"I", 7) + b"N" + cells("3", "cy", "s"), head(b"I", 8) + b"N" + cells("second")])
    pipe = pipe_of(spark, folder, tmp_path / "out", sleep_millis_when_write_failed=1)
    plain, failed = Replica.append, []

    def fails_once(self, batch, batch_id):
        if self.path.endswith("audit.log") and not failed:
            failed.append(1)
            raise OSError("disk")
        plain(self, batch, batch_id)

    monkeypatch.setattr(Replica, "append", fails_once)
    pipe.run()
    assert failed and sorted((w["name"], w["inserts"]) for w in pipe.written) == [("audit.log", 1), ("public.users", 1)]
    assert names(pipe) == {(1, "ann"), (2, "bo"), (3, "cy")}


def test_retried_without_end():
    calls = []

    def fails_often():
        calls.append(1)
        if len(calls) < 9:
            raise OSError
        return "done"

    assert retried(fails_often, 0, times=None) == "done"


@pytest.mark.parametrize("kind", ["postgres", "mongodb"])
def test_follow(spark, folder, tmp_path, kind):
    """Changes that come while the pipe runs arrive; stop() ends it."""
    waits = {"sleep_millis_when_peek_is_empty": 20, "sleep_millis_after_sync_iteration": 20, "sleep_millis_after_sync_write": 1}
    if kind == "postgres":
        pipe = pipe_of(spark, folder, tmp_path / "out", **waits)
        add = lambda: write(folder / "changes.jsonl", 0, [head(b"I", 7) + b"N" + cells("3", "cy", "s")])
        arrived = lambda: "public.users" in pipe.replicas and (3, "cy") in names(pipe)
    else:
        (folder / "changes").mkdir()
        pipe = DocumentPipe(spark, from_dict(config("mongodb", [{"collection_name": "users"}]) | waits), DocumentFiles(spark, str(folder)), str(tmp_path / "out"))
        line = {"seq": 1, "operation_type": "insert", "collection": "users", "document_key": "{}", "full_document": json.dumps({"_id": "x", "it's": "odd"})}
        add = lambda: (folder / "changes" / "1.json").write_text(json.dumps(line))
        arrived = lambda: "users" in pipe.types and "it's" in pipe.types["users"] and pipe.replica("users").view().count() == 1
    runs = threading.Thread(target=pipe.run, kwargs={"follow": True})
    runs.start()
    try:
        time.sleep(3)
        add()
        until = time.monotonic() + 60
        while not arrived() and time.monotonic() < until:
            time.sleep(0.5)
        assert arrived()
    finally:
        pipe.stop()
        runs.join(60)
    assert not runs.is_alive()


def test_log_offsets(tmp_path):
    path = tmp_path / "log"
    path.write_text("a\nbb\nccc\nd")
    log = Log(str(path))
    one = log.advance({"file": "", "byte": 0}, 1, 1000)
    assert one == {"file": "log", "byte": 2}
    rest = log.advance(one, 9, 1000)
    assert rest == {"file": "log", "byte": 9}  # the last line is still being written
    assert log.ranges(one, rest) == [(str(path), 2, 9)]
    assert Log(str(tmp_path / "none")).advance(one, 9, 1000) == one
    many = tmp_path / "many"
    many.mkdir()
    (many / "1").write_text("x\ny")
    (many / "2").write_text("z\n" * 5)
    log = Log(str(many))
    at = log.advance({"file": "", "byte": 0}, 4, 1000)
    assert at == {"file": "2", "byte": 4} and log.ranges({"file": "1", "byte": 2}, at) == [(str(many / "1"), 2, 3), (str(many / "2"), 0, 4)]


def test_null_keys(spark):
    state = spark.createDataFrame([(None, 1), (1, 2)], "k long, v long")
    rows = spark.createDataFrame([(None, 3)], "k long, v long")
    assert sorted(map(tuple, apply.upsert(state, rows, ["k"]).collect()), key=repr) == [(1, 2), (None, 3)]
    assert [tuple(r) for r in apply.delete(state, rows, ["k"]).collect()] == [(1, 2)]


def test_jdbc(spark):
    """Tables, ranges and the ping, in the database that comes with Spark."""
    derby = {"url": "jdbc:derby:memory:tidemark;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.range(20).select("id", (F.col("id") * 2).alias("v")).write.format("jdbc").options(dbtable="T1", **derby).save()
    got = snapshot.read_jdbc(spark, "T1", "id", (0, 20, 3), **derby)
    assert got.rdd.getNumPartitions() == 3 and {tuple(r) for r in got.collect()} == {(k, 2 * k) for k in range(20)}
    assert snapshot.ping(spark, "(VALUES 1) AS p(one)", **derby)
    own = Connection("h", "u", "p", "d", 5433, "require", "/ca.pem")
    assert snapshot.jdbc_options(own) == {"url": "jdbc:postgresql://h:5433/d", "user": "u", "password": "p", "sslmode": "require", "ApplicationName": "tidemark", "sslrootcert": "/ca.pem"}


def test_replica_is_empty(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "r"), T.StructType([T.StructField("k", T.LongType())]), ["k"])
    assert replica.is_empty()
    replica.load(spark.range(0).withColumnRenamed("id", "k"))
    assert replica.is_empty()
    replica.load(spark.range(5).withColumnRenamed("id", "k"), 2)
    assert not replica.is_empty() and replica.view().count() == 5
    assert SourceColumn("a", "int4").type.text() == "Nullable(Int32)"
