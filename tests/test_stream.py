import base64
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import pgoutput
from tidemark.plans.config import ConfigError, from_json
from tidemark.sources.snapshot import decoded_rows
from tidemark.operators.projection import SourceColumn
from tidemark.streaming.changes import read_changes
from tidemark.streaming.replica import Replica, follow

REL = (7).to_bytes(4, "big")
COLUMNS = [SourceColumn("k", "int8", False, True), SourceColumn("v", "text")]


def message(op, *cells):
    body = len(cells).to_bytes(2, "big") + b"".join(b"t" + len(c).to_bytes(4, "big") + c for c in cells)
    return op + REL + (b"K" if op == b"D" else b"N") + body


def write(path, first, messages):
    with path.open("a") as f:
        for k, m in enumerate(messages):
            f.write(json.dumps({"seq": first + k, "lsn": f"0/{first + k}", "xid": "1", "data": base64.b64encode(m).decode()}) + "\n")


def test_stream_stops_and_resumes(spark, tmp_path):
    log = tmp_path / "changes.jsonl"
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
    replica = Replica(spark, str(tmp_path / "replica"), schema, ["k"])

    def prepare(batch):
        return decoded_rows(pgoutput.decode(batch).filter("op IS NOT NULL"), COLUMNS, ["k", "v"], "seq", "op")

    def run():
        query = follow(read_changes(spark, str(log), limit=2), replica, str(tmp_path / "checkpoint"), prepare, available_now=False)
        query.processAllAvailable()
        query.stop()

    write(log, 0, [message(b"I", b"1", b"a"), b"B" + bytes(20), message(b"I", b"2", b"b"), message(b"U", b"1", b"c"), message(b"D", b"2", b"b")])
    run()
    assert {(r["k"], r["v"]) for r in replica.view().collect()} == {("1", "c")}
    write(log, 5, [message(b"I", b"3", b"d")])
    run()
    assert {(r["k"], r["v"]) for r in replica.view().collect()} == {("1", "c"), ("3", "d")}
    assert replica.changes().agg(F.count("*")).first()[0] == 5


def test_config():
    connection = {"host": "h", "port": 1, "username": "u", "password": "p", "database": "d"}
    text = json.dumps({"source": {"source_type": "postgres", "postgres": {"connection": connection, "tables": [{"schema_name": "s", "table_name": "t", "table_options": {"granularity": 1}}]}}, "target": {"target_type": "clickhouse", "clickhouse": {"connection": connection, "table_options": {"storage_policy": "cold", "granularity": 5}}}, "peek_changes_limit": 9})
    config = from_json(text)
    assert (config.peek_changes_limit, config.copy_batch_size, config.source.connection.ssl_mode) == (9, 100000, "disable")
    options = config.options_of(config.source.tables[0])
    assert (options.storage_policy, options.granularity) == ("cold", 1)
    for broken in ("{", "{}", text.replace("postgres", "mysql")):
        with pytest.raises(ConfigError):
            from_json(broken)
