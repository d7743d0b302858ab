"""The queries of the engine's own operators over the driver's tables, each with SQL that says the same independently."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import coerce, copytext, documents, pgoutput
from tidemark.functions.types import ReplicaType, from_udt
from tidemark.operators import apply, changelog, projection, schema
from tidemark.operators.projection import SourceColumn
from tidemark.plans import fixtures as fx
from tidemark.plans.config import Configuration, Connection, Source, SourceTable, Target
from tidemark.plans.pipeline import replica_of
from tidemark.plans.runner import RelationalPipe
from tidemark.sources import snapshot
from tidemark.sources.files import RelationalFiles
from tidemark.sources.scratch import scratch_path
from tidemark.sources.snapshot import read_table
from tidemark.streaming.changes import peek, read_changes
from tidemark.streaming.replica import Replica, follow

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None, name: str | None = None):
    def add(f):
        _QUERIES[name or f.__name__] = f
        if sql is not None:
            _SQL[name or f.__name__] = sql.strip()
        return f

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_ORDERS, _EVENTS, _TEXTS = fx.sql("orders", fx.ORDERS), fx.sql("events", fx.EVENTS), fx.sql("events", fx.TEXTS)
_HALF = "(SELECT max(event_id) // 2 FROM events)"
_CUSTOMER = [
    SourceColumn("c_custkey", "int8", False, True, "the customer's key"),
    SourceColumn("c_name", "varchar", False),
    SourceColumn("c_nationkey", "int4"),
    SourceColumn("c_acctbal", "float8"),
    SourceColumn("c_mktsegment", "text", comment="segment, 'as sold'"),
]
_LINE = [SourceColumn("l_orderkey", "int8", False), SourceColumn("l_partkey", "int8"), SourceColumn("l_linenumber", "int4", False), SourceColumn("l_returnflag", "text"), SourceColumn("l_shipdate", "timestamp")]


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return fx.frame(spark, d, "orders", fx.ORDERS)


def _events(spark: SparkSession, d: str) -> DataFrame:
    return fx.frame(spark, d, "events", fx.EVENTS)


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return fx.frame(spark, d, "events", fx.TEXTS)


def _with_truncate(changes: DataFrame) -> DataFrame:
    """changes with a truncate in the middle of the log."""
    middle = changes.agg(F.max("seq").alias("top")).select(F.floor(F.col("top") / 2).cast("long").alias("seq"))
    cut = middle.select("seq", F.lit(None).cast("long").alias("pk"), F.lit(None).cast("double").alias("v"), F.floor(F.col("seq") / 100).cast("long").alias("batch_id"), F.lit("T").alias("op"))
    return changes.unionByName(cut)


def _config(disable: bool = False) -> Configuration:
    own = Connection("localhost", "user", "password", "replica")
    return Configuration(Source("postgres", own, ()), Target(own, disable_sync_loop=disable))


# Apply


@_query(f"SELECT pk, max(seq) AS seq, arg_max(v, seq) AS v FROM ({_ORDERS}) GROUP BY pk HAVING arg_max(op, seq) <> 'D'")
def cdc_apply_ordered(spark, d):
    return apply.ordered(_orders(spark, d), ["pk"], truncates=False).select("pk", "seq", "v")


@_query(f"SELECT pk, max(seq) AS seq, arg_max(v, seq) AS v FROM ({_EVENTS}) WHERE seq > {_HALF} GROUP BY pk HAVING arg_max(op, seq) <> 'D'")
def apply_truncate(spark, d):
    return apply.ordered(_with_truncate(_events(spark, d)), ["pk"]).select("pk", "seq", "v")


_BATCHWISE = """
WITH fx AS ({fx}), last AS (
  SELECT pk, max(CASE WHEN op <> 'D' THEN batch_id END) AS bi, max(CASE WHEN op = 'D' THEN batch_id END) AS bd,
         max(CASE WHEN op <> 'D' THEN seq END) AS seq FROM fx GROUP BY pk)
SELECT l.pk, l.seq, f.v FROM last l JOIN fx f ON f.pk = l.pk AND f.seq = l.seq WHERE l.bi IS NOT NULL AND (l.bd IS NULL OR l.bi > l.bd){more}
"""


@_query(_BATCHWISE.format(fx=_EVENTS, more=""))
def cdc_apply_reference(spark, d):
    return apply.batchwise(_events(spark, d), ["pk"], ["v"])


@_query(_BATCHWISE.format(fx=_EVENTS, more=f" AND l.bi >= {_HALF} // 100"))
def cdc_apply_reference_truncate(spark, d):
    return apply.batchwise(_with_truncate(_events(spark, d)), ["pk"], ["v"])


@_query(f"SELECT pk, max(seq) AS seq, arg_max(op, seq) AS op, arg_max(v, seq) AS v FROM ({_ORDERS}) GROUP BY pk")
def dedup_keep_last(spark, d):
    return changelog.keep_last(_orders(spark, d), ["pk"]).select("pk", "seq", "op", "v")


@_query(f"SELECT batch_id, max(seq) AS seq, arg_max(op, seq) AS op, arg_max(pk, seq) AS pk FROM ({_EVENTS}) GROUP BY batch_id")
def dedup_no_pk(spark, d):
    """Without a key, a batch collapses to its last row."""
    return changelog.keep_last(_events(spark, d), ["batch_id"]).select("batch_id", "seq", "op", "pk")


@_query(
    f"""SELECT c.c_custkey AS pk, coalesce(x.v, c.c_acctbal) AS v FROM customer c
    LEFT JOIN (SELECT pk, arg_max(v, seq) AS v FROM ({_ORDERS}) WHERE op <> 'D' GROUP BY pk) x ON x.pk = c.c_custkey"""
)
def apply_upsert(spark, d):
    state = read_table(spark, d, "customer").selectExpr("c_custkey AS pk", "c_acctbal AS v")
    rows = changelog.keep_last(_orders(spark, d).filter("op <> 'D'"), ["pk"]).select("pk", "v")
    return apply.upsert(state, rows, ["pk"])


@_query(f"SELECT c_custkey AS pk, c_acctbal AS v FROM customer WHERE c_custkey NOT IN (SELECT pk FROM ({_ORDERS}) WHERE op = 'D')")
def apply_delete(spark, d):
    state = read_table(spark, d, "customer").selectExpr("c_custkey AS pk", "c_acctbal AS v")
    return apply.delete(state, _orders(spark, d).filter("op = 'D'"), ["pk"])


@_query(
    f"""WITH moved AS (SELECT seq * 2 + 1 AS seq, pk, op, v FROM ({_ORDERS}) UNION ALL
      SELECT seq * 2, pk + 1, 'D', v FROM ({_ORDERS}) WHERE op = 'U' AND seq % 3 = 0)
    SELECT pk, max(seq) AS seq, arg_max(v, seq) AS v FROM moved GROUP BY pk HAVING arg_max(op, seq) <> 'D'"""
)
def apply_key_change(spark, d):
    """Updates that change their key delete the old one."""
    changes = _orders(spark, d).withColumn("old_pk", F.expr("CASE WHEN op = 'U' AND seq % 3 = 0 THEN pk + 1 END"))
    return apply.ordered(apply.tombstones_for_moved_keys(changes, ["pk"]), ["pk"], truncates=False).select("pk", "seq", "v")


# Routing and counting

_RELATIONS = "(VALUES (16384, 'public', 'clicks'), (16385, 'public', 'views'), (16386, 'audit', 'views'), (16387, 'public', 'signups'))"


def _relations(spark):
    return spark.sql(f"SELECT CAST(relation_id AS BIGINT) AS relation_id, schema_name, table_name FROM {_RELATIONS} AS r(relation_id, schema_name, table_name)")


def _related(spark, d):
    return read_table(spark, d, "events").selectExpr("event_id", "16384 + event_id % 6 AS relation_id")


@_query(f"SELECT e.event_id, r.schema_name, r.table_name FROM events e JOIN {_RELATIONS} AS r(relation_id, schema_name, table_name) ON r.relation_id = 16384 + e.event_id % 6")
def route_relation(spark, d):
    return changelog.route(_related(spark, d), _relations(spark))[0].select("event_id", "schema_name", "table_name")


@_query("SELECT event_id, 16384 + event_id % 6 AS relation_id FROM events WHERE event_id % 6 > 3")
def route_unknown(spark, d):
    return changelog.route(_related(spark, d), _relations(spark))[1].select("event_id", "relation_id")


@_query(f"SELECT CASE op WHEN 'D' THEN 'delete' ELSE 'upsert' END AS queue, count(*) AS n FROM ({_EVENTS}) GROUP BY 1 UNION ALL SELECT 'truncate', 1")
def op_classify(spark, d):
    return _with_truncate(_events(spark, d)).groupBy(changelog.classify(F.col("op")).alias("queue")).agg(F.count("*").alias("n"))


@_query(
    f"""SELECT 't' || CAST(pk % 7 AS VARCHAR) AS table_name, sum(CASE op WHEN 'I' THEN 1 ELSE 0 END)::BIGINT AS inserts,
    sum(CASE op WHEN 'U' THEN 1 ELSE 0 END)::BIGINT AS updates, sum(CASE op WHEN 'D' THEN 1 ELSE 0 END)::BIGINT AS deletes FROM ({_EVENTS}) GROUP BY 1"""
)
def write_counters(spark, d):
    return changelog.counters(_events(spark, d).withColumn("table_name", F.concat(F.lit("t"), (F.col("pk") % 7).cast("string"))))


@_query(f"SELECT seq, op, pk FROM ({_ORDERS}) WHERE seq > 50 ORDER BY seq LIMIT 100")
def cdc_peek_limit(spark, d):
    return peek(_orders(spark, d), 50, 100).select("seq", "op", "pk")


# Projection and coercion


@_query("SELECT c_mktsegment, CAST(NULL AS VARCHAR) AS c_phone, c_custkey FROM customer")
def project_by_name(spark, d):
    return projection.by_name(read_table(spark, d, "customer"), ["c_mktsegment", "c_phone", "c_custkey"])


@_query("SELECT c_custkey, '' AS c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer")
def mask_columns(spark, d):
    rows = read_table(spark, d, "customer")
    return projection.to_replica(rows.select(*[F.col(c).cast("string") for c in rows.columns]), _CUSTOMER, masked=("c_name", "c_acctbal"))


_INT64 = "CASE WHEN regexp_full_match(trim(x), '[+-]?[0-9]+') THEN coalesce(try_cast(trim(x) AS BIGINT), 0) ELSE 0 END"


_REAL = "CASE WHEN regexp_full_match(x, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN CAST(x AS DOUBLE) ELSE 0.0::DOUBLE END"


@_query(f"SELECT event_id, CASE WHEN x IS NULL THEN NULL ELSE {_REAL} END AS nullable, coalesce({_REAL}, 0) AS filled, x AS text, coalesce(x, '') AS filled_text FROM ({_TEXTS})")
def null_default_rule(spark, d):
    to = lambda name, nullable: coerce.coerce(F.col("x"), ReplicaType(name, nullable))
    return _texts(spark, d).select("event_id", to("Float64", True).alias("nullable"), to("Float64", False).alias("filled"), to("String", True).alias("text"), to("String", False).alias("filled_text"))


@_query(f"SELECT event_id, CASE WHEN x IS NULL THEN NULL ELSE {_INT64} END AS nullable, coalesce({_INT64}, 0) AS filled FROM ({_TEXTS})")
def null_default_every_text(spark, d):
    """The rule for whole numbers: also fractions, words, empty texts and numbers past Int64."""
    return _texts(spark, d).select("event_id", coerce.coerce(F.col("x"), ReplicaType("Int64", True)).alias("nullable"), coerce.coerce(F.col("x"), ReplicaType("Int64")).alias("filled"))


@_query(
    f"""SELECT event_id, CASE WHEN regexp_full_match(trim(x), '[+-]?[0-9]+') AND try_cast(trim(x) AS HUGEINT) BETWEEN -9223372036854775808 AND 18446744073709551615
    THEN CAST(CAST(trim(x) AS HUGEINT) AS VARCHAR) ELSE '0' END AS n FROM ({_TEXTS})"""
)
def coerce_integer(spark, d):
    return _texts(spark, d).select("event_id", coerce.integer(F.col("x")).cast("string").alias("n"))


@_query(f"SELECT event_id, CASE WHEN regexp_full_match(x, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN CAST(x AS DOUBLE) ELSE 0.0::DOUBLE END AS n FROM ({_TEXTS})")
def coerce_real(spark, d):
    return _texts(spark, d).select("event_id", coerce.real(F.col("x")).alias("n"))


@_query(f"SELECT event_id, coalesce(upper(x) IN ('T', '1', 'TRUE'), false) AS b FROM ({_TEXTS})")
def coerce_bool(spark, d):
    return _texts(spark, d).select("event_id", coerce.boolean(F.col("x")).alias("b"))


@_query(f"SELECT event_id, CASE WHEN x IS NULL THEN '' ELSE x END AS s FROM ({_TEXTS})")
def coerce_string(spark, d):
    return _texts(spark, d).select("event_id", coerce.string(F.col("x")).alias("s"))


@_query(f"SELECT event_id, coalesce(x, '') AS vector, x AS shape, coalesce(x, '') AS anything, CAST(NULL AS VARCHAR) AS in_a_document FROM ({_TEXTS})")
def coerce_unknown(spark, d):
    """Types that no map knows: text in a table, nothing in a document."""
    own = lambda udt, nullable: coerce.coerce(F.col("x"), from_udt(udt, nullable))
    value = documents.parse(F.concat(F.lit('{"$other":"'), F.col("x"), F.lit('"}')))
    return _texts(spark, d).select("event_id", own("tsvector", False).alias("vector"), own("polygon", True).alias("shape"), coerce.unknown(F.col("x")).alias("anything"), documents.unknown(value).alias("in_a_document"))


def _times(spark, d):
    full = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    short = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    k = F.col("event_id") % 6
    text = F.when(k == 0, F.concat(full, F.lit("+00"))).when(k == 1, full).when(k == 2, F.concat(short, F.lit("+02"))).when(k == 3, F.concat(short, F.lit("-05"))).when(k == 4, F.lit("never"))
    return read_table(spark, d, "events").select("event_id", text.alias("x"))


@_query("SELECT event_id, CASE WHEN event_id % 6 < 4 THEN date_trunc('second', ts) ELSE TIMESTAMP '1970-01-01 00:00:00' END AS t FROM events")
def coerce_datetime(spark, d):
    return _times(spark, d).select("event_id", coerce.timestamp(F.col("x")).alias("t"))


@_query("SELECT event_id, CASE WHEN event_id % 6 < 4 THEN CAST(ts AS DATE) ELSE DATE '1970-01-01' END AS t FROM events")
def coerce_date(spark, d):
    return _times(spark, d).select("event_id", coerce.date(F.col("x")).alias("t"))


@_query("SELECT event_id, CASE WHEN event_id % 6 < 4 THEN strftime(ts, '%H:%M:%S') ELSE '00:00:00' END AS t FROM events")
def coerce_time(spark, d):
    return _times(spark, d).select("event_id", coerce.time(F.col("x")).alias("t"))


@_query(
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(event_id AS VARCHAR) || '|' || CAST(user_id AS VARCHAR) || '|0' ELSE '' END AS items,
    CASE event_id % 3 WHEN 0 THEN 3 ELSE 0 END AS n FROM events"""
)
def coerce_array(spark, d):
    text = F.expr("CASE event_id % 3 WHEN 0 THEN concat('{', event_id, ',', user_id, ',x}') WHEN 1 THEN '{}' END")
    items = coerce.coerce(text, from_udt("_int8", True))
    return read_table(spark, d, "events").select("event_id", F.array_join(items.cast("array<string>"), "|").alias("items"), F.size(items).alias("n"))


@_query(
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type || '|a, b' WHEN 1 THEN 'a,' || event_type ELSE '' END AS items,
    CASE event_id % 4 WHEN 0 THEN 2 ELSE 1 END AS n FROM events"""
)
def coerce_string_array(spark, d):
    text = F.expr("""CASE event_id % 4 WHEN 0 THEN concat('{"', event_type, '","a, b"}') WHEN 1 THEN concat('{a,', event_type, '}') WHEN 2 THEN '{}' END""")
    items = coerce.coerce(text, from_udt("_text", True))
    return read_table(spark, d, "events").select("event_id", F.array_join(items, "|").alias("items"), F.size(items).alias("n"))


@_query("SELECT doc_id, replace(replace(replace(text, chr(39), chr(39) || chr(39)), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r') || chr(92) || chr(92) || chr(39) || chr(39) AS s FROM documents")
def sql_escape(spark, d):
    return read_table(spark, d, "documents").select("doc_id", coerce.sql_escaped(F.concat("text", F.lit("\\'"))).alias("s"))


# Wire formats


@_query("SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, date_trunc('second', l_shipdate) AS l_shipdate FROM lineitem")
def snapshot_copy(spark, d):
    rows = read_table(spark, d, "lineitem").select(*[(F.date_format(c.name, "yyyy-MM-dd HH:mm:ss.SSSSSS") if c.udt == "timestamp" else F.col(c.name).cast("string")).alias(c.name) for c in _LINE])
    lines = rows.select(copytext.encode_line([F.col(c.name) for c in _LINE]).alias("value"))
    return snapshot.copied(lines, _LINE)


_COPIED = """SELECT doc_id, text || chr(9) || chr(92) || 'N' || chr(39) AS text, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS lang FROM documents"""


def _copied(spark, d, canonical: bool | None):
    rows = read_table(spark, d, "documents").select(F.col("doc_id").cast("string"), F.concat("text", F.lit("\t\\N'")).alias("text"), F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS lang"))
    lines = rows.select(copytext.encode_line([F.col(c) for c in rows.columns]).alias("value"))
    fields = copytext.decode_lines(lines, canonical=canonical)
    return fields.select(F.get("fields", F.lit(0)).cast("long").alias("doc_id"), F.get("fields", F.lit(1)).alias("text"), F.get("fields", F.lit(2)).alias("lang"))


@_query(_COPIED)
def copy_text_decode(spark, d):
    return _copied(spark, d, True)


@_query(_COPIED)
def copy_text_decode_bytes(spark, d):
    return _copied(spark, d, False)


@_query(_COPIED)
def copy_text_decode_mixed(spark, d):
    """Each line by the way that it needs."""
    return _copied(spark, d, None)


@_query(
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'two' || chr(10) || 'lines ' || event_type WHEN 1 THEN 'A' || event_type || 'é' WHEN 2 THEN event_type || chr(9) || 'N' || chr(92)
    WHEN 3 THEN NULL WHEN 4 THEN chr(92) || chr(10) || chr(10) || event_type ELSE event_type || 'q777xZ' END AS text, user_id FROM events"""
)
def copy_text_escapes(spark, d):
    """Files with escapes that no server writes: raw line feeds and tabs after a backslash, octal, hex, others."""
    text = F.expr(
        r"""CASE event_id % 6 WHEN 0 THEN concat('two\\', chr(10), 'lines ', event_type) WHEN 1 THEN concat('\\x41', event_type, '\\303\\xa9') WHEN 2 THEN concat(event_type, '\\', chr(9), '\\N\\\\')
        WHEN 3 THEN '\\N' WHEN 4 THEN concat('\\\\\\', chr(10), '\\n', event_type) ELSE concat(event_type, '\\q\\777\\xZ') END"""
    )
    path = scratch_path(spark, "copy")
    read_table(spark, d, "events").select(F.concat_ws("\t", F.col("event_id").cast("string"), text, F.col("user_id").cast("string"))).write.text(path)
    fields = copytext.decode_lines(snapshot.read_copy_lines(spark, path), canonical=None)
    own = snapshot.named_fields(fields, ["event_id", "text", "user_id"])
    return own.select(F.col("event_id").cast("long").alias("event_id"), "text", F.col("user_id").cast("long").alias("user_id"))


def _messages(spark, d):
    """The orders as messages: inserts, updates with an old tuple and an unchanged status, deletes by key, and commits."""
    rows = read_table(spark, d, "orders")
    key, status, note = F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.concat(F.col("o_orderpriority"), F.lit(" é"))
    op = F.expr("CASE WHEN o_orderkey % 7 = 0 THEN 'C' WHEN o_orderstatus = 'F' THEN 'D' WHEN o_orderstatus = 'O' THEN 'I' ELSE 'U' END")
    nothing = F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("string"))
    new = pgoutput.encode_tuple([key, status, nothing, note], {1: op == "U"})
    old = pgoutput.encode_tuple([key, status, F.lit(None).cast("string"), note])
    data = F.when(op == "U", pgoutput.encode_change(op, F.lit(16384), new, old)).otherwise(pgoutput.encode_change(op, F.lit(16384), new))
    return rows.select(F.col("o_orderkey").alias("seq"), data.alias("data"))


_MESSAGE = """SELECT o_orderkey AS seq, {op} AS op, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 16384 END AS relation_id,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS c1, {c2} AS c2,
  CASE WHEN o_orderkey % 7 <> 0 AND o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS c3,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority || ' é' END AS c4 FROM orders"""
_OP = "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'D' WHEN o_orderstatus = 'O' THEN 'I' ELSE 'U' END"


def _cells(changes, cells):
    return changes.select("seq", "op", "relation_id", *[F.get(cells, F.lit(k))["text"].alias(f"c{k + 1}") for k in range(4)])


@_query(_MESSAGE.format(op=_OP, c2="CASE WHEN o_orderkey % 7 <> 0 AND o_orderstatus <> 'P' THEN o_orderstatus END"))
def pgoutput_decode(spark, d):
    return _cells(pgoutput.decode(_messages(spark, d)), F.col("payload"))


@_query(_MESSAGE.format(op=_OP, c2="CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END"))
def toast_backfill(spark, d):
    return _cells(pgoutput.decode(_messages(spark, d)), pgoutput.backfill(F.col("payload"), F.col("old_values")))


@_query(
    """SELECT o_orderkey AS seq, CAST(o_orderkey AS VARCHAR) || '|' || CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'NULL' END AS k
    FROM orders WHERE o_orderkey % 7 <> 0"""
)
def key_extraction(spark, d):
    changes = pgoutput.decode(_messages(spark, d)).filter("op IS NOT NULL")
    return changes.select("seq", changelog.key_of(F.col("payload"), [1, 3]).alias("k"))


def _write_log(messages: DataFrame, path: str) -> None:
    """A log of messages (seq, data) as a folder of JSON lines in the order of seq."""
    lines = F.to_json(F.struct("seq", F.concat(F.lit("0/"), F.col("seq").cast("string")).alias("lsn"), F.lit("1").alias("xid"), F.base64("data").alias("data")))
    messages.repartitionByRange(4, "seq").sortWithinPartitions("seq").select(lines).write.text(path)


@_query(f"SELECT CAST(o_orderkey AS VARCHAR) AS k, {_OP} AS op, o_orderpriority || ' é' AS note FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderstatus <> 'F'")
def cdc_stream_log(spark, d):
    """A log read as a stream, a third of it a batch, each from where the last ended."""
    path, rows = scratch_path(spark, "log"), _messages(spark, d)
    _write_log(rows, f"{path}/log")
    names = T.StructType([T.StructField(n, T.StringType()) for n in ("k", "note")])
    replica = Replica(spark, f"{path}/replica", names, ["k"])

    def decoded(batch: DataFrame) -> DataFrame:
        cells = F.col("payload")
        return pgoutput.decode(batch).filter("op IS NOT NULL").select("seq", "op", F.get(cells, F.lit(0))["text"].alias("k"), F.get(cells, F.lit(3))["text"].alias("note"))

    query = follow(read_changes(spark, f"{path}/log", 1 + rows.count() // 3, timeout_millis=60_000), replica, f"{path}/checkpoint", decoded, available_now=False)
    query.processAllAvailable()
    query.stop()
    return apply.ordered(replica.changes(), ["k"], truncates=False).select("k", "op", "note")


_MOVED = 10_000_000


@_query(
    f"""WITH cut AS (SELECT max(o_orderkey) // 2 AS t FROM orders), log AS (
      SELECT -1 AS seq, c_custkey AS k, c_acctbal AS v, 'I' AS op FROM customer
      UNION ALL SELECT 2 * o_orderkey + 1, CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + {_MOVED} ELSE o_custkey END, o_totalprice, CASE WHEN o_orderkey % 11 <> 0 AND o_orderstatus = 'F' THEN 'D' ELSE 'U' END FROM orders, cut WHERE o_orderkey <> t
      UNION ALL SELECT 2 * o_orderkey, o_custkey, 0, 'D' FROM orders, cut WHERE o_orderkey % 11 = 0 AND o_orderkey <> t)
    SELECT k, arg_max(v, seq) AS v, '' AS secret FROM log, cut WHERE seq > 2 * t + 1 GROUP BY k HAVING arg_max(op, seq) <> 'D'"""
)
def pipe_end_to_end(spark, d):
    """From wire bytes to the view: a snapshot file, a log with moved keys and a truncate, batches, compaction, and the pipe once more."""
    path = scratch_path(spark, "pipe")
    columns = [{"name": "k", "udt": "int8", "nullable": False, "is_key": True}, {"name": "v", "udt": "float8", "nullable": False}, {"name": "secret", "udt": "text", "nullable": False}]
    described = json.dumps({"relation_id": 7, "columns": columns, "comment": "balances"})
    spark.createDataFrame([(described,)], "value string").coalesce(1).write.text(f"{path}/public.balance.columns.json")
    customer = read_table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("k"), F.col("c_acctbal").cast("string").alias("v"), F.col("c_name").alias("secret"))
    customer.select(copytext.encode_line([F.col(c) for c in customer.columns])).write.text(f"{path}/public.balance.copy")

    rows = read_table(spark, d, "orders").crossJoin(read_table(spark, d, "orders").agg(F.floor(F.max("o_orderkey") / 2).alias("t")))
    moves = F.col("o_orderkey") % 11 == 0
    op = F.when(F.col("o_orderkey") == F.col("t"), "T").when(moves, "U").when(F.col("o_orderstatus") == "F", "D").when(F.col("o_orderstatus") == "O", "I").otherwise("U")
    key = lambda more: (F.col("o_custkey") + more).cast("string")
    new = pgoutput.encode_tuple([key(F.when(moves, _MOVED).otherwise(0)), F.col("o_totalprice").cast("string"), F.lit("s")], {2: op == "U"})
    old = pgoutput.encode_tuple([key(F.lit(0)), F.lit("0"), F.lit("hidden")])
    data = F.when(moves, pgoutput.encode_change(op, F.lit(7), new, old)).otherwise(pgoutput.encode_change(op, F.lit(7), new))
    _write_log(rows.select(F.col("o_orderkey").alias("seq"), data.alias("data")), f"{path}/changes.jsonl")

    table = SourceTable("balance", "public", mask_columns=("secret",))
    own = Connection("localhost", "user", "password", "replica")
    config = Configuration(Source("postgres", own, (table,)), Target(own), peek_changes_limit=1 + rows.count() // 3, peek_changes_timeout_millis=60_000)
    for _ in range(2):  # the second has nothing left to do
        pipe = RelationalPipe(spark, config, RelationalFiles(spark, path), f"{path}/replica", compact_every=2)
        pipe.run()
    return pipe.replicas["public.balance"].view()


# Documents


def _documents(spark, d):
    text = F.expr(
        """concat('{"_id":{"$oid":"', lpad(lower(hex(event_id)), 24, '0'), '"},"kind":"', event_type, '","n":{"$numberInt":"', user_id, '"},"big":{"$numberLong":"', event_id * 10000000000, '"},"half":{"$numberDouble":"', user_id, '.5"},
        "ok":', event_id % 2 = 0, ',"none":null,"at":{"$date":{"$numberLong":"', event_id * 86400000, '"}},"inner":{"a":1},"bin":{"$binary":{"base64":"AQID","subType":"00"}},"tags":["a",{"$numberInt":"7"},"', event_type, '"]}')"""
    )
    return read_table(spark, d, "events").select(F.col("event_id").alias("seq"), "event_type", text.alias("value"))


@_query("SELECT event_id AS seq, format('{:024x}', event_id) AS _id, event_type AS kind FROM events WHERE event_id % 10 <> 3")
def doc_snapshot(spark, d):
    lines = _documents(spark, d).withColumn("value", F.expr("CASE WHEN seq % 10 = 3 THEN concat('{', value) ELSE value END"))
    docs = snapshot.read_documents(lines)
    return docs.select("seq", documents.field(F.col("doc"), "_id", "variant").alias("i"), documents.field(F.col("doc"), "kind", "string").alias("kind")).select("seq", documents.to_string(F.col("i")).alias("_id"), "kind")


@_query(
    """SELECT event_id AS seq, event_type AS kind, user_id::INT AS n, event_id * 10000000000 AS big, user_id + 0.5::DOUBLE AS half, event_id % 2 = 0 AS ok, CAST(NULL AS VARCHAR) AS none,
    TIMESTAMP '1970-01-01 00:00:00' + to_days(event_id::INT) AS at, 'a|' || event_type AS tags, CAST(NULL AS INT) AS absent FROM events"""
)
def doc_project(spark, d):
    types = {"kind": "String", "n": "Int32", "big": "Int64", "half": "Float64", "ok": "Bool", "none": "String", "at": "DateTime", "absent": "Int32"}
    columns = {n: ReplicaType(t, True) for n, t in types.items()} | {"tags": ReplicaType("Array", element=ReplicaType("String"))}
    docs = documents.projected(snapshot.read_documents(_documents(spark, d)), columns, carry=("seq",))
    return docs.withColumn("tags", F.array_join("tags", "|"))


@_query(
    '''SELECT event_id AS seq, user_id AS "it's", event_type AS "a ""quoted"" name", event_type AS "both ' and """, CASE WHEN event_id % 2 = 0 THEN event_id END AS "$.['x']", 'e' AS blank FROM events'''
)
def doc_odd_names(spark, d):
    """Fields of any name: quotes, dots, brackets, none at all."""
    kinds = {"it's": "Int64", 'a "quoted" name': "String", "both ' and \"": "String", "$.['x']": "Int64", "": "String"}
    kind = F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    cells = [F.expr("""concat('{"$numberLong":"', user_id, '"}')"""), kind, kind, F.expr("CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS STRING) ELSE 'null' END"), F.lit('"e"')]
    text = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(json.dumps(k) + ":"), c) for k, c in zip(kinds, cells, strict=True)]), F.lit("}"))
    docs = read_table(spark, d, "events").select(F.col("event_id").alias("seq"), documents.parse(text).alias("doc"))
    return documents.projected(docs, {n: ReplicaType(t, True) for n, t in kinds.items()}, carry=("seq",)).withColumnRenamed("", "blank")


@_query(
    """SELECT event_id AS seq, format('{:024x}', event_id) AS id, event_type AS kind, ' ' AS n, strftime(TIMESTAMP '1970-01-01 00:00:00' + to_days(event_id::INT), '%Y-%m-%d %H:%M:%S') AS at,
    ' ' AS "inner", 'AQID' AS bin, ' ' AS ok FROM events"""
)
def doc_to_string(spark, d):
    names = {"id": "_id"} | {n: n for n in ("kind", "n", "at", "inner", "bin", "ok")}
    docs = documents.typed(snapshot.read_documents(_documents(spark, d)), list(names.values()))
    return docs.select("seq", *[documents.to_string(F.col(f"__v{k}"), F.col(f"__k{k}")).alias(n) for k, n in enumerate(names)])


@_query("SELECT event_id AS seq, 'it''''s ' || chr(92) || chr(92) || ' ' || event_type || chr(10) AS s FROM events")
def doc_escape(spark, d):
    """A document's text for a quoted SQL literal."""
    text = F.concat(F.lit('{"v":"' + r"it's \\ "), F.col("event_type"), F.lit(r'\n"}'))
    docs = read_table(spark, d, "events").select(F.col("event_id").alias("seq"), documents.parse(text).alias("doc"))
    return docs.select("seq", documents.escaped(documents.field(F.col("doc"), "v")).alias("s"))


@_query(
    """SELECT event_id AS seq, event_type AS op, CASE event_type WHEN 'click' THEN 'full' WHEN 'view' THEN 'full' WHEN 'purchase' THEN 'full' WHEN 'error' THEN 'key' END AS which FROM events"""
)
def doc_change_to_row(spark, d):
    op = F.expr("CASE event_type WHEN 'click' THEN 'insert' WHEN 'view' THEN 'update' WHEN 'purchase' THEN 'replace' WHEN 'error' THEN 'delete' ELSE 'invalidate' END")
    row = documents.change_to_document(op, documents.parse(F.lit('{"w":"key"}')), documents.parse(F.lit('{"w":"full"}')))
    return read_table(spark, d, "events").select(F.col("event_id").alias("seq"), F.col("event_type").alias("op"), documents.field(row, "w", "string").alias("which"))


@_query("SELECT event_type AS collection, count(*) AS n, max(event_id) AS last FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1")
def doc_cdc_route(spark, d):
    changes = read_table(spark, d, "events").select(F.col("event_type").alias("collection"), "event_id")
    return changelog.of_collections(changes, ["click", "purchase"]).groupBy("collection").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))


@_query(
    """SELECT event_type AS name, arg_min(CASE WHEN event_id % 2 = 0 THEN 'int' ELSE 'string' END, event_id) AS kind, min(event_id) AS seq
    FROM events WHERE event_id % 5 <> 0 GROUP BY 1"""
)
def doc_infer_schema(spark, d):
    """The first typed value of a field decides; nulls (every fifth) decide nothing."""
    text = F.expr("""concat('{"', event_type, '":', CASE WHEN event_id % 5 = 0 THEN 'null' WHEN event_id % 2 = 0 THEN '{"$numberInt":"1"}' ELSE '"x"' END, '}')""")
    docs = read_table(spark, d, "events").select(F.col("event_id").alias("seq"), documents.parse(text).alias("doc"))
    return documents.infer_columns(docs)


# Catalog and schema


@_query(
    """SELECT 'orders' AS table_name, ordinal_position::INT AS column_index, column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS data_type,
    true AS nullable, false AS is_primary_key, '' AS comment FROM information_schema.columns WHERE table_name = 'orders'
    UNION ALL SELECT * FROM (VALUES ('replica', 1, 'c_custkey', 'bigint', false, true, 'the customer''s key'), ('replica', 2, 'c_name', 'string', false, false, ''), ('replica', 3, 'c_nationkey', 'int', true, false, ''),
    ('replica', 4, 'c_acctbal', 'double', true, false, ''), ('replica', 5, 'c_mktsegment', 'string', true, false, 'segment, ''as sold\'\''))""".replace("\\'\\'", "''")
)
def catalog_columns(spark, d):
    """The columns of a source table, and of a replica in the catalog; a table that is not there has none."""
    name = "tidemark_" + uuid.uuid4().hex
    schema.create_replica(spark, name, projection.schema_of(_CUSTOMER), scratch_path(spark, "catalog"), "customers")
    replica = schema.columns_of_table(spark, name)
    spark.sql(f"DROP TABLE {name}")
    none = schema.columns_of_table(spark, name)
    source = schema.columns_of(read_table(spark, d, "orders"))
    return source.select(F.lit("orders").alias("table_name"), "*").unionByName(replica.unionByName(none).select(F.lit("replica").alias("table_name"), "*"))


@_query("SELECT 'it''s all customers' AS comment UNION ALL SELECT ''")
def table_comment(spark, d):
    name = "tidemark_" + uuid.uuid4().hex
    schema.create_replica(spark, name, projection.schema_of(_CUSTOMER), scratch_path(spark, "comment"), "it's all customers")
    rows = [(schema.comment_of_table(spark, name),)]
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame([*rows, (schema.comment_of_table(spark, name),)], "comment string")


@_query("SELECT count(*) AS n, true AS close FROM customer")
def row_estimate(spark, d):
    """The estimate of a file's rows, from its size, is near their number."""
    rows = read_table(spark, d, "customer")
    path = scratch_path(spark, "estimate")
    rows.select(copytext.encode_line([F.col(c).cast("string") for c in rows.columns])).write.text(path)
    about = snapshot.estimated_rows(spark, path)
    return rows.agg(F.count("*").alias("n")).select("n", (F.abs(F.col("n") - about) <= 0.1 * F.col("n")).alias("close"))


@_query("SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, d):
    return schema.row_count(spark, read_table(spark, d, "lineitem"))


@_query("SELECT 'nation' AS table_name, (SELECT count(*) FROM nation) > 0 AS not_empty UNION ALL SELECT 'none', (SELECT count(*) FROM nation WHERE n_nationkey < 0) > 0")
def table_not_empty(spark, d):
    nation = read_table(spark, d, "nation")
    rows = [("nation", schema.table_not_empty(nation)), ("none", schema.table_not_empty(nation.filter("n_nationkey < 0")))]
    return spark.createDataFrame(rows, "table_name string, not_empty boolean")


@_query(
    """SELECT 'CREATE TABLE replica.customer(' || string_agg('`' || name || '` ' || type || ' COMMENT ''' || comment || '''', ', ' || chr(10) ORDER BY place) || ') ENGINE = ReplacingMergeTree()' || chr(10) ||
    'ORDER BY (c_custkey)' || chr(10) || 'SETTINGS' || chr(10) || 'index_granularity = 1024' || chr(10) || ', min_age_to_force_merge_seconds = 60' || chr(10) || ', storage_policy = ''hot''''s''' || chr(10) || 'COMMENT ''it''''s all''' || chr(10) || ';' AS statement
    FROM (VALUES (1, 'c_custkey', 'Int64', 'the customer"s key'), (2, 'c_name', 'String', ''), (3, 'c_nationkey', 'Nullable(Int32)', ''), (4, 'c_acctbal', 'Nullable(Float64)', ''),
    (5, 'c_mktsegment', 'Nullable(String)', 'segment, "as sold"')) AS c(place, name, type, comment)"""
)
def ddl_create(spark, d):
    text = schema.create_table_text("replica", "customer", _CUSTOMER, schema.TableOptions("hot's", 1024), "it's all")
    return spark.createDataFrame([(text,)], "statement string")


@_query("SELECT 'ALTER TABLE replica.customer ADD COLUMN `c_tags` Array(String) COMMENT '''';' AS statement")
def ddl_add_column(spark, d):
    have = read_table(spark, d, "customer").columns
    missing = schema.missing_columns([*_CUSTOMER, SourceColumn("c_tags", "_text")], have)
    return spark.createDataFrame([(schema.add_column_text("replica", "customer", c),) for c in missing], "statement string")


@_query("SELECT n_nationkey, n_name, CASE WHEN n_nationkey < 10 THEN NULL ELSE n_regionkey END AS n_regionkey FROM nation")
def evolve_add_column(spark, d):
    """Rows from before a column was added are NULL there."""
    nation = read_table(spark, d, "nation")
    old = nation.filter("n_nationkey < 10").select("n_nationkey", "n_name")
    source = [SourceColumn("n_nationkey", "int4"), SourceColumn("n_name", "text"), SourceColumn("n_regionkey", "int4")]
    return schema.union_evolved(schema.evolved(old, source), nation.filter("n_nationkey >= 10"))


@_query(
    """SELECT t.name, coalesce(t.policy, 'cold') AS storage_policy, coalesce(t.granularity, 4096) AS granularity, t.age AS min_age
    FROM (VALUES ('a', NULL, 1024, NULL), ('b', 'hot', NULL, 30), ('c', NULL, NULL, NULL)) AS t(name, policy, granularity, age)"""
)
def option_inherit(spark, d):
    parent = schema.TableOptions("cold", 4096, 99)
    own = {"a": schema.TableOptions(None, 1024), "b": schema.TableOptions("hot", None, 30), "c": schema.TableOptions()}
    rows = [(k, o.storage_policy, o.granularity, o.min_age_to_force_merge_seconds) for k, v in own.items() for o in [v.inherit(parent)]]
    return spark.createDataFrame(rows, "name string, storage_policy string, granularity int, min_age int")


@_query("SELECT 'public' AS schema_name, n_name AS table_name FROM nation WHERE n_nationkey % 3 <> 0")
def publication_diff(spark, d):
    nation = read_table(spark, d, "nation").select(F.lit("public").alias("schema_name"), F.col("n_name").alias("table_name"), "n_nationkey")
    return schema.publication_difference(nation.drop("n_nationkey"), nation.filter("n_nationkey % 3 = 0").drop("n_nationkey"))


@_query("SELECT * FROM (VALUES ('copy_batch_size', 100000), ('peek_changes_limit', 65536), ('peek_changes_timeout_millis', 5000), ('sleep_millis_after_sync_iteration', 100), ('sleep_millis_after_sync_write', 100), ('sleep_millis_when_peek_failed', 5000), ('sleep_millis_when_peek_is_empty', 5000), ('sleep_millis_when_write_failed', 5000)) AS c(name, value)")
def config_defaults(spark, d):
    config = _config()
    names = [n for n in config.__dataclass_fields__ if n not in ("source", "target")]
    return spark.createDataFrame([(n, getattr(config, n)) for n in sorted(names)], "name string, value int")


# Whole pipelines


def _customers(spark, d):
    return read_table(spark, d, "customer").selectExpr("c_custkey AS pk", "c_acctbal AS v")


_NONE = T.StructType([T.StructField("pk", T.LongType()), T.StructField("v", T.DoubleType())])


@_query(
    f"""WITH log AS (SELECT c_custkey AS pk, c_acctbal AS v, -1 AS seq, 'I' AS op FROM customer UNION ALL SELECT pk, v, seq, op FROM ({_ORDERS}))
    SELECT pk, arg_max(v, seq) AS v FROM log GROUP BY pk HAVING arg_max(op, seq) <> 'D'"""
)
def snapshot_and_follow(spark, d):
    return replica_of(_customers(spark, d), spark.createDataFrame([], _NONE), _orders(spark, d), ["pk"], SourceTable("customer", "public"), _config())


@_query("SELECT c_custkey AS pk, c_acctbal AS v FROM customer")
def skip_sync(spark, d):
    return replica_of(_customers(spark, d), spark.createDataFrame([], _NONE), _orders(spark, d), ["pk"], SourceTable("customer", "public"), _config(disable=True))


@_query(f"SELECT pk, arg_max(v, seq) AS v FROM ({_ORDERS}) GROUP BY pk HAVING arg_max(op, seq) <> 'D'")
def skip_copy(spark, d):
    return replica_of(_customers(spark, d), spark.createDataFrame([], _NONE), _orders(spark, d), ["pk"], SourceTable("customer", "public", skip_copy=True), _config())


@_query("SELECT c_custkey AS pk, c_acctbal AS v FROM customer WHERE c_custkey < 20")
def skip_nonempty(spark, d):
    """A replica that has rows is not copied again."""
    have = _customers(spark, d).filter("pk < 20")
    return replica_of(_customers(spark, d), have, _orders(spark, d), ["pk"], SourceTable("customer", "public"), _config(disable=True))


@_query(f"SELECT pk, arg_max(v, seq) AS v FROM ({_ORDERS}) GROUP BY pk HAVING arg_max(op, seq) <> 'D'")
def cdc_replay_idempotent(spark, d):
    """A stream of files in micro-batches into a replica; then some batches again, as after a failure, and a compaction."""
    changes = _orders(spark, d).drop("batch_id")
    path = scratch_path(spark, "replay")
    changes.repartitionByRange(4, "seq").write.parquet(f"{path}/in")
    replica = Replica(spark, f"{path}/replica", T.StructType([*_NONE.fields]), ["pk"])
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    follow(stream, replica, f"{path}/checkpoint").awaitTermination()
    again = replica.spark.read.schema(replica.log_schema).parquet(f"{path}/replica/log/batch_id=1")
    replica.append(_copy(again, f"{path}/again"), 1)  # a batch can't be written from itself
    replica.compact()
    return replica.view()


def _copy(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
