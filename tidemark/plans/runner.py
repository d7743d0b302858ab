"""Pipes: initialise, copy once, then follow the changes into replicas."""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import documents, pgoutput
from tidemark.functions.coerce import coerce
from tidemark.functions.types import ReplicaType, from_document, spark_type
from tidemark.operators import apply, changelog
from tidemark.operators.projection import SourceColumn, cells_by_name, schema_of, to_replica
from tidemark.plans.config import ConfigError, Configuration, SourceTable
from tidemark.sources.files import DocumentFiles, Source
from tidemark.streaming.replica import Replica


#: More columns than this no collection can have.
MAX_FIELDS = 20_000


def retried(action: Callable, sleep_millis: int, times: int | None = 3):
    """action(), again after a pause when it fails; the last failure is raised. times: None tries without end."""
    tried = 0
    while True:
        try:
            return action()
        except Exception:
            tried += 1
            if tried == times:
                raise
            time.sleep(sleep_millis / 1000)


class Pipe:
    """Copies once, then follows. compact_every: after so many batches a replica's log becomes its base."""

    def __init__(self, spark: SparkSession, config: Configuration, source, path: str, mode: str = "ordered", compact_every: int = 100):
        self.spark, self.config, self.source, self.path, self.mode, self.compact_every = spark, config, source, path.rstrip("/"), mode, compact_every
        self.written: list[dict] = []  # counters of each batch and table
        self.pause = 0.0  # seconds after each table's write
        self.stopped = False

    def _append(self, replica: Replica, rows: DataFrame, batch_id: int) -> None:
        replica.append(rows, batch_id)
        if batch_id - replica.last_compacted() >= self.compact_every:
            replica.compact()
        time.sleep(self.pause)

    def _query(self, options: dict, times: int | None, **trigger) -> StreamingQuery:
        config = self.config
        write = lambda batch, batch_id: retried(lambda: self._write(batch, batch_id), config.sleep_millis_when_write_failed, times)
        changes = self.source.changes(config.peek_changes_limit, timeout_millis=config.peek_changes_timeout_millis, **options)
        writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", f"{self.path}/checkpoint")
        return (writer.trigger(**trigger) if trigger else writer).start()

    def sync(self, available_now: bool = True) -> StreamingQuery | None:
        """Follows the changes: all there are now, or in a query that goes on until it is stopped. None if syncing is disabled."""
        if self.config.target.disable_sync_loop:
            return None
        if not available_now:
            self.pause = self.config.sleep_millis_after_sync_write / 1000
            interval = f"{max(1, self.config.sleep_millis_after_sync_iteration)} milliseconds"
            return self._query({"idle_millis": self.config.sleep_millis_when_peek_is_empty}, None, processingTime=interval)
        query = self._query({}, 3)
        query.processAllAvailable()
        query.stop()
        return query

    def follow(self) -> None:
        """Follows the changes until `stop`: a failed write is tried again without end, a failed read starts the query again."""
        while not self.stopped and not self.config.target.disable_sync_loop:
            query = self.sync(available_now=False)
            try:
                while not self.stopped and not query.awaitTermination(1):
                    pass
            except StreamingQueryException as e:
                print(f"reading changes failed, trying again: {str(e).splitlines()[0]}", file=sys.stderr)
                time.sleep(self.config.sleep_millis_when_peek_failed / 1000)
            finally:
                query.stop()

    def stop(self) -> None:
        self.stopped = True

    def run(self, follow: bool = False) -> None:
        self.initialize()
        self.first_sync()
        if follow:
            self.follow()
        else:
            self.sync()


class RelationalPipe(Pipe):
    """Replicas of relational tables, one folder each below path."""

    def __init__(self, spark: SparkSession, config: Configuration, source: Source, path: str, mode: str = "ordered", compact_every: int = 100):
        super().__init__(spark, config, source, path, mode, compact_every)
        self.columns: dict[str, list[SourceColumn]] = {}
        self.replicas: dict[str, Replica] = {}

    def initialize(self) -> None:
        """Reads the catalog. Columns that were added at the source since the last start are added here."""
        for table in self.config.source.tables:
            own = self.source.columns(table)
            keys = [c.name for c in own if c.is_key]
            if self.mode == "ordered" and set(keys) & set(table.mask_columns):
                raise ConfigError(f"{table.table_name}: a key column can't be masked")
            name = self.name_of(table)
            self.columns[name] = own
            self.replicas[name] = Replica(self.spark, f"{self.path}/{name}", schema_of(own), keys, self.mode)
        self.relations = self.source.relations(self.config.source.tables)

    @staticmethod
    def name_of(table: SourceTable) -> str:
        return f"{table.schema_name}.{table.table_name}"

    def first_sync(self) -> None:
        """Copies each table whose replica is empty, unless it is to be skipped."""
        for table in self.config.source.tables:
            name = self.name_of(table)
            if not table.skip_copy and self.replicas[name].is_empty():
                self.replicas[name].load(to_replica(self.source.snapshot(table), self.columns[name], table.mask_columns), self.config.copy_batch_size)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        decoded = pgoutput.decode(batch).filter("op IS NOT NULL").withColumn("payload", pgoutput.backfill(F.col("payload"), F.col("old_values")))
        routed = changelog.route(decoded, self.relations)[0].withColumn("name", F.concat_ws(".", "schema_name", "table_name")).persist()
        try:
            counted = {r["name"]: r.asDict() for r in changelog.counters(routed, "name").collect()}  # one row a table
            for table in self.config.source.tables:
                name = self.name_of(table)
                if name in counted:  # a batch without rows of a table leaves nothing there
                    self._append(self.replicas[name], self._rows(routed.filter(F.col("name") == name), name, table.mask_columns), batch_id)
            self.written += [x | {"batch_id": batch_id} for x in counted.values()]
        finally:
            routed.unpersist()

    def _rows(self, routed: DataFrame, name: str, masked: tuple[str, ...]) -> DataFrame:
        """The decoded changes of a table as rows of its log. In true log order an update that moves its key deletes the old one."""
        own = self.columns[name]
        keys = [c for c in own if c.is_key] if self.mode == "ordered" else []
        names = [c.name for c in own]
        old = [c.alias(f"old_{k.name}") for c, k in zip(cells_by_name(F.col("old_values"), own, [k.name for k in keys]), keys, strict=True)]
        texts = routed.select("seq", "op", *cells_by_name(F.col("payload"), own, names), *old)
        rows = to_replica(texts, own, masked, carry=("seq", "op", *[f"old_{k.name}" for k in keys]))
        if not keys:
            return rows
        rows = rows.withColumns({f"old_{k.name}": F.when(F.col(f"old_{k.name}").isNotNull(), coerce(F.col(f"old_{k.name}"), k.type)) for k in keys})
        return apply.tombstones_for_moved_keys(rows, [k.name for k in keys]).select("seq", "op", *names)


class DocumentPipe(Pipe):
    """Replicas of document collections: columns appear as typed values do, the first type wins."""

    def __init__(self, spark: SparkSession, config: Configuration, source: DocumentFiles, path: str, mode: str = "ordered", compact_every: int = 100):
        super().__init__(spark, config, source, path, mode, compact_every)
        self.types: dict[str, dict[str, ReplicaType]] = {}

    def _schema_path(self, collection: str) -> str:
        return f"{self.path}/{collection}/schema"

    def _load_types(self, collection: str) -> dict[str, ReplicaType]:
        try:
            last = self.spark.read.schema("n long, types string").parquet(self._schema_path(collection)).orderBy(F.desc("n")).first()
        except AnalysisException:
            last = None
        types = json.loads(last["types"]) if last else {"_id": ["String", False, None]}
        return {k: ReplicaType(name, nullable, ReplicaType(element) if element else None) for k, (name, nullable, element) in types.items()}

    def _evolve(self, collection: str, docs: DataFrame) -> None:
        """Adds a column for each field that has a typed value for the first time. Collects one row a new field.

        A collection keyed by value has no columns: over MAX_FIELDS of them are an error.
        """
        known = self.types[collection]
        have = self.spark.createDataFrame([(n,) for n in known], "name string")
        found = documents.infer_columns(docs).join(F.broadcast(have), "name", "left_anti").orderBy("seq", "name").limit(MAX_FIELDS + 1).collect()
        if len(known) + len(found) > MAX_FIELDS:
            raise ValueError(f"{collection}: over {MAX_FIELDS} fields")
        arrays = [r["name"] for r in found if r["kind"] == "array"]
        elements = self._elements(docs, arrays)
        added = {r["name"]: t for r in found if (t := from_document(r["kind"], r["name"], elements.get(r["name"])))}
        if added:
            known |= added
            text = json.dumps({k: [t.name, t.nullable, t.element.name if t.element else None] for k, t in known.items()})
            self.spark.createDataFrame([(len(known), text)], "n long, types string").coalesce(1).write.mode("append").parquet(self._schema_path(collection))

    def _elements(self, docs: DataFrame, names: list[str]) -> dict[str, str]:
        """The kind of the first element of the first array with any, by name."""
        if not names:
            return {}
        first = lambda n: F.get(documents.field(F.col("doc"), n, "array<variant>"), F.lit(0))
        row = docs.agg(*[F.min_by(documents.kind_of(first(n)), F.when(F.size(documents.field(F.col("doc"), n, "array<variant>")) > 0, F.col("seq"))).alias(n) for n in names]).first()
        return {n: row[n] for n in names if row[n]}

    def _rows(self, collection: str, docs: DataFrame, masked: tuple[str, ...], *carry: str) -> DataFrame:
        return documents.projected(docs, self.types[collection], masked, carry)

    def replica(self, collection: str) -> Replica:
        schema = T.StructType([T.StructField(n, spark_type(t), True, {"is_key": n == "_id"}) for n, t in self.types[collection].items()])
        return Replica(self.spark, f"{self.path}/{collection}", schema, ["_id"], self.mode)

    def initialize(self) -> None:
        for table in self.config.source.tables:
            self.types[table.table_name] = self._load_types(table.table_name)

    def first_sync(self) -> None:
        for table in self.config.source.tables:
            name = table.table_name
            if table.skip_copy or not self.replica(name).is_empty():
                continue
            docs = self.source.snapshot(name).withColumn("seq", F.monotonically_increasing_id())
            self._evolve(name, docs)
            self.replica(name).load(self._rows(name, docs, table.mask_columns), self.config.copy_batch_size)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        names = [t.table_name for t in self.config.source.tables]
        op = F.col("operation_type")
        row = documents.change_to_document(op, documents.parse(F.col("document_key")), documents.parse(F.col("full_document")), self.mode == "ordered")
        changes = changelog.of_collections(batch, names).withColumn("doc", row).filter(F.col("doc").isNotNull())
        changes = changes.withColumn("op", F.when(op == "insert", "I").when(op == "delete", "D").otherwise("U")).persist()
        try:
            counted = {r["collection"]: r.asDict() for r in changelog.counters(changes, "collection").collect()}  # one row a collection
            for table in self.config.source.tables:
                own = changes.filter(F.col("collection") == table.table_name)
                if table.table_name not in counted:
                    continue
                self._evolve(table.table_name, own.filter("op <> 'D'"))
                self._append(self.replica(table.table_name), self._rows(table.table_name, own, table.mask_columns, "seq", "op"), batch_id)
            self.written += [x | {"batch_id": batch_id} for x in counted.values()]
        finally:
            changes.unpersist()
