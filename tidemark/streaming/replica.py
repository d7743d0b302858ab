"""A replica on Parquet: a log of micro-batches, a base, and the view of the latest rows.

Every batch is a directory named by its id, so that writing it again after a failure replaces it
(at-least-once delivery, idempotent effect). The view is the closed form over base and log.
`compact` writes a new base and then a new version entry; nothing that is being read is overwritten,
and a view of the version before it can still be read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import apply
from tidemark.operators.changelog import snapshot_as_changes


class Replica:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], mode: str = "ordered"):
        """schema: the value and key columns of the table. mode: ordered or batchwise."""
        self.spark, self.path, self.schema, self.keys, self.mode = spark, path.rstrip("/"), schema, keys, mode
        self.log_schema = T.StructType([*schema.fields, T.StructField("seq", T.LongType()), T.StructField("op", T.StringType())])

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Columns that the batch lacks are NULL."""
        have = {f.name for f in batch.schema}
        rows = batch.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.log_schema])
        rows.write.mode("overwrite").parquet(f"{self.path}/log/batch_id={batch_id}")

    def load(self, snapshot: DataFrame, rows_a_file: int = 0) -> None:
        """The initial copy, before all batches. rows_a_file: at most so many in one file; 0 for no bound."""
        self._write_base(snapshot.select(*self.schema.names), -1, rows_a_file)

    def is_empty(self) -> bool:
        """Whether the view has no row; files are only read where there are any."""
        _, base, _ = self._version()
        return base is None and not self._exists(f"{self.path}/log") or self.view().isEmpty()

    def _exists(self, path: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.sc().hadoopConfiguration()).exists(where)

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.sc().hadoopConfiguration()).delete(where, True)

    def last_compacted(self) -> int:
        """The last batch that the base holds; -1 without any."""
        return max(-1, self._version()[2])

    def _versions(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("version long, base string, upto long").parquet(f"{self.path}/versions")
        except AnalysisException:
            return None

    def _version(self) -> tuple[int, str | None, int]:
        """(version, path of the base, last batch in it); of few version rows the last."""
        versions = self._versions()
        last = versions.orderBy(F.desc("version")).first() if versions is not None else None
        return (0, None, -2) if last is None else (last["version"], last["base"], last["upto"])

    def _write_base(self, rows: DataFrame, upto: int, rows_a_file: int = 0) -> None:
        version = self._version()[0] + 1
        base = f"{self.path}/base/{version}"
        rows.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).parquet(base)
        self.spark.createDataFrame([(version, base, upto)], "version long, base string, upto long").coalesce(1).write.mode("append").parquet(f"{self.path}/versions")

    def changes(self) -> DataFrame:
        """The base as a snapshot, and all later batches."""
        _, base, upto = self._version()
        full = T.StructType([*self.log_schema.fields, T.StructField("batch_id", T.LongType())])
        try:
            log = self.spark.read.schema(full).option("basePath", f"{self.path}/log").parquet(f"{self.path}/log").filter(F.col("batch_id") > upto)
        except AnalysisException:
            log = self.spark.createDataFrame([], full)
        if base is None:
            return log
        rows = self.spark.read.schema(self.schema).parquet(base)
        return snapshot_as_changes(rows).select(*full.names).unionByName(log)

    def view(self) -> DataFrame:
        names = self.schema.names
        if self.mode == "ordered":
            return apply.ordered(self.changes(), self.keys).select(*names)
        return apply.batchwise(self.changes(), self.keys, [n for n in names if n not in self.keys]).select(*names)

    def compact(self) -> None:
        """A new base of what the view shows now. Bases and batches that only older versions but the last one read go."""
        version, base, upto = self._version()
        done = self.changes().agg(F.max("batch_id")).first()[0]
        self._write_base(self.view(), -1 if done is None else max(done, upto))
        if version > 1:
            self._delete(f"{self.path}/base/{version - 1}")
        if upto >= 0:
            batches = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
            store = batches.getFileSystem(self.spark._jsc.sc().hadoopConfiguration())
            for x in store.listStatus(batches) if store.exists(batches) else []:
                name = x.getPath().getName()
                if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= upto:
                    store.delete(x.getPath(), True)


def follow(changes: DataFrame, replica: Replica, checkpoint: str, prepare=None, available_now: bool = True, interval: str = "100 milliseconds") -> StreamingQuery:
    """Starts the stream that appends each micro-batch (after prepare) to the replica's log.

    The checkpoint's offsets advance after the write: a batch that fails is written again whole.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replica.append(prepare(batch) if prepare else batch, batch_id)

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
