"""Snapshot sources: tables, COPY files, documents; and whether a table is copied at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import copytext, documents
from tidemark.operators.projection import SourceColumn, cells_by_name, to_replica
from tidemark.plans.config import Connection


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jdbc_options(connection: Connection, scheme: str = "postgresql") -> dict[str, str]:
    """The options of a JDBC source for a configured connection."""
    own = {"url": f"jdbc:{scheme}://{connection.host}:{connection.port or 5432}/{connection.database}", "user": connection.username, "password": connection.password}
    own |= {"sslmode": connection.ssl_mode, "ApplicationName": connection.app_name}
    return own | ({"sslrootcert": connection.ssl_root_cert} if connection.ssl_root_cert else {})


def read_jdbc(spark: SparkSession, table: str, column: str | None = None, bounds: tuple[int, int, int] | None = None, **options: str) -> DataFrame:
    """A table (or a query in brackets) over JDBC, in ranges of a numeric column if given. Needs a driver on the class path."""
    reader = spark.read.format("jdbc").options(dbtable=table, **options)
    if column and bounds:
        low, high, parts = bounds
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()


def ping(spark: SparkSession, statement: str = "(SELECT 1 AS one) AS p", **options: str) -> bool:
    """Whether the database answers; what it says instead is raised."""
    return read_jdbc(spark, statement, **options).count() == 1


def estimated_rows(spark: SparkSession, path: str, sample_bytes: int = 1 << 16) -> int:
    """About how many lines files hold: their size over the mean length of the first lines."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.sc().hadoopConfiguration())
    size = store.getContentSummary(where).getLength()
    lines = spark.read.text(path).select(F.octet_length("value").alias("n")).limit(1000).agg(F.count("*"), F.sum(F.col("n") + 1)).first()
    return round(size * lines[0] / lines[1]) if lines[1] else 0


def read_copy_lines(spark: SparkSession, path: str) -> DataFrame:
    """The raw rows of COPY TEXT files; only a line feed that isn't escaped ends a row."""
    return copytext.whole_rows(spark.read.option("lineSep", "\n").text(path))


def named_fields(fields: DataFrame, names: list[str]) -> DataFrame:
    """The fields as columns; a row with another number of fields fails the job."""
    n = F.size("fields")
    wrong = F.when(n != len(names), F.raise_error(F.concat(F.lit(f"a COPY row has not {len(names)} fields but "), n.cast("string"))).cast("string"))
    return fields.select(*[F.coalesce(wrong, F.get("fields", F.lit(k))).alias(c) if not k else F.get("fields", F.lit(k)).alias(c) for k, c in enumerate(names)])


def copied(lines: DataFrame, columns: list[SourceColumn], masked: tuple[str, ...] = (), canonical: bool | None = True, line: str = "value") -> DataFrame:
    """COPY lines as typed rows of the replica."""
    fields = copytext.decode_lines(lines, line, canonical)
    return to_replica(named_fields(fields, [c.name for c in columns]), columns, masked)


def read_documents(lines: DataFrame, line: str = "value") -> DataFrame:
    """doc (VARIANT) for each line; lines that aren't JSON are left out."""
    return lines.withColumn("doc", documents.parse(F.col(line))).filter(F.col("doc").isNotNull()).drop(line)


def decoded_rows(changes: DataFrame, source: list[SourceColumn], names: list[str], *carry: str) -> DataFrame:
    return changes.select(*carry, *cells_by_name(F.col("payload"), source, names))


def initial_copy(snapshot: DataFrame, existing: DataFrame, skip_copy: bool = False) -> DataFrame:
    """The replica's rows after the initial sync: the snapshot, unless it is skipped or there are rows already."""
    return existing if skip_copy or not existing.isEmpty() else snapshot
