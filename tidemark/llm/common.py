"""What the training-data operators share: the shared scratch folder and word rules."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Internal columns start with this, so that they cannot meet a column of the input.
OWN = "__tm_"


def scratch_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset: a temporary one on one machine, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        known = context._jsc.sc().getCheckpointDir()
        if known.isDefined():
            root = known.get()
        elif context.master.startswith("local"):
            root = tempfile.mkdtemp(prefix="tidemark-")
            context.setCheckpointDir(root)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


#: The scratch tables that are there, oldest first, by application.
_TABLES: dict[str, list[str]] = {}


def materialize(df: DataFrame) -> DataFrame:
    """Write df as a Parquet table in the shared scratch folder and read it again.

    This cuts the lineage and survives lost executors: the folder is shared, not an executor's own.
    The table stays until `free` or `release` drops it.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tidemark/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder, wherever Spark keeps it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(where, True)


def free(*tables: DataFrame) -> None:
    """Drop tables that `materialize` returned and that nothing reads any more."""
    for df in tables:
        own = _TABLES.get(df.sparkSession.sparkContext.applicationId, [])
        if df._scratch_path in own:
            own.remove(df._scratch_path)
            drop_path(df.sparkSession, df._scratch_path)
    if tables:
        settle(tables[0].sparkSession)


def settle(spark: SparkSession) -> None:
    """Let go of the shuffle files of ended jobs: Spark removes them when the driver's JVM collects what names them."""
    spark.sparkContext._jvm.System.gc()


def mark(spark: SparkSession) -> set[str]:
    """The scratch tables that are there now."""
    return set(_TABLES.get(spark.sparkContext.applicationId, ()))


def mark_of(*tables: DataFrame) -> set[str]:
    return {df._scratch_path for df in tables}


def release(spark: SparkSession, keep: set[str] = frozenset(), needed: DataFrame | None = None) -> None:
    """Drop all scratch tables but those in keep and those that the DataFrame needed still reads."""
    own = _TABLES.get(spark.sparkContext.applicationId, [])
    if any(x not in keep for x in own):
        read = needed.inputFiles() if needed is not None else []
        for path in [x for x in own if x not in keep and not any(f"/tidemark/{x.rsplit('/', 1)[1]}/" in f for f in read)]:
            own.remove(path)
            drop_path(spark, path)
        settle(spark)


#: Two to this power bits of a filter of hashes at most: 16 MB, whatever the input.
FILTER_BITS = 27


def with_likely(rows: DataFrame, hash_of: Column, keys: DataFrame, key_hash: Column, n_keys: int, name: str) -> DataFrame:
    """rows with a boolean column: false where its hash is surely none of those of keys.

    keys become a bitmap, in pieces of 4 kB, that is broadcast: 16 bits a key, up to its largest size.
    """
    size = 1 << min(FILTER_BITS, max(15, (16 * n_keys).bit_length()))
    at = lambda h: F.pmod(h, F.lit(size))
    piece, bit = lambda h: F.shiftright(at(h).cast("long"), 15), lambda h: at(h).cast("long").bitwiseAND(F.lit(32767).cast("long"))
    bits = keys.groupBy(piece(key_hash).alias(f"{OWN}piece")).agg(F.bitmap_construct_agg(bit(key_hash)).alias(f"{OWN}bits"))
    met = rows.withColumn(f"{OWN}piece", piece(hash_of)).withColumn(f"{OWN}bit", bit(hash_of)).join(F.broadcast(bits), f"{OWN}piece", "left")
    byte = F.conv(F.hex(F.substring(f"{OWN}bits", F.shiftright(f"{OWN}bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = met.withColumn(f"{OWN}byte", byte)
    is_set = F.coalesce(F.expr(f"shiftright({OWN}byte, CAST({OWN}bit & 7 AS INT)) & 1 = 1"), F.lit(False))
    return met.withColumn(name, is_set).drop(*[OWN + c for c in ("piece", "bit", "bits", "byte")])


def likely_in(rows: DataFrame, hash_of: Column, keys: DataFrame, key_hash: Column, n_keys: int) -> DataFrame:
    """The rows whose hash is among those of keys, and a few more: before a shuffle join with keys."""
    return with_likely(rows, hash_of, keys, key_hash, n_keys, f"{OWN}likely").filter(f"{OWN}likely").drop(f"{OWN}likely")


def words(text: Column) -> Column:
    """The words of a text, split at white space; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
