"""Benchmark decontamination by size-partitioned MinHash containment search (native).

Which documents hold at least 75 % of a benchmark item's distinct 5-word shingles?

Items are partitioned by their number of shingles m (PARTITIONS), and a partition says how many hits
h a candidate needs. An item's signature is its m - ceil(0.75 m) + h least shingle hashes (a bottom-k
MinHash whose length follows the size). A document that holds 75 % of the item lacks at most
m - ceil(0.75 m) of its shingles, so it holds at least h of the signature: the search loses nothing,
however long the document is, and larger items need more than one shingle in common. Documents'
shingles meet the signatures' (candidates); only candidates' shingles meet all shingles of their
items (exact containment).

The words of documents and items are runs of letters and digits, A-Z lower-cased, so that neither
case nor punctuation hides a copy. An item with fewer than five words is one shingle of its words;
such short shingles are searched only in the lengths that occur among the items.

The signatures (about a quarter of the items' shingles) and the items are broadcast while they have
at most BROADCAST_ROWS rows; beyond that a bitmap of their hashes, of a fixed size, thins out the
documents' shingles before a shuffle join. The candidates' ids are broadcast or joined alike.

Cases: null, empty or wordless texts contain nothing, and such items are in nothing; repeated
documents each get their pairs once; equal items all match; empty tables give an empty result;
other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import OWN, ascii_lower, free, likely_in, materialize, read_table

WIDTH = 5
#: Bound on what is broadcast: 24 bytes a row of signatures or ids.
BROADCAST_ROWS = 500_000
#: Items of so many shingles or more need so many hits of their signature.
PARTITIONS = ((1, 1), (8, 2), (32, 4))


def tokens(text: Column) -> Column:
    """The words: runs of letters and digits; A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def shingles(words: Column, width: int, n: Column) -> Column:
    """The hashes of all runs of width words."""
    return F.when(n >= width, F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))).otherwise(F.array().cast("array<bigint>"))


def _items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, m, hash, place): an item's distinct shingles, by rank of their hash from 1."""
    worded = benchmark.select(F.col(key).alias("item_id"), tokens(F.col(text)).alias("w")).withColumn("n", F.size("w"))
    hashes = F.when(F.col("n") >= WIDTH, F.sort_array(F.array_distinct(shingles(F.col("w"), WIDTH, F.col("n")))))
    for width in range(1, WIDTH):
        hashes = hashes.when(F.col("n") == width, shingles(F.col("w"), width, F.col("n")))
    sets = worded.filter("n > 0").select("item_id", F.least("n", F.lit(WIDTH)).alias("width"), hashes.alias("own"))
    return sets.select("item_id", "width", F.size("own").alias("m"), F.posexplode("own").alias("place", "hash")).withColumn("place", F.col("place") + 1)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", percent: int = 75) -> DataFrame:
    """(key, text_hash, item_id, n_found, n_item, containment): documents that hold percent of an item.

    One row for each distinct (document, item); key and text_hash, the xxhash64 of the text, name the document.
    """
    items = materialize(_items(benchmark, item_key, item_text))
    n_items = items.count()
    widths = sorted({WIDTH, *(r[0] for r in items.select("width").distinct().collect())})  # at most five
    least = F.floor((F.col("m") * percent + 99) / 100).cast("int")
    hits = F.lit(0)
    for size, needed in PARTITIONS:
        hits = F.when(F.col("m") >= size, needed).otherwise(hits)
    signatures = items.withColumn("needed", F.least(hits, least)).filter(F.col("place") <= F.col("m") - least + F.col("needed")).select("hash", "item_id", "needed")

    def met(rows: DataFrame, table: DataFrame) -> DataFrame:
        if n_items > BROADCAST_ROWS:
            return likely_in(rows, F.col("hash"), table, F.col("hash"), n_items).join(table, "hash")
        return rows.join(F.broadcast(table), "hash")

    def hashed(rows: DataFrame) -> DataFrame:
        worded = rows.withColumn("w", tokens(F.col("body"))).withColumn("n", F.size("w"))
        own = [shingles(F.col("w"), width, F.col("n")) for width in widths]
        return worded.select("id", "text_hash", F.explode(F.concat(*own) if len(own) > 1 else own[0]).alias("hash"))

    texts = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("body"))
    hit = met(hashed(texts), signatures).select("id", "text_hash", "item_id", "needed", "hash").distinct()
    hit = hit.groupBy("id", "text_hash", "item_id", "needed").count().filter("count >= needed")
    found = materialize(hit.select("id", "text_hash", "item_id"))
    n_found = found.count()
    names = found.select(F.col("id").alias("its_id"), F.col("text_hash").alias("its_hash")).distinct()
    candidates = texts.join(_small(names, n_found), texts["id"].eqNullSafe(names["its_id"]) & (texts["text_hash"] == names["its_hash"]), "left_semi")
    held = met(hashed(candidates), items.select("hash", "item_id", "m")).select("id", "text_hash", "item_id", "m", "hash").distinct()
    counted = held.groupBy("id", "text_hash", "item_id", "m").agg(F.count("*").alias("n_found"))
    # Pairs that only share other shingles than the signature's can't reach the threshold: the search has proved it.
    exact = counted.filter(F.col("n_found") * 100 >= F.col("m") * percent)
    return exact.select(
        F.col("id").alias(key), "text_hash", "item_id", "n_found", F.col("m").cast("long").alias("n_item"), (F.col("n_found") / F.col("m")).alias("containment")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that hold no benchmark item."""
    found = materialize(leaks(docs, benchmark, key, text).select(F.col(key).alias(f"{OWN}id"), F.col("text_hash").alias(f"{OWN}hash")).distinct())
    found = _small(found, found.count())
    same = docs[key].eqNullSafe(found[f"{OWN}id"]) & (F.xxhash64(docs[text]) == found[f"{OWN}hash"])
    return docs.join(found, same, "left_anti")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "n_found", "n_item", "containment")


ORACLE_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), item_shingles AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS width, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM item_words WHERE len(w) > 0
), sizes AS (
  SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id
), widths AS (
  SELECT DISTINCT width FROM item_shingles
), doc_shingles AS (
  SELECT DISTINCT doc_id, width, unnest([array_to_string(w[i:i + width - 1], ' ') FOR i IN range(1, len(w) - width + 2)]) AS s FROM doc_words, widths WHERE len(w) >= width
), held AS (
  SELECT doc_id, item_id, count(*) AS n_found FROM doc_shingles JOIN item_shingles USING (s, width) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_found, n_item, n_found / n_item AS containment FROM held JOIN sizes USING (item_id) WHERE 100 * n_found >= 75 * n_item
"""
