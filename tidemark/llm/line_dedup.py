"""Line dedup by content-defined chunks (native).

A text's lines are cut into chunks where the lines themselves say so. A rolling hash over the hashes
of two lines (shifted and XORed) ends a chunk where its low bits are zero; a line that is a passage
of its own (over PASSAGE words) is a chunk of its own. A boundary depends on nearby lines only, so
inserted or lost lines elsewhere in a text do not shift it, and a passage gets the same chunks in
every document.

A passage of a few lines may share no chunk with its copy, so passages are found by windows too,
which depend on nothing but their own lines: from each line with words the fewest lines with over
PASSAGE words, and the fewest such that end there. Each line of a passage of over PASSAGE words that
stands twice is in a window inside of it, so all of its lines are found, whatever is around it. What
overlaps its own first occurrence is no repetition. Below, windows are treated as chunks are.

A chunk counts if it has MIN_LINES lines with words or more, or over PASSAGE words.

Chunks with one hash are counted over all documents. Those that repeat are compared with their first
occurrence (least id, text hash, place): line hash by line hash, and for each line hash in them the
bytes of all lines of all texts that have it. What is equal is removed, the first occurrence stays.

Shuffles: counts, combined before the shuffle; the places of repeated chunks (a bitmap of their
hashes, of a fixed size, is sent to the others), where those of one chunk are dealt over many tasks;
the lines in repeated chunks, each once a task; and the places of removed lines back to the
documents (a broadcast of BROADCAST_ROWS places at most; beyond it a shuffle of the documents that
lose lines, and a bitmap of these for the others).

Cases: null and empty texts have no chunk and stay as they are; lines without words never count but
belong to the chunk around them; a text whose chunks are all removed becomes empty (`clean` drops
it, `deduplicate` shows it); rows of the same id and text are one document, and each shows its
result; an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import OWN, SPACE, free, likely_in, mark, mark_of, materialize, read_table, release, with_likely

BOUNDARY_BITS = 3  # a boundary where r & 3 == 0: four lines a chunk
MIN_LINES = 2
#: More words than this are a passage.
PASSAGE = 50
#: So many rows of one chunk share a task's copy of what joins them.
FAN = 1_000
BROADCAST_ROWS = 500_000


def _n_words(line: Column) -> Column:
    return F.size(F.array_remove(F.split(line, SPACE), ""))


def chunked(rows: DataFrame, text: str) -> DataFrame:
    """rows with a column OWN + 'chunks': an array of (first, last, lines, words, hash, cut, seq: the hashes of its lines) of each text's chunks, and its windows (cut is false)."""
    p = OWN
    cut = rows.withColumn(f"{p}line", F.split(F.col(text), "\n"))
    line = F.col(f"{p}line")
    cut = cut.withColumn(f"{p}n", F.transform(line, _n_words)).withColumn(f"{p}h", F.transform(line, lambda x: F.xxhash64(x)))
    n, h = F.col(f"{p}n"), F.col(f"{p}h")
    rolled = lambda i: F.get(h, i).bitwiseXOR(F.shiftleft(F.coalesce(F.get(h, i - 1), F.lit(0).cast("long")), 1))
    ends = F.filter(
        F.sequence(F.lit(0), F.size(line) - 1),
        lambda i: (i == F.size(line) - 1) | (F.get(n, i) > PASSAGE) | (F.get(n, i + 1) > PASSAGE) | (rolled(i).bitwiseAND(F.lit(BOUNDARY_BITS).cast("long")) == 0),
    )
    cut = cut.withColumn(f"{p}ends", F.when(line.isNotNull(), ends))
    spans = F.transform(f"{p}ends", lambda last, k: F.struct((F.coalesce(F.get(F.col(f"{p}ends"), k - 1), F.lit(-1)) + 1).alias("first"), last.alias("last")))

    cut = cut.withColumn(f"{p}spans", spans)

    # A window has PASSAGE + 1 lines with words at most. Packed: the words so far * 64 + the lines so far.
    cut = cut.withColumn(f"{p}worded", F.filter(F.sequence(F.lit(0), F.size(line) - 1), lambda i: F.get(n, i) > 0))
    worded = F.col(f"{p}worded")
    cut = cut.withColumn(f"{p}m", F.transform(worded, lambda i: F.get(n, i).cast("long")))
    m, full, most = F.col(f"{p}m"), (PASSAGE + 1) * 64, PASSAGE + 1
    reach = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: F.when(a >= full, a).otherwise(a + x * 64 + 1))
    steps = lambda a: F.when(a >= full, a.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    # A fold has no early end: four lines are tried first, which mostly are enough.
    some = lambda part: F.when(reach(part(4)) >= full, reach(part(4))).otherwise(reach(part(most)))
    after = lambda k: lambda size: F.slice(m, k + 1, size)
    before = lambda k: lambda size: F.reverse(F.slice(m, F.greatest(k + 2 - size, F.lit(1)), F.least(k + 1, F.lit(size))))
    ahead = F.transform(worded, lambda i, k: F.struct(i.alias("first"), F.get(worded, k - 1 + steps(some(after(k)))).alias("last")))
    behind = F.transform(worded, lambda i, k: F.struct(F.get(worded, k + 1 - steps(some(before(k)))).alias("first"), i.alias("last")))
    windows = F.filter(F.concat(ahead, behind), lambda s: s["first"].isNotNull() & s["last"].isNotNull())
    cut = cut.withColumn(f"{p}windows", F.array_except(windows, F.col(f"{p}spans")))

    def describe(s: Column, of_cut: bool) -> Column:
        own = F.slice(n, s["first"] + 1, s["last"] - s["first"] + 1)
        worded = F.aggregate(own, F.lit(0), lambda a, x: a + F.when(x > 0, 1).otherwise(0))
        counted = F.aggregate(own, F.lit(0), lambda a, x: a + x)
        seq = F.slice(h, s["first"] + 1, s["last"] - s["first"] + 1)
        return F.struct(s["first"].alias("first"), s["last"].alias("last"), worded.alias("lines"), counted.alias("words"), F.xxhash64(seq).alias("hash"), F.lit(of_cut).alias("cut"), seq.alias("seq"))

    every = F.concat(F.transform(f"{p}spans", lambda s: describe(s, True)), F.transform(f"{p}windows", lambda s: describe(s, False)))
    return cut.withColumn(f"{p}chunks", every).drop(*[p + c for c in ("n", "h", "ends", "spans", "worded", "m", "windows")])


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, first, last, hash, cut): lines first to last (from 0) of a document that repeat an earlier chunk or window.

    id and text_hash, the xxhash64 of the text, name the document.
    """
    texts = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("body")).filter(F.col("body").isNotNull())
    counts = (F.col("c.lines") >= MIN_LINES) | (F.col("c.words") > PASSAGE)
    # explode() would put a filter on the array's size below the projections, with all their expressions unfolded into it.
    found = chunked(texts, "body").select("id", "text_hash", F.explode_outer(f"{OWN}chunks").alias("c")).filter(counts)
    found = materialize(found.select("id", "text_hash", *[F.col(f"c.{c}").alias(c) for c in ("first", "last", "hash", "cut", "seq")]))
    place = F.xxhash64("id", "text_hash", "first")
    chunks = found.groupBy("hash").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.ceil(F.count("*") / FAN).alias("fan")).filter("a <> b").select("hash", "fan")
    chunks = materialize(chunks)
    again = likely_in(found, F.col("hash"), chunks, F.col("hash"), chunks.count()).join(chunks, "hash")
    again = materialize(again.groupBy("id", "text_hash", "first", "last", "hash", "fan", "seq").agg(F.max("cut").alias("cut")))
    free(found, chunks)
    stays = again.groupBy("hash", "fan").agg(F.min(F.struct("id", "text_hash", "first", "last", "seq")).alias("stays"))
    overlaps = F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("text_hash") == F.col("stays.text_hash")) & (F.col("first") <= F.col("stays.last"))
    gone = _joined(again, materialize(stays)).filter((F.col("seq") == F.col("stays.seq")) & ~overlaps)
    gone = gone.join(_unequal(texts, again), "hash", "left_anti")
    return gone.select("id", "text_hash", "first", "last", "hash", "cut")


def _unequal(texts: DataFrame, again: DataFrame) -> DataFrame:
    """(hash) of the repeated chunks with a line whose hash several different lines have: all bytes are compared."""
    sought = materialize(again.select(F.explode("seq").alias("h")).distinct())
    lines = texts.select(F.explode(F.split("body", "\n")).alias("line"))
    lines = likely_in(lines, F.xxhash64("line"), sought, F.col("h"), sought.count()).groupBy(F.xxhash64("line").alias("h"))
    bad = materialize(lines.agg(F.min("line").alias("a"), F.max("line").alias("b")).filter("a <> b").select("h"))
    return again.select("hash", F.explode("seq").alias("h")).join(bad, "h", "left_semi").select("hash").distinct()


def _joined(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """rows joined with chunks, one row a hash. A chunk of more than FAN rows (in a third of all documents, say) is many tasks."""
    salt = f"{OWN}salt"
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64("id", "text_hash", "first"), F.col("fan")))
    copies = chunks.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.col("fan") - 1))).drop("fan")
    return dealt.join(copies, ["hash", salt]).drop(salt)


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with its text cleaned and the columns OWN + 'lines', OWN + 'removed' (numbers of lines), OWN + 'chunks' (removed)."""
    before = mark(docs.sparkSession)
    gone = materialize(removals(docs, key, text))
    release(docs.sparkSession, before | mark_of(gone), docs)
    # Overlapping spans become one, so that a document has few.
    spans = F.sort_array(F.collect_set(F.struct("first", "last")))
    last = lambda a: F.element_at(a, -1)
    step = lambda a, x: F.when((F.size(a) > 0) & (x["first"] <= F.get(a, F.size(a) - 1)["last"] + 1), F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last(a)["first"].alias("first"), F.greatest(last(a)["last"], x["last"]).alias("last"))))).otherwise(F.concat(a, F.array(x)))
    gone_of = gone.groupBy(F.col("id").alias(f"{OWN}id"), F.col("text_hash").alias(f"{OWN}hash")).agg(spans.alias("s"), F.count_if("cut").alias(f"{OWN}chunks"))
    gone_of = materialize(gone_of.select(f"{OWN}id", f"{OWN}hash", F.aggregate("s", F.array().cast("array<struct<first:int,last:int>>"), step).alias(f"{OWN}spans"), f"{OWN}chunks"))
    n_spans = gone_of.agg(F.coalesce(F.sum(F.size(f"{OWN}spans")), F.lit(0))).first()[0]
    same = docs[key].eqNullSafe(gone_of[f"{OWN}id"]) & (F.xxhash64(docs[text]) == gone_of[f"{OWN}hash"])
    if n_spans <= BROADCAST_ROWS:
        joined = docs.join(F.broadcast(gone_of), same, "left")
    else:
        likely = f"{OWN}likely"
        flagged = with_likely(docs, F.xxhash64(key, F.xxhash64(text)), gone_of, F.xxhash64(f"{OWN}id", f"{OWN}hash"), gone_of.count(), likely)
        none = {c.name: F.lit(None).cast(c.dataType) for c in gone_of.schema}
        same = flagged[key].eqNullSafe(gone_of[f"{OWN}id"]) & (F.xxhash64(flagged[text]) == gone_of[f"{OWN}hash"])
        joined = flagged.filter(likely).join(gone_of, same, "left").unionByName(flagged.filter(~F.col(likely)).withColumns(none))
    joined = joined.withColumn(f"{OWN}line", F.split(F.col(text), "\n"))
    joined = joined.withColumn(f"{OWN}gone", F.array_distinct(F.flatten(F.transform(f"{OWN}spans", lambda s: F.sequence(s["first"], s["last"])))))
    line, own_gone = F.col(f"{OWN}line"), F.col(f"{OWN}gone")
    stay = F.array_except(F.sequence(F.lit(0), F.size(line) - 1), own_gone)
    cleaned = F.when(own_gone.isNull(), F.col(text)).otherwise(F.array_join(F.transform(stay, lambda i: F.get(line, i)), "\n"))
    return joined.select(
        *[cleaned.alias(text) if c == text else F.col(c) for c in docs.columns],
        F.when(line.isNotNull(), F.size(line)).otherwise(0).alias(f"{OWN}lines"),
        F.when(own_gone.isNotNull(), F.size(own_gone)).otherwise(0).alias(f"{OWN}removed"),
        F.coalesce(F.col(f"{OWN}chunks"), F.lit(0)).alias(f"{OWN}chunks"),
    )


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with its text cleaned; without the rows of which no line with a word is left."""
    done = deduplicate(docs, key, text)
    empty = (F.col(f"{OWN}removed") > 0) & (F.length(F.translate(text, " \t\n\x0b\x0c\r", "")) == 0)
    return done.filter(~empty).select(*docs.columns)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = deduplicate(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "text", F.col(f"{OWN}lines").cast("long").alias("n_lines"), F.col(f"{OWN}removed").cast("long").alias("n_removed_lines"), F.col(f"{OWN}chunks").cast("long").alias("n_removed_chunks"))
