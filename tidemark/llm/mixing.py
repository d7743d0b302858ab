"""Mixing sources to target weights by balanced sampling (the cube method).

Every source gets a target number of words (`targets`). A source's rate, target / words, splits
into whole copies of all its documents and a fraction. The fraction is the inclusion probability of
one more copy. The cube method rounds these probabilities to 0 or 1 while it keeps, for each
source, both the number of documents and the number of words that they expect: as long as three
documents are open, their probabilities move along the one direction that changes neither total,
until one of them reaches 0 or 1 (flight). At most two stay open in a group. In the last group of a
source a dozen more do: these few are decided together to meet the word total best (landing).

A source is dealt by hash over groups of about `group_rows` documents, so that a source with a third
of all rows is many tasks; what the groups leave open (two documents each) flies again, in ever
fewer groups, until one group a source lands. Each level is written to the shared scratch folder.

Cases: null or wordless texts have size 0 and are never taken; a null source is a source of its own,
the last; repeated rows are separate documents (ordered by id, size and a hash of the text); a
source of one document, or an empty table, works; `taken_documents` puts its own size, target, taken
and copies in place of columns of these names. Reruns agree: every random choice is a hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import OWN, WORD, materialize, read_table

WEIGHTS = (5.0, 2.0, 1.0)
EPS = 1e-9
#: Documents of a source that the flight leaves to the landing, besides the two that it can't decide.
LAND = 12
BROADCAST_ROWS = 300_000
#: Up to so many sources their totals are broadcast.
BROADCAST_SOURCES = 100_000


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Words for each source: share * all words by weight, none over most * its own words.

    Sources by code point, null last, take the weights in turn. What a capped source can't take
    goes to the others by weight, until none is above its cap.
    """
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left, rest = share * sum(sizes.values()), order
    while rest:
        per = left / sum(weight[s] for s in rest)
        full = [s for s in rest if per * weight[s] > most * sizes[s]]
        if not full:
            return out | {s: per * weight[s] for s in rest}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        rest = [s for s in rest if s not in out]
    return out


def _uniform(keys: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each 64-bit key."""
    x = keys.astype(np.uint64)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


def flight(p: np.ndarray, size: np.ndarray, draw: np.ndarray, keep: int = 0) -> np.ndarray:
    """Probabilities with the sums of p and of p * size kept, where two at most are open besides the last keep."""
    p = p.astype(float).copy()
    p[p <= EPS], p[p >= 1 - EPS] = 0.0, 1.0
    fractional = np.flatnonzero((p > 0) & (p < 1))
    live: list[int] = []
    for k in fractional[: max(0, len(fractional) - keep)].tolist():
        live.append(k)
        while len(live) == 3:
            a, b, c = live
            u = (float(size[b] - size[c]), float(size[c] - size[a]), float(size[a] - size[b]))
            if u == (0.0, 0.0, 0.0):
                u = (1.0, -1.0, 0.0)
            up = min((1 - p[i]) / x if x > 0 else p[i] / -x for i, x in zip(live, u, strict=True) if x)
            down = min(p[i] / x if x > 0 else (1 - p[i]) / -x for i, x in zip(live, u, strict=True) if x)
            step = up if draw[k] * (up + down) < down else -down
            for i, x in zip(live, u, strict=True):
                p[i] = min(1.0, max(0.0, p[i] + step * x))
                if p[i] < EPS or p[i] > 1 - EPS:
                    p[i] = round(p[i])
            live = [i for i in live if 0 < p[i] < 1]
    return p


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """0 or 1 for the few (LAND + 2 at most) that are open.

    Of all choices whose number of documents is the expected one, rounded up or down, the one whose
    words come nearest to the expected.
    """
    p = p.copy()
    live = np.flatnonzero((p > 0) & (p < 1))
    if len(live):
        picks = (np.arange(2 ** len(live))[:, None] >> np.arange(len(live))) & 1
        off = np.abs(picks @ size[live].astype(float) - p[live] @ size[live])
        p[live] = picks[np.argmin(np.where(np.abs(picks.sum(1) - p[live].sum()) < 1, off, np.inf))]
    return p


def _fly(pdf: pd.DataFrame) -> pd.DataFrame:
    """A group's flight. All groups of a source leave LAND documents more together; a source's only group lands."""
    pdf = pdf.sort_values([f"{OWN}order", f"{OWN}row"], kind="stable")
    size, groups = pdf[f"{OWN}size"].to_numpy(), int(pdf[f"{OWN}groups"].iloc[0])
    p = flight(pdf[f"{OWN}p"].to_numpy(), size, _uniform(pdf[f"{OWN}order"].to_numpy()), -(-LAND // groups))
    return pdf.assign(**{f"{OWN}p": landing(p, size) if groups == 1 else p})


def target_table(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_no, source_size, target) of (source, source_size), as `targets` says, for any number of sources.

    Capped are the sources of the least cap per weight: each is tried at the level that is left when
    those below it are capped, and the first that isn't capped there sets the level of all others.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    own = sizes.withColumn("source_no", place).withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("source_no") % len(weights)))
    own = own.withColumn("cap", most * F.col("source_size")).withColumn("per", F.col("cap") / F.col("weight"))
    order = Window.orderBy("per", "source_no")
    below = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    above = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    every = sizes.agg((share * F.sum("source_size")).alias("every"))
    tried = own.withColumn("below", below).withColumn("above", above).withColumn("nth", F.row_number().over(order))
    tried = tried.crossJoin(F.broadcast(every)).withColumn("level", (F.col("every") - F.col("below")) / F.col("above"))
    level = tried.filter("level <= per").agg(F.min_by("level", "nth").alias("level"))
    goal = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return own.crossJoin(F.broadcast(level)).select("source", "source_no", "source_size", goal.alias("target"))


def _small(df: DataFrame) -> DataFrame:
    """df, a row a source, broadcast while it has few rows."""
    return F.broadcast(df) if df.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else df


def balanced(docs: DataFrame, group_rows: int = 2_000) -> DataFrame:
    """docs has OWN + row, source_no, size, order, p. All rows come back with p 0 or 1.

    A source lands at the level where it has one group, whatever the others have.
    """
    no, groups = f"{OWN}source_no", f"{OWN}groups"
    done, level = None, 0
    docs = docs.withColumn(groups, F.lit(None).cast("long"))
    while True:
        # A group can leave more open than it decides (tiny group_rows): then the next level has fewer groups still.
        counts = docs.groupBy(no).agg(F.count("*").alias("n"), F.max(groups).alias("before"))
        fewer = F.greatest(F.lit(1), F.floor(F.coalesce("before", F.col("n") + 1) / 2))
        counts = materialize(counts.select(no, F.least(F.ceil(F.col("n") / group_rows), fewer).cast("long").alias(groups)))
        most = counts.agg(F.max(groups)).first()[0]
        if most is None:
            return docs.drop(groups) if done is None else done
        dealt = docs.drop(groups).join(_small(counts), no).withColumn(f"{OWN}group", F.pmod(F.xxhash64(f"{OWN}order", F.lit(level)), F.col(groups)))
        flown = dealt.groupBy(no, f"{OWN}group").applyInPandas(_fly, dealt.schema).drop(f"{OWN}group")
        if most == 1 and done is None:
            return flown.drop(groups)
        flown = materialize(flown)
        shut = F.col(f"{OWN}p").isin(0.0, 1.0)
        ended = flown.filter(shut).drop(groups)
        done = ended if done is None else done.unionByName(ended)
        if most == 1:
            return done
        docs, level = flown.filter(~shut), level + 1


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(key, source, size, source_size, target, taken, copies, text_hash): one row for each row of docs."""
    sized = docs.select(
        F.col(key).alias(f"{OWN}key"),
        F.col(source).alias(f"{OWN}source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias(f"{OWN}size"),
        F.xxhash64(F.col(text)).alias(f"{OWN}hash"),
    )
    sized = materialize(sized)
    totals = sized.groupBy(F.col(f"{OWN}source").alias("source")).agg(F.sum(f"{OWN}size").alias("source_size"))
    goal = materialize(target_table(totals, weights, share, most))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    own = _small(goal.select(F.col("source").alias("s"), *[F.col(c).alias(OWN + c) for c in ("source_no", "source_size", "target")], rate.alias(f"{OWN}rate")))
    units = sized.join(own, F.col(f"{OWN}source").eqNullSafe(F.col("s")), "inner").drop("s")
    whole = F.floor(F.col(f"{OWN}rate") + EPS)
    units = units.select(
        "*",
        F.xxhash64(f"{OWN}key", f"{OWN}size", f"{OWN}hash").alias(f"{OWN}order"),
        F.monotonically_increasing_id().alias(f"{OWN}row"),
        whole.alias(f"{OWN}whole"),
        F.greatest(F.lit(0.0), F.col(f"{OWN}rate") - whole).alias(f"{OWN}p"),
    )
    taken = balanced(units)
    copies = F.when(F.col(f"{OWN}size") > 0, F.col(f"{OWN}whole") + F.round(f"{OWN}p")).otherwise(0).cast("long")
    return taken.select(
        F.col(f"{OWN}key").alias(key),
        F.col(f"{OWN}source").alias(source),
        F.col(f"{OWN}size").alias("size"),
        F.col(f"{OWN}source_size").alias("source_size"),
        F.col(f"{OWN}target").alias("target"),
        (copies * F.col(f"{OWN}size")).alias("taken"),
        copies.alias("copies"),
        F.col(f"{OWN}hash").alias("text_hash"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def taken_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of docs that the mix takes, with size, target, taken and copies (in place of columns of these names).

    Rows of one id and text become one, with the copies of all.
    """
    own = ("size", "target", "taken", "copies")
    mixed = mix(docs, key, text, source).filter("copies > 0")
    mixed = mixed.groupBy(F.col(key).alias(f"{OWN}id"), F.col("text_hash").alias(f"{OWN}hash"), F.col(source).alias(f"{OWN}source")).agg(
        F.max("size").alias("size"), F.max("target").alias("target"), F.sum("taken").alias("taken"), F.sum("copies").alias("copies"), F.count("*").alias(f"{OWN}rows")
    )
    mixed = materialize(mixed)
    again = not mixed.filter(f"{OWN}rows > 1").isEmpty()
    near = F.broadcast(mixed) if mixed.count() <= BROADCAST_ROWS else mixed
    rest = [c for c in docs.columns if c not in own]
    rows = docs.select(*rest).dropDuplicates([key, text, source]) if again else docs.select(*rest)
    same = rows[key].eqNullSafe(near[f"{OWN}id"]) & F.xxhash64(rows[text]).eqNullSafe(near[f"{OWN}hash"]) & rows[source].eqNullSafe(near[f"{OWN}source"])
    return rows.join(near, same).select(*rest, *own)
