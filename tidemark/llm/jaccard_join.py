"""N-gram Jaccard self-join: documents whose 5-word shingle sets overlap by 75 % or more. Exact.

1. Counters. One pass over the texts gives each document's set size and a 64-bit digest of its set
   (documents of one set are one class, a node), and counts all shingles in a table of 2 ** COUNTERS
   hashed counters, of a fixed size. It is no filter: it only orders shingles from rare to frequent
   (then by hash), the same for all documents.
2. Tiles. Sets of sizes a and b link only if they share o = ceil(3 (a + b) / 7) shingles; so the
   first one that they share, in that order, has rank a - o + 1 at most in the one and b - o + 1 in
   the other. A class is filed under its a - ceil(0.75 a) + 1 rarest shingles, with their ranks.
   Shingles of two classes or more that sizes and ranks allow to link are tiles. The postings travel
   once, packed, in sorted cells.
   What makes near copies differ is rare and comes first, so classes that differ too much share no
   tile, or not at ranks that allow a link.
3. Stars. In each tile the classes meet one hub: first the one with the least rank (of a group of
   near copies, the original: it has no rare shingles of its own), then one chosen by hash, of which
   a class keeps the EDGES that it met most often. So a large group makes links by its size, not by
   its square. Tiles of two classes are settled by the first star.
4. Bands. Tiles that still hold several components are split by bands of set sizes, and all pairs
   across components that sizes and ranks allow are compared: no link between them is lost.
5. Every pair is first bounded by hashed bitmap signatures (parity bits, at least twice as many as
   shingles): |A ^ B| is at least the number of differing bits, so a pair with 7 * bits > |A| + |B|
   can't link. What passes is verified by intersecting the exact sorted shingle arrays.

Cases: null, empty or wordless texts have no shingles and link with nothing; fewer than five words
are one shingle; repeated rows are one class and each gets its row; null ids are allowed (they link,
but never name a component that has an id); one id with several texts is several documents; an empty
table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import OWN, free, materialize, read_table
from tidemark.llm.components import components
from tidemark.llm.shingles import mix, shingle_sets, slices, word_hashes

#: Two to this power hashed counters of 4 bytes: 16 MB, whatever the input.
COUNTERS = 22
CHUNK = 1 << 16
#: Postings in a cell, and in what a task packs at once.
CELL, PACK = 1 << 20, 1 << 19
#: A shingle counted so many times more often than the median counter is dealt over several cells.
HEAVY = 5_000
#: Stars after the first, and the hubs that a class keeps in them.
STAR_ROUNDS, EDGES = 1, 4
#: So many pairs of one hub share a copy of its array.
FAN = 4_096
#: Two to this power bits of a filter of wanted ids: 8 MB, whatever the input.
WANTED = 26
#: Sizes in a band differ by a third at most.
BAND = 4 / 3


def node_of(own: np.ndarray) -> int:
    """The digest of a set."""
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def prefix_size(n: np.ndarray) -> np.ndarray:
    """How many of a set's rarest shingles every set that links with it must meet one of."""
    return n - (3 * n + 3) // 4 + 1


def _add(total: dict[int, np.ndarray], chunk: int, counts: np.ndarray) -> None:
    total[chunk] = np.minimum(total[chunk].astype(np.int64) + counts, 2**32 - 1).astype(np.uint32) if chunk in total else counts


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_hash, n, node, bits) of (doc_id, text_hash, text); then (chunk, body) of the counters."""
    table = np.zeros(1 << COUNTERS, np.uint32)
    for batch in batches:
        for first, data, offsets in slices(batch.column(2)):
            sets, rows = shingle_sets(*word_hashes(data, offsets))
            n = np.diff(rows)
            np.add.at(table, (sets >> np.uint64(64 - COUNTERS)).astype(np.int64), np.uint32(1))
            own = [sets[a:b] for a, b in zip(rows.tolist(), rows[1:].tolist(), strict=False)]
            nodes, bits = [node_of(x) if len(x) else None for x in own], [signature(x) if len(x) else None for x in own]
            none = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
            yield pa.record_batch([batch.column(0).slice(first, len(n)), batch.column(1).slice(first, len(n)), pa.array(n), pa.array(nodes, pa.int64()), pa.array(bits, pa.binary()), *none], names=_SIZED)
    for at in range(0, 1 << COUNTERS, CHUNK):
        if (part := table[at : at + CHUNK]).any():
            yield pa.record_batch([*[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.binary()), pa.array([at // CHUNK], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=_SIZED)


_SIZED = ["doc_id", "text_hash", "n", "node", "bits", "chunk", "body"]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the chunks as they stream by: memory for one copy of the counters, however many come."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            _add(total, chunk, np.frombuffer(zlib.decompress(body.as_buffer()), np.uint32))
    for chunk, counts in total.items():
        yield pa.record_batch([pa.array([chunk], pa.int32()), pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], names=["chunk", "body"])


def prefixes(sets: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, row, rank from 1, counter) of the rarest shingles of all sets. counts: the counter of each."""
    n = np.diff(rows)
    row = np.repeat(np.arange(len(n)), n)
    order = np.argsort((row << 32) | counts, kind="stable")  # by hash among equals, as the sets are sorted
    rank = np.arange(len(sets)) - rows[:-1][row] + 1
    near = rank <= prefix_size(n)[row]
    order = order[near]
    return sets[order], row[near], rank[near], counts[order]


def _packed(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, ranks: np.ndarray, fans: np.ndarray, cells: int) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        route = np.where(fans > 1, mix(keys + mix(nodes.view(np.uint64)) % fans.astype(np.uint64) + np.uint64(1)), keys)
    cell = ((route >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int32)
    order = np.lexsort((keys, cell))
    cell, keys, nodes, sizes, ranks = cell[order], keys[order], nodes[order], sizes[order], np.where(fans > 1, -ranks, ranks)[order].astype(np.int32)
    cuts = np.r_[np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), len(cell)].tolist()
    out = [[], [], [], [], []]
    for a, b in zip(cuts, cuts[1:], strict=False):
        own, first, which = np.unique(nodes[a:b], return_index=True, return_inverse=True)
        steps = np.diff(keys[a:b], prepend=np.uint64(0))
        for column, x in zip(out, (_planes(steps), own.tobytes(), sizes[a:b][first].astype(np.int32).tobytes(), _planes(which.astype(np.int32)), _planes(ranks[a:b])), strict=True):
            column.append(x)
    yield pa.record_batch([pa.array(cell[cuts[:-1]]), *[pa.array(x, pa.binary()) for x in out]], names=["cell", "steps", "nodes", "sizes", "which", "ranks"])


def _planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones, ...: the upper ones are mostly zeros, which shuffle files compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _numbers(body: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(width, -1).T).view(kind).ravel()


def linkable(key: np.ndarray, n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which postings, sorted by key, have another one of their key that sizes and ranks allow to link."""
    keep = np.zeros(len(key), bool)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    lengths = np.diff(np.r_[starts, len(key)])
    for length in np.unique(lengths[lengths > 1]).tolist():
        if length > 64:  # all stay: the stars and bands decide
            at = starts[lengths == length][:, None] + np.arange(length)
            keep[at] = True
            continue
        at = starts[lengths == length][:, None] + np.arange(length)
        for a in range(length):
            for b in range(a):
                x, y = at[:, a], at[:, b]
                least = -(-3 * (n[x] + n[y]) // 7)
                fits = (4 * np.minimum(n[x], n[y]) >= 3 * np.maximum(n[x], n[y])) & (place[x] <= n[x] - least + 1) & (place[y] <= n[y] - least + 1)
                keep[x[fits]] = True
                keep[y[fits]] = True
    return keep


def _postings(table, middle: int, cells: int):
    """Postings of all classes, packed by cell. A task files a class once, however many copies it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, seen, held, size = table.value, set(), [], 0
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                sets, rows = shingle_sets(*word_hashes(data, offsets))
                nodes = np.array([node_of(sets[a:b]) for a, b in zip(rows.tolist(), rows[1:].tolist(), strict=False)], np.int64)
                keys, row, rank, counts = prefixes(sets, rows, counters[(sets >> np.uint64(64 - COUNTERS)).astype(np.int64)].astype(np.int64))
                fresh = np.zeros(len(nodes), bool)
                for k, x in enumerate(nodes.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[k] = True
                new = fresh[row]
                row = row[new]
                fans = np.maximum(1, -(-(counts[new] - middle) // HEAVY))
                held.append((keys[new], nodes[row], np.diff(rows)[row], rank[new], fans))
                size += len(row)
                if size >= PACK:
                    yield from _packed(*(np.concatenate(x) for x in zip(*held, strict=True)), cells)
                    held, size = [], 0
        if size:
            yield from _packed(*(np.concatenate(x) for x in zip(*held, strict=True)), cells)

    return run


def _tiles(table: pa.Table) -> pa.Table:
    """(key, node, n, place) of a cell's tiles of three classes or more, or of a heavy key; and (node, hub) of the first stars of all tiles."""
    parts = []
    for row in table.to_batches():
        for steps, own, size, which, ranks in zip(*(row.column(name) for name in ("steps", "nodes", "sizes", "which", "ranks")), strict=True):
            of = _numbers(which.as_buffer(), np.int32)
            with np.errstate(over="ignore"):
                keys = np.cumsum(_numbers(steps.as_buffer(), np.uint64), dtype=np.uint64)
            parts.append((keys, np.frombuffer(own.as_buffer(), np.int64)[of], np.frombuffer(size.as_buffer(), np.int32)[of], _numbers(ranks.as_buffer(), np.int32)))
    keys, nodes, n, ranks = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    order = np.lexsort((nodes, keys))
    keys, nodes, n, ranks = keys[order], nodes[order], n[order], ranks[order]
    keep = np.r_[True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])]  # each once
    same = keys[1:] == keys[:-1]
    keep &= np.r_[same, False] | np.r_[False, same] | (ranks < 0)
    keys, nodes, n, ranks = keys[keep], nodes[keep], n[keep].astype(np.int64), ranks[keep].astype(np.int64)
    heavy, place = ranks < 0, np.abs(ranks)
    keep = linkable(keys, n, place) | heavy
    keys, nodes, n, heavy, place = keys[keep], nodes[keep], n[keep], heavy[keep], place[keep]
    order = np.lexsort((nodes, -n, place, keys))
    keys, nodes, n, heavy, place = keys[order], nodes[order], n[order], heavy[order], place[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    size = np.diff(np.r_[starts, len(keys)])
    hub = np.repeat(starts, size)
    least = -(-3 * (n + n[hub]) // 7)
    meets = (hub != np.arange(len(keys))) & (4 * np.minimum(n, n[hub]) >= 3 * np.maximum(n, n[hub])) & (place <= n - least + 1) & (place[hub] <= n[hub] - least + 1)
    edges = np.unique(np.column_stack([nodes[meets], nodes[hub[meets]]]), axis=0)
    stay = heavy | (np.repeat(size, size) > 2)
    none = lambda k: pa.nulls(k, pa.int64())
    tiles = [pa.array(keys[stay].view(np.int64)), pa.array(nodes[stay]), pa.array(n[stay]), pa.array(place[stay]), none(int(stay.sum()))]
    stars = [none(len(edges)), pa.array(edges[:, 0]), none(len(edges)), none(len(edges)), pa.array(edges[:, 1])]
    return pa.table([pa.chunked_array(list(x), pa.int64()) for x in zip(tiles, stars, strict=True)], names=["key", "node", "n", "place", "hub"])


def signature(own: np.ndarray) -> bytes:
    """Parity bits of a set: twice as many as shingles at least, a power of two."""
    width = max(256, 1 << (2 * len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """The number of differing parity bits; the longer signature is folded to the length of the shorter."""
    if len(a) < len(b):
        a, b = b, a
    x, width = int.from_bytes(a, "little"), 8 * len(a)
    while width > 8 * len(b):
        width //= 2
        x = (x >> width) ^ (x & ((1 << width) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


def _wanted_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a bitmap of hashed ids."""
    bits = np.zeros(1 << (WANTED - 3), np.uint8)
    for batch in batches:
        at = (batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - WANTED)).astype(np.int64)
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    for k in range(0, len(bits), CHUNK):
        if bits[k : k + CHUNK].any():
            yield pa.record_batch([pa.array([k // CHUNK], pa.int32()), pa.array([zlib.compress(bits[k : k + CHUNK].tobytes(), 1)], pa.binary())], names=["chunk", "body"])


def _joined_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = np.frombuffer(zlib.decompress(body.as_buffer()), np.uint8)
            total[chunk] = total[chunk] | own if chunk in total else own
    for chunk, own in total.items():
        yield pa.record_batch([pa.array([chunk], pa.int32()), pa.array([zlib.compress(own.tobytes(), 1)], pa.binary())], names=["chunk", "body"])


def _sets(wanted):
    """(node, own) of (id hash, text): of all wanted documents, and of a few more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            at = (batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - WANTED)).astype(np.int64)
            texts = batch.column(1).filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            for _, data, offsets in slices(texts):
                sets, rows = shingle_sets(*word_hashes(data, offsets))
                own = [sets[a:b] for a, b in zip(rows.tolist(), rows[1:].tolist(), strict=False) if b > a]
                yield pa.record_batch([pa.array([node_of(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], names=["node", "own"])

    return run


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted arrays of distinct numbers."""
    both = np.sort(np.concatenate((a, b)), kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The (a, b) of (a, b, bits_a, bits_b, n_a, n_b) that the bitmaps allow to link."""
    for batch in batches:
        a, b, bits_a, bits_b, n_a, n_b = (batch.column(k) for k in range(6))
        sizes = (n_a.to_numpy() + n_b.to_numpy()).tolist()
        keep = pa.array([7 * differing(x.as_py(), y.as_py()) <= n for x, y, n in zip(bits_a, bits_b, sizes, strict=True)], pa.bool_())
        yield pa.record_batch([a.filter(keep), b.filter(keep)], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The (a, b) of (a, b, own_a, own_b) that link."""
    for batch in batches:
        a_sets, b_sets = batch.column(2), batch.column(3)
        keep = []
        for k in range(batch.num_rows):
            a, b = np.frombuffer(a_sets[k].as_buffer(), np.uint64), np.frombuffer(b_sets[k].as_buffer(), np.uint64)
            common = overlap(a, b)
            keep.append(100 * common >= 75 * (len(a) + len(b) - common))
        keep = pa.array(keep, pa.bool_())
        yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def can_link(n_a: Column, place_a: Column, n_b: Column, place_b: Column) -> Column:
    """Whether sizes and the ranks of a shared shingle allow that it is the first shared one of a link."""
    least = F.ceil(3 * (n_a + n_b) / 7)
    return (4 * F.least(n_a, n_b) >= 3 * F.greatest(n_a, n_b)) & (place_a <= n_a - least + 1) & (place_b <= n_b - least + 1)


def _stars(held: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of classes a and their tiles' hubs b, which are in another component: EDGES for a class at most."""
    hubs = held.groupBy("key").agg(F.min_by(F.struct("node", "n", "place", "comp"), F.xxhash64("node", F.lit(turn))).alias("h"))
    meets = (F.col("comp") != F.col("h.comp")) & can_link(F.col("n"), F.col("place"), F.col("h.n"), F.col("h.place"))
    met = held.join(hubs, "key").filter(meets).groupBy(F.col("node").alias("a"), F.col("h.node").alias("b")).count()
    most = Window.partitionBy("a").orderBy(F.col("count").desc(), "b")
    return met.withColumn("nth", F.row_number().over(most)).filter(F.col("nth") <= EDGES).select("a", "b")


def _band(n: Column) -> Column:
    return F.floor(F.log(n) / float(np.log(BAND))).cast("int")


def _across(held: DataFrame) -> DataFrame:
    """All pairs (a, b) of a tile's classes in different components that sizes and ranks allow to link.

    The larger class, b, visits the bands of sizes that its rank leaves to the smaller: its own or the one below.
    """
    n, place = F.col("n"), F.col("place")
    smaller = held.filter(place <= n - F.ceil(6 * n / 7) + 1).select("key", _band(n).alias("band"), *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "place", "comp")])
    most = F.least(n, F.floor(7 * (n - place + 1) / 3).cast("long") - n)
    visits = held.withColumn("most", most).filter("4 * most >= 3 * n").withColumn("band", F.explode(F.sequence(_band(F.ceil(3 * n / 4)), _band(F.col("most")))))
    visits = visits.select("key", "band", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "place", "comp")])
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b")))
    allowed = ordered & (F.col("comp_a") != F.col("comp_b")) & can_link(F.col("n_a"), F.col("place_a"), F.col("n_b"), F.col("place_b"))
    return smaller.join(visits, ["key", "band"]).filter(allowed).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _beside(pairs: DataFrame, sets: DataFrame, side: str, heavy: DataFrame, *columns: str) -> DataFrame:
    """pairs with the columns of the sets of one side. A hub of many pairs comes in copies, one for FAN pairs."""
    other = "b" if side == "a" else "a"
    own = sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
    if side == "a":
        return pairs.join(own, "a")
    fan = F.coalesce("fan", F.lit(1))
    dealt = pairs.join(heavy, "b", "left").withColumn("salt", F.pmod(F.xxhash64(other), fan)).drop("fan")
    copies = own.join(heavy, "b", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), fan - 1))).drop("fan")
    return dealt.join(copies, ["b", "salt"]).drop("salt")


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Of the distinct pairs (a, b) of classes, those that link. Written to the scratch folder."""
    pairs = materialize(pairs)
    heavy = pairs.groupBy("b").count().filter(F.col("count") > FAN).select("b", F.ceil(F.col("count") / FAN).alias("fan"))
    signed = _beside(_beside(pairs, classes, "a", heavy, "bits", "n"), classes, "b", heavy, "bits", "n")
    likely = materialize(signed.select("a", "b", "bits_a", "bits_b", "n_a", "n_b").mapInArrow(_likely, "a long, b long").distinct())
    nodes = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct()
    sets = _texts_of(docs, classes.join(nodes, "node").select("one.doc_id").distinct())
    whole = _beside(_beside(likely, sets, "a", heavy, "own"), sets, "b", heavy, "own")
    found = materialize(whole.select("a", "b", "own_a", "own_b").mapInArrow(_verified, "a long, b long").distinct())
    free(pairs, likely, sets)
    return found


def _between(links: DataFrame, state: DataFrame) -> DataFrame:
    """The distinct pairs (ca, cb) of different components that links join."""
    of = lambda side: state.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))
    return links.join(of("a"), "a").join(of("b"), "b").filter("ca <> cb").select("ca", "cb").distinct()


def _merged(state: DataFrame, found: DataFrame) -> DataFrame:
    """state (node, comp) after some of the links found: a component joins the least that it links to, and that one's.

    Twice, so that a star becomes one component. Between rounds it is enough that what has one
    component is linked; all links count at the end.
    """
    for _ in range(2):
        between = _between(found, state)
        both = between.union(between.select(F.col("cb").alias("ca"), F.col("ca").alias("cb")))
        step = both.groupBy(F.col("ca").alias("comp")).agg(F.min("cb").alias("to")).filter("to < comp")
        steps = []
        for _ in range(2):
            step = materialize(step)
            steps.append(step)
            step = step.join(step.select(F.col("comp").alias("to"), F.col("to").alias("end")), "to", "left").select("comp", F.coalesce("end", "to").alias("to"))
        before, state = state, materialize(state.join(step, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))
        free(before, *steps)
    return state


def _held(tiles: DataFrame, state: DataFrame) -> DataFrame:
    """The tiles of several components, with the state of their nodes."""
    own = tiles.join(state, "node")
    spread = own.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("key")
    return materialize(own.join(spread, "key"))


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(node, own) of the documents with these ids: a bitmap of hashed ids goes to all tasks, no text is shuffled."""
    spark = docs.sparkSession
    parts = ids.select(F.xxhash64("doc_id").alias("h")).mapInArrow(_wanted_bits, "chunk int, body binary").repartition("chunk").mapInArrow(_joined_bits, "chunk int, body binary")
    bits = np.zeros(1 << (WANTED - 3), np.uint8)
    for r in parts.collect():  # 8 MB at most
        own = np.frombuffer(zlib.decompress(r["body"]), np.uint8)
        bits[r["chunk"] * CHUNK : r["chunk"] * CHUNK + len(own)] = own
    wanted = spark.sparkContext.broadcast(bits)
    sets = materialize(docs.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(_sets(wanted), "node long, own binary"))
    wanted.destroy()  # the table is written: nothing asks for it again
    return sets


def _tiled(docs: DataFrame, sized: DataFrame) -> DataFrame:
    """(key, node, n, place, hub): the tiles and first stars, as _tiles says. sized: what _sized gives."""
    spark = docs.sparkSession
    counters = np.zeros(1 << COUNTERS, np.uint32)
    for r in sized.filter("chunk IS NOT NULL").select("chunk", "body").repartition("chunk").mapInArrow(_summed, "chunk int, body binary").collect():  # 16 MB at most
        own = np.frombuffer(zlib.decompress(r["body"]), np.uint32)
        counters[r["chunk"] * CHUNK : r["chunk"] * CHUNK + len(own)] = own
    shingles = sized.filter("chunk IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cells = 1 + shingles // (4 * CELL)
    table = spark.sparkContext.broadcast(counters)
    run = _postings(table, int(np.median(counters)), cells)
    packed = docs.select("text").mapInArrow(run, "cell int, steps binary, nodes binary, sizes binary, which binary, ranks binary")
    tiles = materialize(packed.groupBy("cell").applyInArrow(_tiles, "key long, node long, n long, place long, hub long"))
    table.destroy()
    return tiles


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, n_copies, stays): one row for each row of docs. key: a whole number.

    stays: whether the document is its component's one of the least id (then the least xxhash64 of its text; null ids last).
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    sized = materialize(docs.mapInArrow(_sized, "doc_id long, text_hash long, n long, node long, bits binary, chunk int, body binary"))
    rows = sized.filter("chunk IS NULL").select("doc_id", "text_hash", "n", "node", "bits")
    one = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    classes = materialize(rows.filter("n > 0").groupBy("node").agg(F.min(one).alias("one"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bits").alias("bits")))

    tiled = _tiled(docs, sized)
    tiles = tiled.filter("key IS NOT NULL").select("key", "node", "n", "place")
    edges = tiled.filter("hub IS NOT NULL").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    links = [_links(edges, classes, docs)]
    nodes = tiles.select("node").union(links[0].select("a")).union(links[0].select("b")).distinct()
    state = _merged(materialize(nodes.select("node", F.col("node").alias("comp"))), links[0])
    for turn in range(STAR_ROUNDS + 1):
        held = _held(tiles, state)
        if held.isEmpty():
            free(held)
            break
        found = _links(_stars(held, turn) if turn < STAR_ROUNDS else _across(held), classes, docs)
        free(held)
        links.append(found)
        if turn < STAR_ROUNDS:
            state = _merged(state, found)
    free(tiled)
    crossed = _between(links[0], state)
    for found in links[1:]:
        crossed = crossed.union(_between(found, state))
    ends = components(crossed.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    comp = state.join(ends.select(F.col("node").alias("comp"), "component"), "comp", "left").select("node", F.coalesce("component", "comp").alias("of"))
    # Classes without a shared tile are components of their own.
    named = classes.join(comp, "node", "left").select("node", "one", "copies", F.coalesce("of", "node").alias("of"))
    named = materialize(named)
    free(classes, state, *links)
    named = named.join(named.groupBy("of").agg(F.min("one").alias("least")), "of").select("node", "least", "copies")
    mine = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    return rows.join(named, "node", "left").select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.when(F.col("least").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
        (F.col("least").isNull() | F.col("least").eqNullSafe(mine)).alias("stays"),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each group of near duplicates, that with the least id; the columns of docs.

    Documents without shingles are in no group: all their rows stay.
    """
    kept = near_duplicates(docs, key, text).filter("stays").groupBy(F.col("doc_id").alias(f"{OWN}id"), F.col("text_hash").alias(f"{OWN}hash"))
    kept = materialize(kept.agg(F.count_if(F.col("n_shingles") > 0).alias(f"{OWN}rows")))
    same = docs[key].cast("long").eqNullSafe(kept[f"{OWN}id"]) & F.xxhash64(docs[text]).eqNullSafe(kept[f"{OWN}hash"])
    again = kept.filter(f"{OWN}rows > 1")
    if again.isEmpty():
        return docs.join(kept, same, "left_semi")
    return docs.join(kept.filter(f"{OWN}rows <= 1"), same, "left_semi").unionByName(docs.join(again, same, "left_semi").dropDuplicates([key, text]))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_hash", "stays")
